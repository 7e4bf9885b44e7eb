"""Exact rounding of integer ratios.

Every published rate is a ratio of two counts.  Rounding the double quotient
depends on the floating point error of the division, so the rounding is done on
the integers and only the finished number is turned into a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Largest BIGINT.
LONG = (1 << 63) - 1


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def int_div(a: Column | str, b: Column | str | int) -> Column:
    """Integer quotient, truncated; the key of a parent level is ``int_div(key, 1000)``."""
    divisor = F.lit(b) if isinstance(b, int) else as_column(b)
    return F.call_function("div", as_column(a), divisor)


def round_ratio(num: str, den: str, digits: int, scale: int = 1, times: str | None = None) -> Column:
    """``num * times * scale / den`` rounded half away from zero; null if ``den`` is null or 0.

    All are SQL expressions over whole numbers.  Where a bound on both parts says that nothing can
    overflow, BIGINT does the work; beyond it, a DECIMAL, so counts of any BIGINT size are exact, and products
    as long as twice their size with the scale has 38 digits.  ``div`` cuts towards zero, so adding half
    the divisor with the sign of the numerator rounds for any signs.

    The rare branch is a lambda, which is called and not compiled in line: a row of indicators would
    otherwise be one method too long for the JVM to compile, and take twenty times as long.
    """
    factor = scale * 10**digits
    safe = LONG // (2 * factor + 1)
    n, d = f"cast({num} as bigint)", f"cast({den} as bigint)"
    # Null where the product does not fit, which the bound below then refuses.
    product = f"try_multiply({n}, cast({times} as bigint))" if times else n
    doubled = f"{product} * {2 * factor}L + if({product} < 0L, -abs({d}), abs({d}))"

    wide = [f"cast(x.{c} as decimal(19,0))" for c in "ntd"]
    twice = f"({wide[0]} * {wide[1]} * {2 * factor}BD)" if times else f"({wide[0]} * {2 * factor}BD)"
    half = f"({twice} + if({twice} < 0BD, -abs({wide[2]}), abs({wide[2]})))"
    by = f"({wide[2]} * 2BD)"
    exact = f"cast(({half} - {half} % {by}) / {by} as double)"
    parts = f"named_struct('n', {n}, 't', {f'cast({times} as bigint)' if times else '1L'}, 'd', {d})"
    within = f"between -{safe}L and {safe}L"
    return F.expr(
        f"case when {d} = 0L or {d} is null or {n} is null then null"
        f" when {product} {within} and {d} {within} then cast(({doubled}) div ({d} * 2L) as double) / {10**digits}D"
        f" else transform(array({parts}), x -> {exact})[0] / {10**digits}D end"
    )


def ratio_or_zero(num: str, den: str, digits: int, scale: int = 1, times: str | None = None) -> Column:
    """``round_ratio`` with 0 where there is nothing to divide by."""
    return F.coalesce(round_ratio(num, den, digits, scale, times), F.lit(0.0))
