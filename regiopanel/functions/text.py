"""Text forms used by the exports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiopanel.functions.rounding import as_column


def padded_key(key: Column | str, width: int = 5) -> Column:
    """Key with leading zeros: 1001 becomes ``01001``; a longer key stays whole."""
    return F.format_string(f"%0{width}d", as_column(key))


def plain_decimal(value: Column | str) -> Column:
    """Shortest decimal text, never in exponent form: 0.0001 stays ``0.0001``."""
    fixed = as_column(value).cast("decimal(38,18)").cast("string")
    return F.regexp_replace(fixed, r"(\.\d+?)0+$", "$1")


def decimal_comma(value: Column | str) -> Column:
    return F.translate(plain_decimal(value), ".", ",")


def percent_text(value: Column | str) -> Column:
    """Share as a percentage with two decimals: 0.0182 becomes ``1.82%``."""
    return F.concat((as_column(value) * 100).cast("decimal(38,2)").cast("string"), F.lit("%"))
