from datetime import date, timedelta
from fractions import Fraction


def day(n, start=date(2020, 1, 1)):
    """The n-th day, counted from 1."""
    return start + timedelta(days=n - 1)


def half_up(value: Fraction, digits: int) -> float:
    scaled = abs(value) * 10**digits
    units = (2 * scaled.numerator + scaled.denominator) // (2 * scaled.denominator)
    return (units if value >= 0 else -units) / 10**digits


def rows(df, *columns):
    """Rows as a set-like sorted list of tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple((v is None, str(v)) for v in r))
