"""Date parsing, parts and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from regiopanel.functions.rounding import as_column

GERMAN_DAY = "dd.MM.yyyy"


def day_from_text(text: Column | str) -> Column:
    """Date in the first ten characters, ``yyyy-MM-dd`` or ``yyyy/MM/dd``; null if unreadable."""
    head = F.translate(F.substring(F.trim(as_column(text)), 1, 10), "/", "-")
    return F.try_to_date(head, "yyyy-MM-dd")


def day_from_parts(text: Column | str) -> Column:
    """Date at the start of ``DD.MM.YYYY, hh:mm`` style text; null if unreadable."""
    return F.try_to_date(F.substring(F.trim(as_column(text)), 1, 10), GERMAN_DAY)


def day_text(day: Column | str) -> Column:
    return F.date_format(as_column(day), GERMAN_DAY)


def month_window(day: Column | str, year: int, month: int, first_day: int = 1) -> Column:
    """Days ``first_day`` to the end of one month.

    Written as a half-open range on the date itself, so it reaches the file scan,
    which a test on ``year(day)`` and ``month(day)`` would not.
    """
    d = as_column(day)
    following = (year + month // 12, month % 12 + 1)
    lo = F.make_date(F.lit(year), F.lit(month), F.lit(first_day))
    hi = F.make_date(F.lit(following[0]), F.lit(following[1]), F.lit(1))
    return (d >= lo) & (d < hi)
