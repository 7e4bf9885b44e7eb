"""Running totals and trailing sums per region."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

# The five frames of the incidence and the two reproduction ratios,
# as (first day, last day) relative to the report day.
FRAMES = {
    "last_7": (-6, 0),
    "recent_4": (-3, 0),
    "earlier_4": (-7, -4),
    "recent_7": (-5, 1),
    "earlier_7": (-9, -3),
}


def cumulate(
    df: DataFrame, columns: Sequence[str], geo: str = "geo", day: str = "day", suffix: str = "_cum"
) -> DataFrame:
    """Running totals per region."""
    running = Window.partitionBy(geo).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select("*", *[F.sum(c).over(running).alias(c + suffix) for c in columns])


def window_sum(value: str, start: int, end: int, geo: str = "geo", day: str = "day") -> Column:
    """Sum over the days ``start .. end`` around each row, 0 if there are none.

    The frame is a range of days, so it also holds for series with gaps.
    """
    frame = Window.partitionBy(geo).orderBy(F.unix_date(day)).rangeBetween(start, end)
    return F.coalesce(F.sum(value).over(frame), F.lit(0).cast("bigint"))


def window_sums(
    df: DataFrame,
    value: str,
    frames: Mapping[str, tuple[int, int]] = FRAMES,
    geo: str = "geo",
    day: str = "day",
) -> DataFrame:
    """Trailing sums of a series that may have gaps; all frames share one sort."""
    return df.select("*", *[window_sum(value, lo, hi, geo, day).alias(n) for n, (lo, hi) in frames.items()])


def dense_window_sums(
    df: DataFrame,
    cumulated: str,
    frames: Mapping[str, tuple[int, int]] = FRAMES,
    geo: str = "geo",
    day: str = "day",
) -> DataFrame:
    """Trailing sums of a series with one row per day, from its running total.

    A frame is the difference of two running totals a fixed number of rows apart.
    That is one offset lookup per bound however long the frame, where a sliding
    frame sums its rows again for every row; the sort of the running total is reused.
    """
    by_day = Window.partitionBy(geo).orderBy(day)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def total_at(offset: int) -> Column:
        if offset == 0:
            return F.col(cumulated)
        if offset > 0:
            final = F.col(cumulated) if offset == 1 else F.last(cumulated).over(whole)
            return F.coalesce(F.lead(cumulated, offset).over(by_day), final)
        return F.coalesce(F.lag(cumulated, -offset).over(by_day), F.lit(0).cast("bigint"))

    return df.select("*", *[(total_at(hi) - total_at(lo - 1)).alias(n) for n, (lo, hi) in frames.items()])


def first_event_day(
    df: DataFrame, value: str, geo: str = "geo", day: str = "day", name: str = "first_day"
) -> DataFrame:
    """First day with a positive value, on every row of the region; null if there is none."""
    whole = (
        Window.partitionBy(geo).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    )
    return df.select("*", F.min(F.when(F.col(value) > 0, F.col(day))).over(whole).alias(name))


def first_event_table(df: DataFrame, value: str, geo: str = "geo", day: str = "day") -> DataFrame:
    """First day with a positive value, one row per region that has one."""
    return df.filter(F.col(value) > 0).groupBy(geo).agg(F.min(day).alias("first_day"))
