"""Incidence, reproduction ratios, rates and quotas on a dense panel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from regiopanel.functions import ratio_or_zero, round_ratio
from regiopanel.operators.windows import FRAMES, cumulate, dense_window_sums

# Case numbers are published per 100,000 inhabitants, a reproduction
# ratio exists from the 8th (4-day form) or 10th (7-day form) day after the first case.
PER_INHABITANTS = 100_000
ONSET_DAYS_R4 = 7
ONSET_DAYS_R7 = 9
DOSE_LEVELS = (1, 2, 3)


def dose_column(level: int) -> str:
    return f"doses_{level}"


def quota_column(level: int) -> str:
    return f"dose_quota_{level}"


def incidence(recent_cases: str, population: str, digits: int = 1) -> Column:
    return round_ratio(recent_cases, population, digits, scale=PER_INHABITANTS)


def after_onset(ratio: Column, day: str, first_day: str, days: int) -> Column:
    """Null up to ``days`` days after the first case; a region without a case keeps its value."""
    return F.when(F.col(day) <= F.date_add(first_day, days), None).otherwise(ratio)


def indicators(
    panel: DataFrame,
    geo: str = "geo",
    day: str = "day",
    dose_levels: Sequence[int] = DOSE_LEVELS,
    mask: bool = True,
    missing: float | None = None,
    keep_frames: bool = False,
) -> DataFrame:
    """Add running totals and all derived indicators to a dense panel.

    Expects ``cases``, ``deaths``, ``population`` and one ``doses_<level>`` per level.
    ``mask`` blanks reproduction ratios that their definition does not cover yet;
    ``missing`` replaces indicators of regions without population.
    """
    doses = [dose_column(i) for i in dose_levels]
    by_day = Window.partitionBy(geo).orderBy(day)
    running = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    totals = panel.select(
        "*",
        *[F.sum(c).over(running).alias(c + "_cum") for c in ["cases", "deaths", *doses]],
        *([F.min(F.when(F.col("cases") > 0, F.col(day))).over(whole).alias("_first_day")] if mask else []),
    )
    framed = dense_window_sums(totals, "cases_cum", FRAMES, geo, day)

    r4 = ratio_or_zero("recent_4", "earlier_4", 2)
    r7 = ratio_or_zero("recent_7", "earlier_7", 2)
    if mask:
        r4 = after_onset(r4, day, "_first_day", ONSET_DAYS_R4)
        r7 = after_onset(r7, day, "_first_day", ONSET_DAYS_R7)

    def per_population(column: Column) -> Column:
        return column if missing is None else F.coalesce(column, F.lit(float(missing)))

    derived = framed.withColumns(
        {
            "incidence": per_population(incidence("last_7", "population")),
            "r4": r4,
            "r7": r7,
            "infection_rate": per_population(round_ratio("cases_cum", "population", 4)),
            "lethality_rate": ratio_or_zero("deaths_cum", "cases_cum", 4),
            **{
                quota_column(i): per_population(round_ratio(dose_column(i) + "_cum", "population", 4))
                for i in dose_levels
            },
        }
    )
    helpers = ["_first_day"] if mask else []
    return derived.drop(*helpers, *([] if keep_frames else FRAMES))


__all__ = [
    "DOSE_LEVELS",
    "FRAMES",
    "after_onset",
    "cumulate",
    "dose_column",
    "incidence",
    "indicators",
    "quota_column",
]
