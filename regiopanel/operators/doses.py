"""Dose counts per status level and place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.operators.indicators import DOSE_LEVELS, dose_column

# Fixed value: place key of doses whose region is not known.
UNKNOWN_PLACE = "u"


def doses_by_status(
    doses: DataFrame,
    keys: Sequence[str] = ("geo", "day"),
    status: str = "status",
    amount: str = "doses",
    levels: Sequence[int] = DOSE_LEVELS,
) -> DataFrame:
    """One column of summed doses per status level.

    Conditional sums over declared levels need a single aggregation and no job to
    discover them; ``unexpected_levels`` tells whether the data holds others.
    """
    zero = F.lit(0).cast("bigint")
    return doses.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col(status) == i, F.coalesce(F.col(amount).cast("bigint"), zero)).otherwise(zero)).alias(
                dose_column(i)
            )
            for i in levels
        ]
    )


def unexpected_levels(doses: DataFrame, status: str = "status", levels: Sequence[int] = DOSE_LEVELS) -> DataFrame:
    """Status values outside the declared levels with their row counts."""
    stray = doses.filter(F.col(status).isNull() | ~F.col(status).isin(*levels))
    return stray.groupBy(status).agg(F.count("*").alias("n_rows"))


def known_places(doses: DataFrame, place: str = "place", unknown: str = UNKNOWN_PLACE) -> DataFrame:
    """Doses with a known region; the key becomes a number in ``geo``."""
    known = doses.filter(F.trim(place) != unknown)
    return known.withColumn("geo", F.col(place).try_cast("int")).drop(place)


def unknown_places(doses: DataFrame, place: str = "place", unknown: str = UNKNOWN_PLACE) -> DataFrame:
    return doses.filter(F.trim(place) == unknown).drop(place)


def add_unknown_place_doses(
    country: DataFrame,
    unknown: DataFrame,
    day: str = "day",
    levels: Sequence[int] = DOSE_LEVELS,
) -> DataFrame:
    """Add doses without a region to the country panel, each status to its own column.

    ``unknown`` is sparse, (day, doses_<level>...), at most one row per day.
    """
    columns = [dose_column(i) for i in levels]
    extra = unknown.select(day, *[F.col(c).alias("_" + c) for c in columns])
    joined = country.join(extra, day, "left")
    added = {c: F.col(c) + F.coalesce(F.col("_" + c), F.lit(0).cast("bigint")) for c in columns}
    return joined.withColumns(added).select(*country.columns)
