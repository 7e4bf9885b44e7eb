"""Mobility, intensive care and hospital series on the panels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import round_ratio
from regiopanel.operators.indicators import PER_INHABITANTS
from regiopanel.operators.quality import duplicate_keys, require_empty

MOBILITY = ("mobility_change", "mobility_change_7day_average", "mobility_change_weekly")
ICU_SUMS = ("icu_cases", "beds_free", "beds_occupied", "icu_ventilated")
ICU = ("icu_share", "icu_cases", "icu_ventilated")


def enrich(
    panel: DataFrame,
    feed: DataFrame,
    on: Sequence[str],
    columns: Sequence[str],
    fill: float | None = None,
    check: bool = False,
) -> DataFrame:
    """Left join feed columns; unmatched rows stay null unless ``fill`` is given.

    ``check`` runs a job that raises if the feed is not unique in its key, which would
    multiply panel rows.
    """
    if check:
        require_empty(duplicate_keys(feed, *on), f"feed is not unique in {tuple(on)}")
    joined = panel.join(feed.select(*on, *columns), list(on), "left")
    return joined if fill is None else joined.fillna(fill, subset=list(columns))


def merge_feeds(on: Sequence[str], *feeds: DataFrame) -> DataFrame:
    """Feeds with the same key side by side, so that a panel is joined to them once."""
    merged = feeds[0]
    for feed in feeds[1:]:
        merged = merged.join(feed, list(on), "full")
    return merged


def with_suffix(feed: DataFrame, columns: Sequence[str], suffix: str = "_parent") -> DataFrame:
    return feed.withColumnsRenamed({c: c + suffix for c in columns})


def mobility_by_region(mobility: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Mobility of each region key, from a series keyed by regional code."""
    return mobility.join(crosswalk, "nuts").drop("nuts")


def icu_occupancy(icu: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Share of beds taken by cases, as a ratio of sums over whatever ``keys`` combine."""
    sums = icu.groupBy(*keys).agg(*[F.sum(F.col(c).cast("bigint")).alias(c) for c in ICU_SUMS])
    share = round_ratio("icu_cases", "beds_free + beds_occupied", 4)
    return sums.select(*keys, share.alias("icu_share"), "icu_cases", "icu_ventilated")


def inherit_parent(
    panel: DataFrame,
    parent_feed: DataFrame,
    parent: str,
    columns: Sequence[str],
    suffix: str = "_parent",
    day: str = "day",
) -> DataFrame:
    """Values of the parent level on each child row, under suffixed names."""
    renamed = with_suffix(parent_feed.select(parent, day, *columns), columns, suffix)
    return panel.join(renamed, [parent, day], "left")


def hospital_incidence(
    hospital: DataFrame,
    population: DataFrame,
    level: str = "level_id",
    day: str = "day",
    age_groups: Sequence[str] | None = None,
) -> DataFrame:
    """Hospital cases per 100,000 inhabitants by level and day, ages summed.

    ``population`` has one row per level, the country under its own key.  Where a feed
    has a row for all ages beside the single groups, ``age_groups`` says which to sum.
    """
    counted = hospital if age_groups is None else hospital.filter(F.col("age_group").isin(*age_groups))
    sums = counted.groupBy(level, day).agg(F.sum(F.col("hospital_cases").cast("bigint")).alias("hospital_cases"))
    joined = sums.join(population, level, "left")
    value = round_ratio("hospital_cases", "population", 4, scale=PER_INHABITANTS)
    return joined.select(level, day, value.alias("hospital_incidence"))
