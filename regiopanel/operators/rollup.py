"""Region to state to country."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import int_div
from regiopanel.operators.spine import present

# The state is the region key without its last three digits, the
# country has key 0.
DIGITS_PER_STATE = 1_000
COUNTRY = 0


def state_of(geo: Column | str = "geo") -> Column:
    return int_div(geo, DIGITS_PER_STATE).cast("int")


def _detail(panel: DataFrame, flag: str) -> DataFrame:
    return panel.filter(~F.col(flag)) if flag in panel.columns else panel


def attach_attributes(panel: DataFrame, regions: DataFrame, geo: str = "geo") -> DataFrame:
    """Population, names and parent of each region.

    A plain left join: Spark broadcasts the regions when their size is below its
    threshold and otherwise only moves them, as the panel is already partitioned by region.
    """
    return panel.join(regions, geo, "left")


def rollup_state(
    panel: DataFrame,
    sums: Sequence[str],
    states: DataFrame | None = None,
    state: str = "state",
    day: str = "day",
    flag: str = "is_subtotal",
) -> DataFrame:
    """Sums per state and day, with the state's name if ``states`` is given."""
    rolled = _detail(panel, flag).groupBy(state, day).agg(*[F.sum(c).alias(c) for c in sums])
    if states is None:
        return rolled
    names = present(states.select(state, "state_name"), state).distinct()
    return rolled.join(names, state, "left")


def rollup_country(
    panel: DataFrame, sums: Sequence[str], geo: str = "geo", day: str = "day", flag: str = "is_subtotal"
) -> DataFrame:
    """Sums per day under the country's key."""
    rolled = _detail(panel, flag).groupBy(day).agg(*[F.sum(c).alias(c) for c in sums])
    return rolled.select(F.lit(COUNTRY).cast("int").alias(geo), day, *sums)


def rollup_levels(
    panel: DataFrame, sums: Sequence[str], state: str = "state", day: str = "day", flag: str = "is_subtotal"
) -> DataFrame:
    """State and country sums from one pass over the panel; ``level`` tells them apart."""
    detail = _detail(panel, flag)
    grouped = detail.groupingSets(
        [[F.col(state), F.col(day)], [F.col(day)]], F.col(state), F.col(day)
    ).agg(F.grouping(state).alias("_all"), *[F.sum(c).alias(c) for c in sums])
    return grouped.select(
        F.when(F.col("_all") == 1, "country").otherwise("state").alias("level"), state, day, *sums
    )


def population_by_level(
    regions: DataFrame, state: str = "state", population: str = "population"
) -> DataFrame:
    """Population of every state and, under the country's key, of all of them."""
    summed = regions.rollup(state).agg(F.grouping(state).alias("_all"), F.sum(population).alias("population"))
    is_country = F.col("_all") == 1
    level = F.when(is_country, F.lit(COUNTRY)).otherwise(F.col(state)).cast("int")
    return present(summed.select(level.alias("level_id"), "population"), "level_id")
