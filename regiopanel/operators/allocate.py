"""Share out totals of a parent over its members, and add parent rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.functions import ratio_or_zero


def allocate_proportional(
    totals: DataFrame,
    members: DataFrame,
    measures: Sequence[str],
    parent: str = "parent",
    member: str = "geo",
    weight: str = "population",
    day: str = "day",
) -> DataFrame:
    """Split daily totals of each parent over its members in proportion to a weight.

    Shares are rounded to whole numbers; the member with the highest key takes what
    is left, so the members always add up to the total.

    ``totals`` is unique in (parent, day), ``members`` in member.  The last member is
    the total less the other shares, so only those shares are summed (partially before
    the shuffle) and no member row has to be looked up again; a parent with very many
    members is never gathered in one task.
    """
    zero = F.lit(0).cast("bigint")
    weighted = members.select(
        parent, F.col(member).alias("_member"), F.coalesce(F.col(weight).cast("bigint"), zero).alias("_weight")
    )
    parents = weighted.groupBy(parent).agg(F.sum("_weight").alias("_all"), F.max("_member").alias("_last"))
    known = totals.select(parent, day, *[F.coalesce(F.col(m).cast("bigint"), zero).alias(m) for m in measures])
    known = known.join(parents, parent)

    shares = known.join(weighted, parent).filter(F.col("_member") != F.col("_last"))
    shares = shares.select(
        parent,
        F.col("_member").alias(member),
        day,
        *[ratio_or_zero(f"`{m}`", "_all", 0, times="_weight").cast("bigint").alias(m) for m in measures],
    )
    taken = shares.groupBy(parent, day).agg(*[F.sum(m).alias("_" + m) for m in measures])
    rest = known.join(taken, [parent, day], "left").select(
        parent,
        F.col("_last").alias(member),
        day,
        *[(F.col(m) - F.coalesce(F.col("_" + m), zero)).alias(m) for m in measures],
    )
    return shares.unionByName(rest)


def allocation_residuals(
    totals: DataFrame,
    members: DataFrame,
    measures: Sequence[str],
    parent: str = "parent",
    member: str = "geo",
    weight: str = "population",
    day: str = "day",
) -> DataFrame:
    """Total, sum of the rounded shares and their difference per parent and day."""
    zero = F.lit(0).cast("bigint")
    weighted = members.select(parent, F.coalesce(F.col(weight).cast("bigint"), zero).alias("_weight"))
    parents = weighted.groupBy(parent).agg(F.sum("_weight").alias("_all"))
    shares = totals.join(parents, parent).join(weighted, parent)
    sums = shares.groupBy(parent, day).agg(
        *[F.max(m).cast("bigint").alias(m) for m in measures],
        *[
            F.sum(ratio_or_zero(f"`{m}`", "_all", 0, times="_weight").cast("bigint")).alias(m + "_shares")
            for m in measures
        ],
    )
    return sums.withColumns({m + "_residual": F.col(m) - F.col(m + "_shares") for m in measures})


def append_subtotal(
    panel: DataFrame,
    is_member: Column,
    key: int,
    labels: dict[str, str],
    sums: Sequence[str],
    geo: str = "geo",
    day: str = "day",
    flag: str = "is_subtotal",
) -> DataFrame:
    """Append a daily row summing some members under a key of its own.

    The rows are told apart by ``flag``, which every roll-up excludes.  Attributes not
    given in ``labels`` take the members' highest value (their common parent).
    """
    others = [c for c in panel.columns if c not in {geo, day, *sums, *labels}]
    summed = (
        panel.filter(is_member)
        .groupBy(day)
        .agg(*[F.sum(c).alias(c) for c in sums], *[F.max(c).alias(c) for c in others])
        .withColumns({geo: F.lit(key).cast(panel.schema[geo].dataType), flag: F.lit(True)})
        .withColumns({name: F.lit(text) for name, text in labels.items()})
    )
    return panel.withColumn(flag, F.lit(False)).unionByName(summed)
