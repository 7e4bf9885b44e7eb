"""A newer snapshot of a feed against the one before, and a table brought up to date from the difference.

A report of a day changes the trailing frames of the day before to the ninth day after it, and all running
totals from it on.  Rows before stay as they are, and so do regions without a change.  What is computed
anew starts from the totals of the old table, so neither old reports nor whole panels are read again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.operators.indicators import indicators
from regiopanel.operators.rollup import attach_attributes
from regiopanel.operators.spine import Bound, _bound, present, sum_by
from regiopanel.operators.windows import FRAMES

# Days around a report whose frames hold it, and days that the frames of such a day reach back.
BEFORE = max(hi for _, hi in FRAMES.values())
REACH = -min(lo for lo, _ in FRAMES.values())


def row_digests(fact: DataFrame, keys: Sequence[str] = ("geo", "day")) -> DataFrame:
    """Number of rows of each key and a sum of their hashes, which doesn't depend on their order."""
    hashed = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(fact.columns)]).cast("decimal(20,0)")
    return present(fact, *keys).groupBy(*keys).agg(F.count("*").alias("n_rows"), F.sum(hashed).alias("digest"))


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str] = ("geo", "day")) -> DataFrame:
    """Keys whose rows differ between two snapshots: added, changed or withdrawn."""
    old = row_digests(before, keys).withColumnsRenamed({"n_rows": "_rows", "digest": "_digest"})
    both = row_digests(after, keys).join(old, list(keys), "full")
    kind = (
        F.when(F.col("_rows").isNull(), "added")
        .when(F.col("n_rows").isNull(), "withdrawn")
        .when((F.col("n_rows") != F.col("_rows")) | (F.col("digest") != F.col("_digest")), "changed")
    )
    return present(both.select(*keys, kind.alias("change")), "change")


def first_touched(
    changes: DataFrame, table: DataFrame, start: Bound, end: Bound, geo: str = "geo", day: str = "day"
) -> DataFrame:
    """(geo, first day whose row is computed anew): from a region's first change on, or where the old days end.

    A region that the old table lacks is new from ``start`` on.
    """
    lo, hi = _bound(start), _bound(end)
    known = table.groupBy(geo).agg(F.max(day).alias("_until"))
    changed = changes.groupBy(geo).agg(F.min(day).alias("_change"))
    found = known.join(changed, geo, "full")
    grown = F.when(F.col("_until") < hi, F.date_add("_until", 1))
    first = F.when(F.col("_until").isNull(), lo).otherwise(F.date_sub(F.least("_change", grown), BEFORE))
    # greatest() would make the start of a null: a region without a change stays untouched
    found = present(found.select(geo, first.alias("first_day")), "first_day")
    return found.select(geo, F.greatest("first_day", lo).alias("first_day"))


def _dense_from(sums: DataFrame, end: Column, measures: Sequence[str], geo: str, day: str) -> DataFrame:
    """A row for each day from a region's first row to ``end``, zero where there is none."""
    by_day = Window.partitionBy(geo).orderBy(day)
    until = F.coalesce(F.date_sub(F.lead(day).over(by_day), 1), end)
    filled = sums.withColumn("_until", until)
    days = F.explode(F.when(F.col("_until") >= F.col(day), F.sequence(day, "_until")))
    filled = filled.select(geo, F.col(day).alias("_of"), *measures, days.alias(day))
    zero = F.lit(0).cast("bigint")
    return filled.select(geo, day, *[F.when(F.col(day) == F.col("_of"), F.col(m)).otherwise(zero).alias(m) for m in measures])


def recomputed(
    table: DataFrame,
    fact: DataFrame,
    touched: DataFrame,
    attributes: DataFrame,
    measures: Sequence[str],
    start: Bound,
    end: Bound,
    dose_levels: Sequence[int] = (),
    geo: str = "geo",
    day: str = "day",
    **options,
) -> DataFrame:
    """Rows of the touched regions from their first day on, computed from the new facts and the old totals.

    The panel of a region starts as many days earlier as its frames reach back.  A row before it carries the
    totals up to there, which no change has touched; it counts as reports of one day, so it is left out again.
    """
    lo, hi = _bound(start), _bound(end)
    base = touched.select(geo, "first_day", F.greatest(F.date_sub("first_day", REACH + 1), lo).alias("_base"))
    inside = present(fact, geo, day).join(base, geo).filter(F.col(day).between(F.col("_base"), hi))
    sums = sum_by(inside, measures, (geo, day))
    totals = table.select(geo, F.date_add(day, 1).alias("_base"), *[F.col(m + "_cum").alias(m) for m in measures])
    zero = F.lit(0).cast("bigint")
    carried = base.join(totals, [geo, "_base"], "left").select(
        geo, F.date_sub("_base", 1).alias(day), *[F.coalesce(m, zero).alias(m) for m in measures]
    )
    panel = _dense_from(sums.unionByName(carried), hi, measures, geo, day)
    rows = indicators(attach_attributes(panel, attributes, geo), geo, day, dose_levels, **options)
    return rows.join(touched, geo).filter(F.col(day) >= F.col("first_day")).drop("first_day")


def corrected(
    table: DataFrame,
    before: DataFrame,
    after: DataFrame,
    attributes: DataFrame,
    measures: Sequence[str],
    start: Bound,
    end: Bound,
    dose_levels: Sequence[int] = (),
    geo: str = "geo",
    day: str = "day",
    **options,
) -> DataFrame:
    """The table of the newer snapshot, made of the old one; ``is_recomputed`` tells the rows that are new.

    ``table`` was made of ``before`` for days from the same ``start`` on, with the same options; ``end`` may have
    moved on.  A region that has no rows in the new snapshot any more keeps its days with zeros.
    """
    lo, hi = _bound(start), _bound(end)
    changes = snapshot_changes(before.select(geo, day, *measures), after.select(geo, day, *measures), (geo, day))
    changes = changes.filter(F.col(day).between(lo, hi))
    touched = first_touched(changes, table, start, end, geo, day)
    new = recomputed(table, after, touched, attributes, measures, start, end, dose_levels, geo, day, **options)
    # A plain left join and a filter: few regions are touched, and Spark broadcasts them where they are.
    old = table.join(touched, geo, "left")
    old = old.filter(F.col("first_day").isNull() | (F.col(day) < F.col("first_day"))).drop("first_day")
    marked = new.select(*table.columns).withColumn("is_recomputed", F.lit(True))
    return old.withColumn("is_recomputed", F.lit(False)).unionByName(marked)
