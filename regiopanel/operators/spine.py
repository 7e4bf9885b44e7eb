"""Day spines and dense region-by-day panels."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

Bound = date | str | Column

# Rows of a dense panel that one task sorts, on average: some 120 MB.
TASK_ROWS = 1 << 20


def _bound(value: Bound) -> Column:
    return value if isinstance(value, Column) else F.lit(value).cast("date")


def present(df: DataFrame, *columns: str) -> DataFrame:
    """Rows without nulls in the columns; as plain conditions, which reach the file scan."""
    for column in columns:
        df = df.filter(F.col(column).isNotNull())
    return df


def day_bounds(fact: DataFrame, day: str = "day") -> tuple[Column, Column]:
    """First and last day of a fact as scalar subqueries, so no value visits the driver."""
    limits = fact.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return limits.select("lo").scalar(), limits.select("hi").scalar()


def day_span(fact: DataFrame, day: str = "day") -> DataFrame:
    """First and last day of a fact as two rows, worth storing where many plans need the bounds."""
    limits = fact.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return limits.select(F.explode(F.array("lo", "hi")).alias(day))


def panel_days(
    start: Bound | None, end: Bound | None, days_of: DataFrame | None, day: str = "day"
) -> tuple[Column, Column]:
    """First and last day of a panel: the given ones, else those of ``days_of``.

    Everything that tells which days a panel holds must take them from here.
    """
    lo, hi = day_bounds(days_of, day) if days_of is not None else (None, None)
    return _bound(start) if start is not None else lo, _bound(end) if end is not None else hi


def panel_tasks(fact: DataFrame, geo: str = "geo", day: str = "day") -> int | None:
    """Over how many tasks to deal a dense panel whose keys grow with the data; None if one is enough.

    One pass over two columns.  Spark sizes tasks by the sparse rows they read, but each sorts the dense rows
    made of them.
    """
    size = fact.agg(
        F.approx_count_distinct(geo).alias("keys"), (F.datediff(F.max(day), F.min(day)) + 1).alias("days")
    ).first()
    tasks = math.ceil(size.keys * (size.days or 0) / TASK_ROWS)
    return max(tasks, fact.sparkSession.sparkContext.defaultParallelism) if tasks > 1 else None


def _days(start: Column, end: Column) -> Column:
    """Each day between the bounds as a row; none where they are in the wrong order."""
    return F.explode(F.when(start <= end, F.sequence(start, end)))


def date_spine(spark: SparkSession, start: Bound, end: Bound, day: str = "day") -> DataFrame:
    """Every day from ``start`` to ``end``, both included."""
    return spark.range(1).select(_days(_bound(start), _bound(end)).alias(day))


def distinct_keys(fact: DataFrame, *keys: str) -> DataFrame:
    return present(fact.select(*keys), *keys).distinct()


def spine_grid(keys: DataFrame, start: Bound, end: Bound, day: str = "day") -> DataFrame:
    """Each key on each day.  Days are exploded per key, so the grid stays as distributed as the keys."""
    return keys.select("*", _days(_bound(start), _bound(end)).alias(day))


def stack_facts(
    primary: DataFrame,
    *others: DataFrame,
    keys: Sequence[str] = ("geo", "day"),
    anchor: str = "is_primary",
) -> DataFrame:
    """Put count feeds under each other so that one aggregation sums them all.

    The keys of the panel are those of ``primary``; its rows are marked in ``anchor``.
    """
    stacked = primary.withColumn(anchor, F.lit(True))
    for other in others:
        stacked = stacked.unionByName(other.withColumn(anchor, F.lit(False)), allowMissingColumns=True)
    return present(stacked, *keys)


def sum_by(fact: DataFrame, measures: Sequence[str], keys: Sequence[str] = ("geo", "day")) -> DataFrame:
    """Group sums; a sum over nothing is 0."""
    zero = F.lit(0).cast("bigint")
    return fact.groupBy(*keys).agg(*[F.coalesce(F.sum(F.col(m).cast("bigint")), zero).alias(m) for m in measures])


def dense_panel(
    fact: DataFrame,
    measures: Sequence[str],
    geo: str = "geo",
    day: str = "day",
    start: Bound | None = None,
    end: Bound | None = None,
    anchor: str | None = None,
    days_of: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """One zero-filled row per region and day with the summed measures.

    The sparse sums are shuffled once by region; each of their rows then emits the
    days since its predecessor.  The dense rows are never joined or shuffled, and the
    result is partitioned by region for the windows that follow.

    A fact outside a given ``start`` or ``end`` counts 0 but keeps its region in the
    panel.  With ``anchor``, only regions having a row marked there are kept, and days
    beyond those of the marked rows are left out.  A bound that is not given is the first
    or last day of ``days_of``: a cheaper source of the same days, such as one column of
    the raw table, or else the facts themselves.  The regions are dealt over ``tasks`` (see ``panel_tasks``),
    or as Spark chooses, which is enough for a bounded number of them.
    """
    known = present(fact, geo, day)
    if days_of is None and (start is None or end is None):
        days_of = known.filter(F.col(anchor)) if anchor else known
    lo, hi = panel_days(start, end, days_of, day)

    if start is not None or end is not None:
        inside, clamped = F.lit(True), F.col(day)
        if start is not None:
            inside, clamped = inside & (F.col(day) >= lo), F.greatest(lo, clamped)
        if end is not None:
            inside, clamped = inside & (F.col(day) <= hi), F.least(hi, clamped)
        known = known.select(
            geo,
            clamped.alias(day),
            *[F.when(inside, F.col(m)).alias(m) for m in measures],
            *([anchor] if anchor else []),
        )
    if tasks:
        # Nearly each row is a sum of its own: aggregated where it is read, a file's part would be held in memory.
        known = known.repartition(tasks, geo, day)
    zero = F.lit(0).cast("bigint")
    sums = known.groupBy(geo, day).agg(
        *[F.coalesce(F.sum(F.col(m).cast("bigint")), zero).alias(m) for m in measures],
        *([F.max(anchor).alias(anchor)] if anchor else []),
    )
    if anchor:
        sums = sums.filter(F.col(day).between(lo, hi))
    if tasks:
        sums = sums.repartition(tasks, geo)

    by_day = Window.partitionBy(geo).orderBy(day)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    gaps = sums.select(
        "*",
        F.lag(day).over(by_day).alias("_before"),
        F.lead(day).over(by_day).isNull().alias("_last"),
        *([F.max(anchor).over(whole).alias("_kept")] if anchor else []),
    )
    if anchor:
        gaps = gaps.filter("_kept")
    first = F.coalesce(F.date_add("_before", 1), lo)
    last = F.when(F.col("_last"), hi).otherwise(F.col(day))
    filled = gaps.select(geo, day, *measures, _days(first, last).alias("_day"))
    on_day = F.col("_day") == F.col(day)
    return filled.select(
        geo,
        F.col("_day").alias(day),
        *[F.when(on_day, F.col(m)).otherwise(zero).alias(m) for m in measures],
    )


def outside_spine(
    fact: DataFrame, start: Bound | None, end: Bound | None, geo: str = "geo", day: str = "day"
) -> DataFrame:
    """Facts a panel over ``start .. end`` does not count, per region and day."""
    stray = F.lit(False)
    if start is not None:
        stray = stray | (F.col(day) < _bound(start))
    if end is not None:
        stray = stray | (F.col(day) > _bound(end))
    return fact.filter(stray).groupBy(geo, day).agg(F.count("*").alias("n_rows"))


def zero_fill_by_union(
    fact: DataFrame,
    measures: Sequence[str],
    start: Bound,
    end: Bound,
    geo: str = "geo",
    day: str = "day",
) -> DataFrame:
    """Panel by stacking a grid of zeros on the facts and summing.

    Unlike ``dense_panel`` this keeps facts outside the spine as rows of their own.
    """
    grid = spine_grid(distinct_keys(fact, geo), start, end, day)
    zeros = grid.select("*", *[F.lit(0).cast("bigint").alias(m) for m in measures])
    counts = sum_by(present(fact, geo, day), measures, (geo, day))
    return sum_by(counts.unionByName(zeros), measures, (geo, day))
