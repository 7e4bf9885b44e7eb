"""Completeness, uniqueness and match checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.operators.spine import date_spine, day_bounds, present


class DataCheckError(ValueError):
    """A check that must hold does not."""


def require_empty(offenders: DataFrame, message: str, show: int = 20) -> None:
    """Raise with the first few offending rows if there are any."""
    rows = offenders.limit(show).collect()
    if rows:
        raise DataCheckError(f"{message}: {[tuple(r) for r in rows]}")


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Keys occurring more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows")).filter("n_rows > 1")


def unmatched_keys(left: DataFrame, right: DataFrame, on: str | Sequence[str]) -> DataFrame:
    """Distinct keys of ``left`` that ``right`` lacks."""
    keys = [on] if isinstance(on, str) else list(on)
    return left.select(*keys).distinct().join(right.select(*keys).distinct(), keys, "left_anti")


def total_lookup(left: DataFrame, right: DataFrame, on: str, message: str) -> DataFrame:
    """Left join that must find every key; raises with the keys it misses."""
    require_empty(unmatched_keys(present(left, on), right, on), message)
    return left.join(right, on, "left")


def profile_time_series(df: DataFrame, key: str, day: str = "day") -> DataFrame:
    """First and last day, days expected and present, keys present, rows.

    Distinct counts run on the (key, day) pairs, which are reduced before the shuffle;
    counting them on the raw rows would expand every row once per count.
    """
    pairs = df.groupBy(key, day).agg(F.count("*").alias("n"))
    return pairs.agg(
        F.min(day).alias("first_day"),
        F.max(day).alias("last_day"),
        (F.datediff(F.max(day), F.min(day)) + 1).cast("bigint").alias("expected_days"),
        F.count_distinct(day).alias("n_days"),
        F.count_distinct(key).alias("n_keys"),
        F.sum("n").alias("n_rows"),
    )


def missing_days(df: DataFrame, day: str = "day") -> DataFrame:
    """Days between the first and the last on which there is no row."""
    seen = present(df.select(day), day).distinct()
    lo, hi = day_bounds(df, day)
    return date_spine(df.sparkSession, lo, hi, day).join(seen, day, "left_anti")


def missing_days_by_key(df: DataFrame, key: str, day: str = "day") -> DataFrame:
    """Days present and missing between the first and the last of each key, and the gaps they form.

    One aggregation: the days of a key are bits of a map, so counting them needs neither a distinct nor an
    expanded row per count.  A map holds 32,768 days; keys whose days lie further apart have several.
    """
    number = F.unix_date(day)
    maps = present(df, key, day).groupBy(key, F.bitmap_bucket_number(number).alias("_map")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("_bits"),
        F.min(number).alias("_first"), F.max(number).alias("_last"), F.count("*").alias("n_rows"),
    )
    # The days of a map in order: bits that are set, eight to a byte, the lowest first.
    byte = "cast(conv(hex(substr(_bits, cast(p div 8 + 1 as int), 1)), 16, 10) as int)"
    position = "bitmap_bit_position(d)"
    days = F.expr(
        "filter(sequence(_first, _last), d -> "
        + f"(shiftright({byte}, cast(p % 8 as int)) & 1) = 1".replace("p div", f"{position} div").replace("p %", f"{position} %")
        + ")"
    )
    listed = maps.select(key, "n_rows", F.bitmap_count("_bits").alias("n"), days.alias("days"))
    whole = listed.groupBy(key).agg(
        F.sum("n_rows").alias("n_rows"), F.sum("n").alias("n_days"),
        F.sort_array(F.flatten(F.collect_list("days"))).alias("days"),
    )
    steps = F.expr("transform(sequence(1, size(days)), i -> coalesce(get(days, i) - get(days, i - 1), 1) - 1)")
    return whole.select(key, "n_rows", "n_days", "days", steps.alias("_steps")).select(
        key,
        F.date_from_unix_date(F.expr("days[0]")).alias("first_day"),
        F.date_from_unix_date(F.expr("days[size(days) - 1]")).alias("last_day"),
        "n_rows",
        "n_days",
        F.aggregate("_steps", F.lit(0), lambda a, x: a + x).cast("bigint").alias("n_missing"),
        F.size(F.filter("_steps", lambda x: x > 0)).alias("n_gaps"),
        F.array_max("_steps").alias("longest_gap"),
    )


def profile_nulls(df: DataFrame) -> DataFrame:
    """Columns with nulls and how many, most first; one pass over the data."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    tall = counts.unpivot([], list(df.columns), "column_name", "n_nulls")
    return tall.filter("n_nulls > 0").orderBy(F.desc("n_nulls"), "column_name")


def distinct_counts(df: DataFrame, *columns: str) -> DataFrame:
    """Exact number of distinct values per column, on combinations reduced beforehand."""
    return df.select(*columns).distinct().agg(*[F.count_distinct(c).alias("n_" + c) for c in columns])
