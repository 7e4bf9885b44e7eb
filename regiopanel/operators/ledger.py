"""What a run reads against what its tables hold and what it leaves out, feed by feed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEVELS = ("region", "state", "country")
# Reasons that hold for a level only: a dose without a place is counted for the country.
NOT_IN_COUNTRY = "no known place"


def amounts(df: DataFrame, feeds: Mapping[str, Column]) -> DataFrame:
    """(feed, amount): the sum of a column per feed, all from one pass over ``df``."""
    sums = df.agg(*[F.coalesce(F.sum(c.cast("bigint")), F.lit(0)).alias(name) for name, c in feeds.items()])
    return sums.unpivot([], list(feeds), "feed", "amount")


def held(table: DataFrame, dose_columns: list[str]) -> DataFrame:
    """(feed, amount) that a level's table holds; rows that repeat others as a subtotal don't count."""
    if "is_subtotal" in table.columns:
        table = table.filter(~F.col("is_subtotal"))
    doses = reduce(Column.__add__, [F.col(c) for c in dose_columns]) if dose_columns else F.lit(0)
    return amounts(table, {"cases": F.col("cases"), "deaths": F.col("deaths"), "doses": doses})


def ledger(read: DataFrame, in_table: DataFrame, left_out: DataFrame, level: str) -> DataFrame:
    """(level, feed, n_read, in_table, left_out, difference); a difference is counts nobody can account for.

    ``read`` and ``in_table`` are (feed, amount), ``left_out`` is (feed, reason, amount).
    """
    reasons = left_out.filter(F.col("reason") != NOT_IN_COUNTRY) if level == "country" else left_out
    parts = {
        "n_read": read,
        "in_table": in_table,
        "left_out": reasons.groupBy("feed").agg(F.sum("amount").alias("amount")),
    }
    tall = None
    for name, df in parts.items():
        row = df.select("feed", *[(F.col("amount") if n == name else F.lit(0)).cast("bigint").alias(n) for n in parts])
        tall = row if tall is None else tall.unionByName(row)
    sums = tall.groupBy("feed").agg(*[F.sum(n).alias(n) for n in parts])
    gone = F.col("n_read") - F.col("in_table") - F.col("left_out")
    return sums.select(F.lit(level).alias("level"), "feed", *parts, gone.alias("difference"))
