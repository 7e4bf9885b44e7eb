"""What a run reads but leaves out of its tables, with reasons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.operators.doses import UNKNOWN_PLACE
from regiopanel.operators.quality import duplicate_keys
from regiopanel.operators.spine import Bound, distinct_keys, present

UNREADABLE = ("no day", "no place", "unreadable place")


def _outside(day: str, lo: Bound, hi: Bound) -> Column:
    """Whether a day lies outside the bounds; an empty span has null bounds, and all is outside."""
    bounds = [v if isinstance(v, Column) else F.lit(v).cast("date") for v in (lo, hi)]
    return ~F.coalesce(F.col(day).between(*bounds), F.lit(False))


def left_out_doses(
    doses: DataFrame,
    listed: DataFrame,
    lo: Bound,
    hi: Bound,
    unknown: str = UNKNOWN_PLACE,
    levels: Sequence[int] | None = None,
    no_place: str | None = None,
) -> DataFrame:
    """Rows and doses per reason that no table counts; each row has at most one reason.

    ``listed`` holds the places of the panel in ``geo``, ``lo`` and ``hi`` are its days, ``levels`` the declared
    ones.  ``no_place`` names the reason of doses of the unknown place, which the country alone counts.  Rows
    are summed by place and day before they meet the places, so a place with most rows is a row a day.
    """
    place = F.trim("place")
    declared = F.lit(True) if levels is None else F.coalesce(F.col("status").isin(*levels), F.lit(False))
    sums = doses.groupBy(place.alias("place"), "day", declared.alias("_declared")).agg(
        F.count("*").alias("n_rows"), F.coalesce(F.sum(F.col("doses").cast("bigint")), F.lit(0)).alias("amount")
    )
    sums = sums.withColumn("geo", F.col("place").try_cast("int"))
    known = distinct_keys(listed, "geo").withColumn("_listed", F.lit(True))
    nowhere = F.col("place") != unknown
    reason = (
        F.when(F.col("day").isNull(), "no day")
        .when(F.col("place").isNull() | (F.col("place") == ""), "no place")
        .when(nowhere & F.col("geo").isNull(), "unreadable place")
        .when(nowhere & F.col("_listed").isNull(), "unlisted place")
        .when(_outside("day", lo, hi), "outside the days")
        .when(~F.col("_declared"), "undeclared level")
    )
    if no_place:
        reason = reason.when(~nowhere, no_place)
    found = sums.join(known, "geo", "left").select(reason.alias("reason"), "n_rows", "amount")
    return _summed(found)


def left_out_cases(cases: DataFrame, lo: Bound, hi: Bound, amount: str = "cases") -> DataFrame:
    """Rows and cases per reason that no table counts."""
    reason = (
        F.when(F.col("day").isNull(), "no day")
        .when(F.col("geo").isNull(), "no place")
        .when(_outside("day", lo, hi), "outside the days")
    )
    number = F.coalesce(F.col(amount).cast("bigint"), F.lit(0))
    return _summed(cases.select(reason.alias("reason"), F.lit(1).alias("n_rows"), number.alias("amount")))


def left_out(
    cases: DataFrame,
    doses: DataFrame,
    places: DataFrame,
    lo: Bound,
    hi: Bound,
    levels: Sequence[int] | None = None,
    no_place: str | None = None,
) -> DataFrame:
    """(feed, reason, n_rows, amount) of cases, deaths and doses, for a panel of these places and days."""
    tall = {
        "cases": left_out_cases(cases, lo, hi),
        "deaths": left_out_cases(cases, lo, hi, "deaths"),
        "doses": left_out_doses(doses, places, lo, hi, levels=levels, no_place=no_place),
    }
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("feed"), "*") for name, df in tall.items()])


def _summed(found: DataFrame) -> DataFrame:
    return present(found, "reason").groupBy("reason").agg(
        F.sum("n_rows").alias("n_rows"), F.sum("amount").alias("amount")
    )


def field_errors(feeds: dict[str, DataFrame], errors: str = "n_errors") -> DataFrame:
    """Rows with unreadable fields and the number of these fields, per feed that has any."""
    counted = [
        df.filter(F.col(errors) > 0)
        .agg(F.count("*").alias("n_rows"), F.sum(F.col(errors)).alias("n_fields"))
        .select(F.lit(name).alias("feed"), "*")
        for name, df in feeds.items()
    ]
    return reduce(DataFrame.unionByName, counted).filter("n_rows > 0")


def repeated_keys(feeds: dict[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """Keys that a feed holds more than once; rows without a whole key meet nothing and are no offence."""
    found = [
        duplicate_keys(present(df, *keys), *keys).select(
            F.lit(name).alias("feed"), F.concat_ws(" ", *[F.col(k).cast("string") for k in keys]).alias("key"), "n_rows"
        )
        for name, (df, keys) in feeds.items()
    ]
    return reduce(DataFrame.unionByName, found)
