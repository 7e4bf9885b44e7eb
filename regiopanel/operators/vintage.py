"""Data vintages as constant columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest(source: DataFrame, day: str) -> Column:
    """Latest day of a source as a scalar subquery: one value, no join."""
    return source.agg(F.max(day)).scalar()


def stamp_vintage(df: DataFrame, day: str, name: str = "datenstand") -> DataFrame:
    """Put the latest day of the source itself on each of its rows."""
    return df.withColumn(name, latest(df, day))


def stamp_vintages(df: DataFrame, sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Put the latest day of several sources on each row, under the given names."""
    return df.withColumns({name: latest(source, day) for name, (source, day) in sources.items()})


def inherit_vintages(df: DataFrame, stamped: DataFrame, names: list[str]) -> DataFrame:
    """Take the vintages over from an output stamped before; they are constant there."""
    return df.withColumns({name: latest(stamped, name) for name in names})
