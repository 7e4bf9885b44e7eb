"""Delimited files to typed DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.functions import day_from_parts, day_from_text
from regiopanel.sources.archives import read_zip_member
from regiopanel.sources.feeds import Feed


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def parse_value(text: Column, kind: str) -> Column:
    """Typed value of a text field; null if it does not read as ``kind``."""
    if kind == "string":
        return text
    if kind == "day":
        return day_from_text(text)
    if kind == "german_day":
        return day_from_parts(text)
    if kind in {"int", "bigint"}:
        # a count written as 12.0 is the whole number 12
        return F.regexp_replace(F.trim(text), r"\.0+$", "").try_cast(kind)
    return F.trim(text).try_cast(kind)


def apply_types(
    raw: DataFrame, columns: Mapping[str, tuple[str, str]], error_column: str | None = None
) -> DataFrame:
    """Select, rename and type all-text columns.

    ``error_column`` counts the fields of a row that hold text which cannot be read; an
    absent field of a short row is no error.
    """
    typed = {name: parse_value(F.col(f"`{source}`"), kind) for source, (name, kind) in columns.items()}
    out = [value.alias(name) for name, value in typed.items()]
    if error_column:
        failed = [
            (F.col(f"`{source}`").isNotNull() & typed[name].isNull()).cast("int")
            for source, (name, _) in columns.items()
        ]
        total = failed[0]
        for flag in failed[1:]:
            total = total + flag
        out.append(total.alias(error_column))
    return raw.select(*out)


def read_text_columns(
    spark: SparkSession, path: str, sep: str = ",", quote: str = '"', names: Sequence[str] | None = None
) -> DataFrame:
    """Delimited file as text columns.

    Without ``names`` the header gives them (only its line is read ahead, nothing is
    inferred); with ``names`` the layout is positional and the header is skipped.  Short
    rows are padded with nulls.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("quote", quote).option("encoding", "UTF-8")
    if names is not None:
        return reader.schema(", ".join(f"`{n}` STRING" for n in names)).csv(path)
    return lowercase_columns(reader.csv(path))


def read_feed(spark: SparkSession, feed: Feed, error_column: str | None = None) -> DataFrame:
    """One feed under its canonical names and types; raises if a column is absent."""
    if feed.member:
        raw = read_zip_member(spark, feed.path, feed.member, list(feed.columns), feed.sep, feed.quote)
    else:
        raw = read_text_columns(spark, feed.path, feed.sep, feed.quote)
    for short, full in feed.aliases.items():
        if short in raw.columns and full not in raw.columns:
            raw = raw.withColumnRenamed(short, full)
    absent = [c for c in feed.columns if c not in raw.columns]
    if absent:
        raise ValueError(f"{feed.path} lacks the columns {absent}")
    return apply_types(raw, feed.columns, error_column)


def read_declared(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, tuple[str, str]],
    sep: str = ",",
    quote: str = '"',
    error_column: str | None = "n_errors",
) -> DataFrame:
    """File with a declared positional layout, with the number of unreadable fields per row."""
    raw = read_text_columns(spark, path, sep, quote, names=list(columns))
    return apply_types(raw, columns, error_column)


def load_feeds(
    spark: SparkSession, feeds: Mapping[str, Feed], error_column: str | None = None
) -> dict[str, DataFrame]:
    return {name: read_feed(spark, feed, error_column) for name, feed in feeds.items()}
