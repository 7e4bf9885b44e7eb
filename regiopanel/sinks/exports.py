"""Formatted delimited exports."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from regiopanel.functions import day_text, decimal_comma, padded_key, percent_text, plain_decimal


def formatted(
    df: DataFrame,
    decimal_mark: str = ",",
    german_days: bool = False,
    percent: Iterable[str] = (),
    padded: Mapping[str, int] | None = None,
    untouched: Iterable[str] = (),
) -> DataFrame:
    """Every column as the text it is exported as, but for those ``untouched``."""
    shares, widths, untouched = set(percent), dict(padded or {}), set(untouched)
    out = []
    for name, kind in ((f.name, f.dataType) for f in df.schema.fields):
        if name in untouched:
            column = df[name]
        elif name in shares:
            column = percent_text(name)
        elif name in widths:
            column = padded_key(name, widths[name])
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            column = decimal_comma(name) if decimal_mark == "," else plain_decimal(name)
        elif isinstance(kind, T.DateType) and german_days:
            column = day_text(name)
        else:
            column = df[name].cast("string")
        out.append(column.alias(name))
    return df.select(*out)


def write_delimited(df: DataFrame, path: str, sep: str = ";", header: bool = True) -> None:
    """Write text columns; one file per partition, as one file would pass one task."""
    df.write.mode("overwrite").option("sep", sep).option("header", header).option("encoding", "UTF-8").csv(path)


def write_ordered(
    df: DataFrame,
    path: str,
    by: Sequence[str],
    header: Sequence[str],
    sep: str = ";",
) -> None:
    """Write the text columns named in ``header`` as lines in the order of ``by``, after one line of names.

    The rows are dealt to tasks by ranges of their keys, and the names of the files keep the order of the
    ranges: put together by name they are one sorted file with one header, though no task saw all rows.
    """
    style = {"sep": sep, "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    keys = [F.col(f"`{c}`").alias(f"_key_{i}") for i, c in enumerate(by)]
    lines = df.select(F.lit(1).alias("_part"), *keys, F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header]), style).alias("value"))
    names = F.to_csv(F.struct(*[F.lit(c).alias(f"c{i}") for i, c in enumerate(header)]), style)
    first = df.sparkSession.range(1).select(
        F.lit(0).alias("_part"), *[F.lit(None).cast(lines.schema[k].dataType).alias(k) for k in lines.columns[1:-1]],
        names.alias("value"),
    )
    ordered = first.unionByName(lines).orderBy(*lines.columns[:-1])
    ordered.select("value").write.mode("overwrite").option("encoding", "UTF-8").text(path)


def read_ordered(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a file that was written in parts, numbered from 1 through all of them.

    Lines of a block follow each other in one task.  Numbers of lines are summed over the blocks, one row each.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_name").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
    )
    blocks = lines.groupBy("file", "block").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    before = Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return lines.join(blocks, ["file", "block"]).select(
        (F.col("before") + F.col("at") - F.col("first") + 1).alias("line_no"), "line"
    )


def export_levels(
    tables: Mapping[str, tuple[DataFrame, Sequence[str]]],
    folder: str,
    decimal_mark: str = ",",
    german_days: bool = False,
    percent: Iterable[str] = (),
    padded: Mapping[str, int] | None = None,
) -> dict[str, str]:
    """Export each table, given with the columns it is ordered by, below ``folder`` under its name; returns the paths."""
    shares, widths = list(percent), dict(padded or {})
    paths = {}
    for name, (table, by) in tables.items():
        here = {k: w for k, w in widths.items() if k in table.columns}
        keyed = table.select("*", *[table[c].alias(f"_by_{i}") for i, c in enumerate(by)])
        order = keyed.columns[len(table.columns) :]
        text = formatted(
            keyed, decimal_mark, german_days, [c for c in shares if c in table.columns], here, untouched=order
        )
        paths[name] = f"{folder.rstrip('/')}/{name}.csv"
        write_ordered(text, paths[name], order, table.columns)
    return paths
