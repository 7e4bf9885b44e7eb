"""Delimited members of zip archives."""

from __future__ import annotations

import csv
import fnmatch
import io
import zipfile
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CHUNK_ROWS = 50_000


def _records(stream: io.TextIOBase, quote: str) -> Iterator[str]:
    """Lines of a delimited text; lines within quotes belong to one record."""
    held: list[str] = []
    quotes = 0
    for line in stream:
        held.append(line)
        quotes += line.count(quote)
        if quotes % 2 == 0:
            yield "".join(held).rstrip("\r\n")
            held, quotes = [], 0
    if held:
        yield "".join(held).rstrip("\r\n")


def unzip_records(archives: DataFrame, member: str, quote: str = '"', only_headers: bool = False) -> DataFrame:
    """(header, record) of the members matching ``member``, still as text: Python does nothing but decompress.

    Archives are spread over the tasks; within one, records leave in chunks, so no member is held whole.
    """

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for name in fnmatch.filter(archive.namelist(), member):
                        with archive.open(name) as stream:
                            records = _records(io.TextIOWrapper(stream, "utf-8-sig", newline=""), quote)
                            header, chunk = next(records, ""), []
                            if only_headers:
                                yield pd.DataFrame({"header": [header], "record": [""]})
                                continue
                            for record in filter(None, records):
                                chunk.append(record)
                                if len(chunk) == CHUNK_ROWS:
                                    yield pd.DataFrame({"header": header, "record": chunk})
                                    chunk = []
                            yield pd.DataFrame({"header": [header] * len(chunk), "record": chunk})

    return archives.select("content").mapInPandas(extract, "header string, record string")


def unzip_rows(
    archives: DataFrame, member: str, columns: Sequence[str], sep: str = ",", quote: str = '"'
) -> DataFrame:
    """Rows of the members matching ``member`` in every archive, as text columns; an empty field is null.

    ``archives`` has one archive per row in ``content``.  Members may order their columns as they like: each
    layout there is, told from the first lines alone, is parsed by Spark's own CSV parser.
    """
    wanted = [c.lower() for c in columns]
    layouts = [r.header for r in unzip_records(archives, member, quote, True).select("header").distinct().collect()]
    style = {"sep": sep, "quote": quote, "escape": quote}
    parsed = []
    for header in sorted(layouts):
        names = [c.lower() for c in next(csv.reader([header], delimiter=sep, quotechar=quote), [])]
        absent = [c for c in wanted if c not in names]
        if absent:
            raise ValueError(f"{member} lacks the columns {absent}")
        schema = ", ".join(f"`{i}` string" for i in range(len(names)))
        records = unzip_records(archives, member, quote).filter(F.col("header") == header)
        fields = records.select(F.from_csv("record", schema, style).alias("f"))
        parsed.append(fields.select(*[F.nullif(F.col(f"f.`{names.index(c)}`"), F.lit("")).alias(c) for c in wanted]))
    if not parsed:
        return archives.limit(0).select(*[F.lit(None).cast("string").alias(c) for c in wanted])
    return reduce(DataFrame.unionByName, parsed)


def read_zip_member(
    spark: SparkSession, path: str, member: str, columns: Sequence[str], sep: str = ",", quote: str = '"'
) -> DataFrame:
    """Rows of one member, or of all matching a pattern, in the archives under ``path``."""
    archives = spark.read.format("binaryFile").load(path).select("content")
    return unzip_rows(archives, member, columns, sep, quote)


def zip_partitions(rows: DataFrame, member: str, sep: str = ",", quote: str = '"') -> DataFrame:
    """Pack each partition of ``rows`` into archives holding one delimited member each."""
    names = list(rows.columns)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            buffer = io.BytesIO()
            with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as archive:
                archive.writestr(member, batch[names].to_csv(index=False, sep=sep, quotechar=quote))
            yield pd.DataFrame({"content": [buffer.getvalue()]})

    return rows.mapInPandas(pack, "content binary")
