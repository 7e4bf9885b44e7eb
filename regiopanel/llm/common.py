"""Helpers that several of these operators share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiopanel.session import stored

# Space, tab, newline, vertical tab, form feed, carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
# Size of what ``sifted`` broadcasts: 8 MB in all, 4 KB a row.
SIEVE_BITS = 1 << 26
BITMAP_BITS = 1 << 15


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, also where a lambda reads it many times."""
    return F.transform(F.array(value), body)[0]


def spare_name(docs: DataFrame, stem: str) -> str:
    """A column name that ``docs`` doesn't use, in any case of letters."""
    used = {c.lower() for c in docs.columns}
    while stem in used:
        stem += "_"
    return stem


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def columns(docs: DataFrame, **named: str) -> DataFrame:
    """Only the named columns, under fixed names, so that no other column can clash."""
    return docs.select(*[docs[f"`{source}`"].alias(name) for name, source in named.items()])


def sifted(rows: DataFrame, key: Column, wanted: DataFrame, wanted_key: Column) -> DataFrame:
    """Rows whose 64-bit key may be among the wanted ones: a bitmap of bounded size, broadcast, lets all of those pass.

    It comes before a shuffle of wide rows; a full bitmap lets all rows pass.  A null key is never wanted.
    """
    bits = wanted.select(F.pmod(wanted_key, F.lit(SIEVE_BITS)).alias("bit")).filter("bit is not null").distinct()
    bucket, position = F.floor(F.col("bit") / BITMAP_BITS), F.col("bit") % BITMAP_BITS
    maps = bits.groupBy(bucket.alias("bucket")).agg(F.bitmap_construct_agg(position).alias("bitmap"))
    found = rows.withColumn("bit", F.pmod(key, F.lit(SIEVE_BITS)))
    found = found.join(F.broadcast(stored(maps, "sieve")), bucket == F.col("bucket"))
    byte = F.conv(F.hex(F.substring(F.col("bitmap"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    mask = F.element_at(F.array(*[F.lit(1 << k) for k in range(8)]), (position % 8).cast("int") + 1)
    return found.filter(byte.bitwiseAND(mask) != 0).select(*rows.columns)
