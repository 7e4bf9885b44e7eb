"""Exact dedup by deterministic block naming.

A normalised text is cut into blocks of a fixed number of bytes.  All distinct blocks are sorted
and get an integer name; then adjacent names are paired and the distinct pairs named in the same
way, until one name is left of each document.  Equal names mean equal texts, never a hash that
happens to agree: a block's 64-bit key only finds its name, and keys that several distinct
blocks share are told apart by the blocks themselves.

Defined results: a null text counts as empty; empty texts are copies of each other; an empty table
gives an empty result; repeated rows are copies, of which one stays; a null id stays only where
no copy has an id.  Other columns are never read, so their names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.llm.common import BLANKS, columns, spare_name, text_or_empty
from regiopanel.session import passing, stored

BLOCK_BYTES = 8192
KEY_BITS = 64


def normalised(column: str) -> Column:
    return F.regexp_replace(text_or_empty(column), BLANKS, " ")


def _blocks(data: str, block_bytes: int) -> Column:
    """Array of the blocks of a binary column; one empty block if there is nothing."""
    last = F.greatest(F.ceil(F.length(data) / block_bytes).cast("int") - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.col(data).substr(i * block_bytes + 1, F.lit(block_bytes))
    )


def _key(block: Column, key_bits: int) -> Column:
    return F.shiftright(F.xxhash64(block), 64 - key_bits)


def _numbered(distinct: DataFrame, *keys: str) -> DataFrame:
    """Sorted rows with an integer name each, stored so that a name never changes."""
    return stored(distinct.orderBy(*keys).withColumn("name", F.monotonically_increasing_id()), "names")


def _named_blocks(data: DataFrame, entries: DataFrame, block_bytes: int, key_bits: int) -> DataFrame:
    """(row, place, name) of every block.

    Blocks travel once, deduplicated before they are shuffled; afterwards only keys do.
    """
    blocks = data.select(F.explode(_blocks("data", block_bytes)).alias("block"))
    blocks = blocks.select(_key(F.col("block"), key_bits).alias("key"), "block")
    keys = stored(blocks.distinct().groupBy("key").agg(F.count("*").alias("blocks")), "keys")
    places = entries.select("row", F.posexplode("keys").alias("place", "key"))
    shared = keys.filter("blocks > 1").select("key")
    if shared.isEmpty():
        names = _numbered(keys.select("key"), "key")
        return places.join(names, "key").select("row", "place", "name")
    ties = blocks.join(shared, "key", "left_semi").distinct()
    ties = ties.withColumn("tie", F.dense_rank().over(Window.partitionBy("key").orderBy("block")))
    ties = stored(ties, "ties")
    alone = keys.filter("blocks = 1").select("key", F.lit(0).alias("tie"))
    names = _numbered(alone.unionByName(ties.select("key", "tie")), "key", "tie")
    told = data.select("row", F.posexplode(_blocks("data", block_bytes)).alias("place", "block"))
    told = told.withColumn("key", _key(F.col("block"), key_bits)).join(ties, ["key", "block"])
    plain = places.join(shared, "key", "left_anti").withColumn("tie", F.lit(0))
    places = plain.unionByName(told.select("row", "place", "key", "tie"))
    return places.join(names, ["key", "tie"]).select("row", "place", "name")


def _sequences(named: DataFrame) -> DataFrame:
    """Names of each row in order; bounded by the length of one text."""
    listed = named.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("place", "name"))).alias("found"))
    return stored(listed.select("row", F.col("found.name").alias("names")), "sequences")


def identities(named: DataFrame) -> DataFrame:
    """(row, level, name): the one name that is left of each row after pairing names."""
    sequences, level, done = _sequences(named), 0, None
    while True:
        single = sequences.filter(F.size("names") == 1)
        single = single.select("row", F.lit(level).alias("level"), F.col("names")[0].alias("name"))
        done = single if done is None else done.unionByName(single)
        longer = sequences.filter(F.size("names") > 1)
        if longer.isEmpty():
            return done
        pairs = F.transform(
            F.sequence(F.lit(0), F.ceil(F.size("names") / 2).cast("int") - 1),
            lambda i: F.struct(
                F.get("names", i * 2).alias("left"), F.coalesce(F.get("names", i * 2 + 1), F.lit(-1)).alias("right")
            ),
        )
        pairs = longer.select("row", F.posexplode(pairs).alias("place", "pair")).select("row", "place", "pair.*")
        names = _numbered(pairs.select("left", "right").distinct(), "left", "right")
        sequences, level = _sequences(pairs.join(names, ["left", "right"]).select("row", "place", "name")), level + 1


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    key_bits: int = KEY_BITS,
) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    data = columns(docs, doc_id=id_col, text=text_col).select("doc_id", normalised("text").cast("binary").alias("data"))
    data = data.withColumn("row", F.monotonically_increasing_id())
    keys = F.transform(_blocks("data", block_bytes), lambda b: _key(b, key_bits))
    entries = data.select("row", "doc_id", F.sha2("data", 256).alias("text_sha256"), keys.alias("keys"))
    with passing(docs.sparkSession):
        entries = stored(entries, "entries")
        found = identities(_named_blocks(data, entries, block_bytes, key_bits))
        rows = stored(found.join(entries.drop("keys"), "row"), "identified", stays=True)
    rank = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    groups = rows.groupBy("level", "name").agg(F.min(rank).alias("first"), F.count("*").alias("group_size"))
    return rows.join(groups, ["level", "name"]).select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def keep_first_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with one of each group of equal texts, all columns kept."""
    with passing(docs.sparkSession):
        kept = exact_dedup(docs, id_col, text_col).filter("kept")
        kept = kept.select(F.col("doc_id").alias("_kept_id"), F.col("text_sha256").alias("_kept_text"))
        kept = stored(kept, "kept", stays=True)
    digest = F.sha2(normalised(text_col).cast("binary"), 256)
    same = docs[f"`{id_col}`"].eqNullSafe(kept["_kept_id"]) & (digest == kept["_kept_text"])
    rows = docs.join(kept, same, "left_semi")
    copies = docs.groupBy(F.col(f"`{id_col}`")).count().filter("count > 1")
    if copies.isEmpty():
        return rows
    # Rows that repeat both id and text: any one of them stays.
    name = spare_name(docs, "_text")
    return rows.withColumn(name, digest).dropDuplicates([id_col, name]).drop(name)
