"""Token counts from a digest cache.

A text's digest and the tokenizer's digest are joined to a table of stored counts; only distinct
texts without a stored count are encoded, and their counts are appended to the table.

Defined results: a null text counts as empty and has no tokens; repeated rows each get a row; an
empty table gives an empty result; rows with a null id keep it.  Only the id and the text are
read, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiopanel.llm.common import columns, text_or_empty
from regiopanel.llm.memo import Memo, in_chunks
from regiopanel.session import stored

CACHE_SCHEMA = "version string, digest binary, n_tokens long"


def tokenizer_version(model_file: str) -> str:
    return hashlib.sha256(Path(model_file).read_bytes()).hexdigest()


class PieceCounter:
    """Token counts of a sentencepiece model that are the library's own for any text.

    Where no piece of the model holds a word marker after another character, nothing is merged
    across a blank, nor across a newline that no piece holds; then a text's tokens are those of its
    words.  Texts with runs of blanks, or of models unlike that, go to the library as they are.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        probe = [len(x) for x in self.model.encode(["a", "\na", "a a", "a\na"], num_threads=1)]
        self.by_word = (
            not any("▁" in p.lstrip("▁") or "\n" in p for p in pieces)
            and self.model.encode("a  a ", out_type=str)[-1] in ("▁", "▁a▁")
            and probe[2] == 2 * probe[0]
            and probe[3] == probe[0] + probe[1] - 1
        )
        self.memo = Memo(lambda words: [len(x) for x in self.model.encode(words, num_threads=1)])

    def __call__(self, text: str) -> int:
        if not text:
            return 0
        if not self.by_word or "▁" in text or "  " in text or text[0] in " \n" or text[-1] == " " or " \n" in text:
            return len(self.model.encode(text, num_threads=1))
        total = 0
        for part in in_chunks(text, " "):
            words = part.replace("\n", " \n").split(" ")
            # The library puts a word marker before each word that it gets; a newline has none.
            total += sum(self.memo(words if total == 0 else words[1:])) - part.count("\n")
        return total


@cache
def _counter(model_file: str) -> PieceCounter:
    return PieceCounter(model_file)


def _encode(model_file: str, version: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = _counter(model_file)
        for batch in batches:
            counts = [count(x.as_py()) for x in batch.column("text")]
            names = pa.array([version] * len(counts), pa.string())
            yield pa.RecordBatch.from_arrays(
                [names, batch.column("digest"), pa.array(counts, pa.int64())], ["version", "digest", "n_tokens"]
            )

    return run


def read_cache(spark: SparkSession, path: str) -> DataFrame:
    spark.createDataFrame([], CACHE_SCHEMA).write.mode("append").parquet(path)
    return spark.read.schema(CACHE_SCHEMA).parquet(path)


def count_tokens(
    docs: DataFrame, model_file: str, cache_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, digest. Counts that were missing are in the cache afterwards."""
    spark, version = docs.sparkSession, tokenizer_version(model_file)
    texts = columns(docs, doc_id=id_col, text=text_col).select("doc_id", text_or_empty("text").alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    entries = stored(texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "digests")
    known = read_cache(spark, cache_path).filter(F.col("version") == version).select("digest")
    # One text of each digest: copies are dropped before and after the shuffle.
    distinct = texts.groupBy("digest").agg(F.first("text").alias("text"))
    missing = distinct.join(known, "digest", "left_anti")
    missing.mapInArrow(_encode(model_file, version), CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    counts = spark.read.schema(CACHE_SCHEMA).parquet(cache_path).filter(F.col("version") == version)
    counts = counts.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))
    return entries.join(counts, "digest").select("doc_id", "n_bytes", "n_tokens", F.hex("digest").alias("digest"))
