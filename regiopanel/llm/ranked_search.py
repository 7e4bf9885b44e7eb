"""Ranked lexical search over a length-stratified index.

Documents of equal length normaliser form a stratum.  A stratum is stored as segments of a bounded size,
so that lengths which very many documents share spread over tasks; a segment holds its documents and, for
each term and term frequency, the list of documents that hold the term so often.  What a term adds to a
score depends on frequency and normaliser only, so it is computed once per frequency of a segment, not
per document.  The largest frequency of each term bounds what a stratum can score.

Search first visits, for each query, the strata of the highest bounds.  The score at the last rank found
there is a threshold: all other strata are visited whose bound reaches it, in the order of their
bounds within each task.  Each task keeps the best of each query only.  No bound leaves out a document that
could rank, also not one of an equal score.

The terms of the queries are the vocabulary of an index: postings of terms nobody asks for are not kept, while
counts of documents and terms are over all documents and all terms.  Queries are dealt into blocks of a
bounded number of terms; a block's terms are broadcast, and each block has an index of its own.

Defined results: a document that is null or holds no term ranks nowhere and isn't counted; a query without
terms has no rows; rows that repeat are documents and queries of their own; of equal scores the smaller id is
first, a null id last; an empty table of documents or queries gives an empty result.  Only ids and texts are
read, so other columns can't clash.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.session import fresh_path, stored

TOP = 50
# How a score is computed, in whole numbers.
WEIGHT, NORM, SLOPE, UNIT, PER_OCCURRENCE, PER_NORM = 1000, 100, 50, 1_000_000_000, 1000, 20
# Postings of a segment, beyond one document: 1 MB.
SEGMENT_POSTINGS = 1 << 18
# Strata that are visited before there is a threshold, per query.
FIRST_STRATA = 4
# Terms of a block of queries, beyond one query: some 20 MB to broadcast.
BLOCK_TERMS = 200_000
# Bytes of a row group of the index, which is read at once.
ROW_GROUP = 16 << 20

_BLANKED = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def terms_of(data: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, digits and everything beyond ASCII; only A-Z are lower-cased."""
    return (data or b"").translate(_BLANKED).split()


def impact(frequency, normaliser):
    return UNIT * frequency // (PER_OCCURRENCE * frequency + PER_NORM * normaliser)


def _numbered_texts(table: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return table.select(
        F.monotonically_increasing_id().alias("row"),
        table[f"`{id_col}`"].alias("id"),
        table[f"`{text_col}`"].cast("string").cast("binary").alias("data"),
    )


def _query_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, id, terms) of each query, its terms once each."""
    texts = _numbered_texts(items, id_col, text_col)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sorted(set(terms_of(x.as_py()))) for x in batch.column("data")]
            columns = [batch.column("row"), batch.column("id"), pa.array(found, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "terms"])

    kind = texts.schema["id"].dataType.simpleString()
    return stored(texts.mapInArrow(split, f"row long, id {kind}, terms array<binary>"), "queries")


@dataclass
class Block:
    """Queries that are answered together: term numbers by query, one after the other, and their weights."""

    rows: list[int]
    vocabulary: dict[bytes, int]
    terms: np.ndarray
    starts: np.ndarray
    weights: np.ndarray

    @classmethod
    def of(cls, queries: list) -> Block:
        queries = [q for q in queries if q.terms]
        vocabulary: dict[bytes, int] = {}
        terms = [vocabulary.setdefault(bytes(t), len(vocabulary)) for q in queries for t in q.terms]
        starts = np.cumsum([0, *(len(q.terms) for q in queries)])
        return cls([q.row for q in queries], vocabulary, np.array(terms, np.int64), starts, np.zeros(0, np.int64))

    def weigh(self, documents: int, holding: dict[int, int]) -> None:
        by_term = np.zeros(len(self.vocabulary), np.int64)
        for t, df in holding.items():
            by_term[t] = math.floor(WEIGHT * math.log((2 * documents + 2) / (2 * df + 1)))
        self.weights = by_term[self.terms]


def _frequencies(texts: DataFrame, vocabulary) -> DataFrame:
    """(row, id, n, terms, frequencies): number of terms, and the listed ones with how often they occur."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = vocabulary.value.get
        for batch in batches:
            lengths, ends, terms, frequencies = [], [0], [], []
            for x in batch.column("data"):
                words = terms_of(x.as_py())
                lengths.append(len(words))
                found = Counter(map(number, words))
                found.pop(None, None)
                terms.extend(found.keys())
                frequencies.extend(found.values())
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            columns = [
                batch.column("row"),
                batch.column("id"),
                pa.array(lengths, pa.int64()),
                pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array(frequencies, pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "n", "terms", "frequencies"])

    kind = texts.schema["id"].dataType.simpleString()
    return texts.mapInArrow(count, f"row long, id {kind}, n long, terms array<int>, frequencies array<int>")


def _flat(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and their number in each row."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat, column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _cuts(normalisers: np.ndarray, sizes: np.ndarray, bound: int) -> Iterator[tuple[int, int]]:
    """Rows of each segment: neighbours of one normaliser with ``bound`` postings at most, or one row."""
    start, held = 0, 0
    for i in range(len(sizes)):
        if i > start and (normalisers[i] != normalisers[start] or held + sizes[i] > bound):
            yield start, i
            start, held = i, 0
        held += sizes[i]
    if len(sizes):
        yield start, len(sizes)


def build_index(counted: DataFrame, documents: int, all_terms: int, bound: int = SEGMENT_POSTINGS) -> DataFrame:
    """Segments: m, rows and ids of the documents, then (terms, frequencies) in order, each with the end of its postings."""
    listed = counted.filter(F.size("terms") > 0)
    m = F.expr(f"({NORM - SLOPE} + ({SLOPE} * n * {documents}L) div {all_terms}L)").cast("long")
    # A number that differs by row splits a stratum that most documents are in.
    dealt = listed.select(m.alias("m"), F.xxhash64("row").alias("deal"), "row", "id", "terms", "frequencies")
    dealt = dealt.repartitionByRange("m", "deal").sortWithinPartitions("m", "deal").drop("deal")
    kind = dealt.schema["id"].dataType.simpleString()

    def invert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            normalisers = batch.column("m").to_numpy()
            terms, sizes = _flat(batch.column("terms"))
            frequencies, _ = _flat(batch.column("frequencies"))
            firsts = np.concatenate([[0], np.cumsum(sizes)])
            for a, b in _cuts(normalisers, sizes, bound):
                inside = slice(firsts[a], firsts[b])
                place = np.repeat(np.arange(b - a), sizes[a:b])
                t, f = terms[inside], frequencies[inside]
                order = np.lexsort((place, f, t))
                t, f, place = t[order], f[order], place[order]
                last = np.flatnonzero(np.append((t[1:] != t[:-1]) | (f[1:] != f[:-1]), True))
                lists = (t[last], f[last], last + 1, place)
                columns = [pa.array(normalisers[a : a + 1])]
                columns += [_one(batch.column(c).slice(a, b - a)) for c in ("row", "id")]
                columns += [_one(pa.array(x.astype(np.int32))) for x in lists]
                yield pa.RecordBatch.from_arrays(columns, SEGMENT)

    return dealt.mapInArrow(
        invert,
        f"m long, rows array<long>, ids array<{kind}>, terms array<int>, frequencies array<int>, ends array<int>, "
        "postings array<int>",
    )


SEGMENT = ["m", "rows", "ids", "terms", "frequencies", "ends", "postings"]


def _kept(index: DataFrame) -> DataFrame:
    path = fresh_path(index.sparkSession, "index")
    index.write.option("parquet.block.size", ROW_GROUP).parquet(path)
    return index.sparkSession.read.schema(index.schema).parquet(path)


def _one(values: pa.Array) -> pa.Array:
    """A list column of one row."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def segment_bounds(block: Block, m: int, terms: np.ndarray, frequencies: np.ndarray) -> np.ndarray:
    """What no document of a segment can exceed, for each query of the block."""
    most = np.zeros(len(block.vocabulary), np.int64)
    # In the order of terms and frequencies, so the last one of a term is its largest.
    most[terms] = impact(frequencies.astype(np.int64), m)
    return np.add.reduceat(block.weights * most[block.terms], block.starts[:-1])


def _first_strata(index: DataFrame, block, strata: int) -> dict[int, set[int]]:
    """Normalisers of the highest bounds for each query; at most ``strata`` a query, which the driver holds."""

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries = block.value
        best: list[dict[int, int]] = [{} for _ in queries.rows]
        for batch in batches:
            for m, terms, frequencies in zip(*(batch.column(c) for c in ("m", "terms", "frequencies"))):
                m = m.as_py()
                found = segment_bounds(queries, m, terms.values.to_numpy(), frequencies.values.to_numpy())
                for q in np.flatnonzero(found):
                    mine, value = best[q], int(found[q])
                    if mine.get(m, 0) < value:
                        mine[m] = value
                        if len(mine) > strata:
                            del mine[min(mine, key=lambda x: (mine[x], -x))]
        rows = [(q, m, v) for q, mine in enumerate(best) for m, v in mine.items()]
        columns = [pa.array(x, pa.int64()) for x in (zip(*rows) if rows else ([], [], []))]
        yield pa.RecordBatch.from_arrays(columns, ["query", "m", "bound"])

    found = index.select("m", "terms", "frequencies").mapInArrow(bounds, "query long, m long, bound long")
    found = found.groupBy("query", "m").agg(F.max("bound").alias("bound"))
    order = Window.partitionBy("query").orderBy(F.desc("bound"), "m")
    chosen: dict[int, set[int]] = {}
    for r in found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= strata).collect():
        chosen.setdefault(r.query, set()).add(r.m)
    return chosen


class Best:
    """The best documents of one query, in their final order."""

    def __init__(self, top: int, threshold: int):
        self.top, self.threshold, self.held = top, max(1, threshold), []

    def offer(self, scores: np.ndarray, ids: list, rows: np.ndarray) -> None:
        able = np.flatnonzero(scores >= self.threshold)
        if len(able):
            new = [(-int(scores[i]), ids[i] is None, 0 if ids[i] is None else ids[i], int(rows[i])) for i in able]
            self.held = sorted(self.held + new)[: self.top]
            if len(self.held) == self.top:
                self.threshold = max(self.threshold, -self.held[-1][0])


def _score(block: Block, q: int, segment: dict, scores: np.ndarray) -> None:
    terms, ends, postings, gains = (segment[c] for c in ("terms", "ends", "postings", "gains"))
    mine = slice(block.starts[q], block.starts[q + 1])
    low = np.searchsorted(terms, block.terms[mine])
    high = np.searchsorted(terms, block.terms[mine], "right")
    here = np.flatnonzero((high > low) & (block.weights[mine] > 0))
    first = np.where(low > 0, ends[low - 1], 0)
    for i in here:
        # A document is in one list of a term only, so none is added to twice at once.
        part = slice(first[i], ends[high[i] - 1])
        scores[postings[part]] += block.weights[block.starts[q] + i] * gains[part]


def _visit(
    index: DataFrame, block, thresholds: list[int], only: dict | None, without: dict, top: int, kind: str
) -> DataFrame:
    """The best of each query and task, of the strata ``only``, or of all but ``without``."""

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: Block = block.value
        best = [Best(top, t) for t in thresholds]
        id_type = None
        for batch in batches:
            id_type = batch.schema.field("ids").type.value_type
            segments = []
            for k in range(batch.num_rows):
                m = batch.column("m")[k].as_py()
                terms, frequencies = (batch.column(c)[k].values.to_numpy() for c in ("terms", "frequencies"))
                segments.append((m, k, segment_bounds(queries, m, terms, frequencies)))
            segments.sort(key=lambda s: -int(s[2].max()))
            for m, k, bounds in segments:
                wanted = [
                    q
                    for q in np.flatnonzero(bounds)
                    if bounds[q] >= best[q].threshold
                    and (m in only.get(q, ()) if only is not None else m not in without.get(q, ()))
                ]
                if wanted:
                    _visit_segment(queries, batch, k, m, wanted, best)
        rows = [(q, *entry) for q, b in enumerate(best) for entry in b.held]
        if rows:
            query, score, nameless, ids, numbers = zip(*rows)
            columns = [
                pa.array(query, pa.int64()),
                pa.array([-s for s in score], pa.int64()),
                pa.array([None if none else i for none, i in zip(nameless, ids)], id_type),
                pa.array(numbers, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["query", "score", "doc_id", "row"])

    return index.mapInArrow(visit, f"query long, score long, doc_id {kind}, row long")


def _visit_segment(queries: Block, batch: pa.RecordBatch, k: int, m: int, wanted: list[int], best: list[Best]) -> None:
    names = ("rows", "terms", "frequencies", "ends", "postings")
    segment = {c: batch.column(c)[k].values.to_numpy() for c in names}
    ids = batch.column("ids")[k].values.to_pylist()
    # Once for each frequency, then handed to the postings of all terms that occur so often.
    frequencies, which = np.unique(segment["frequencies"], return_inverse=True)
    by_list = impact(frequencies.astype(np.int64), m)[which]
    segment["gains"] = np.repeat(by_list, np.diff(segment["ends"], prepend=0))
    for q in wanted:
        scores = np.zeros(len(ids), np.int64)
        _score(queries, q, segment, scores)
        best[q].offer(scores, ids, segment["rows"])


def _ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _search_block(texts: DataFrame, queries: list, top: int, strata: int, bound: int) -> DataFrame | None:
    spark = texts.sparkSession
    block = Block.of(queries)
    if not block.rows:
        return None
    vocabulary = spark.sparkContext.broadcast(block.vocabulary)
    counted = stored(_frequencies(texts, vocabulary), "frequencies")
    sums = counted.filter("n > 0").agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    if not sums.documents:
        return None
    holding = counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect()  # one row a term
    block.weigh(sums.documents, {r["term"]: r["count"] for r in holding})
    index = _kept(build_index(counted, sums.documents, sums.terms, bound))
    shared = spark.sparkContext.broadcast(block)
    kind = texts.schema["id"].dataType.simpleString()
    first = _first_strata(index, shared, strata)
    nearest = index.filter(F.col("m").isin(sorted(set().union(*first.values()))))
    early = stored(_visit(nearest, shared, [0] * len(block.rows), first, {}, top, kind), "early")
    thresholds = [0] * len(block.rows)
    for r in _ranked(early, top).filter(F.col("rank") == top).collect():
        thresholds[r.query] = r.score
    late = _visit(index, shared, thresholds, None, first, top, kind)
    ranked = _ranked(early.unionByName(late), top)
    numbers = spark.createDataFrame(list(enumerate(block.rows)), "query long, item_row long")
    return ranked.join(F.broadcast(numbers), "query").select("item_row", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    top: int = TOP,
    strata: int = FIRST_STRATA,
    block_terms: int = BLOCK_TERMS,
    segment_postings: int = SEGMENT_POSTINGS,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of the ``top`` documents of each query."""
    queries = _query_terms(items, item_id, item_text)
    texts = _numbered_texts(docs, doc_id, doc_text)
    total = queries.agg(F.sum(F.size("terms"))).first()[0] or 0
    blocks = -(-total // block_terms)
    results = []
    for k in range(blocks):
        mine = queries.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == k).select("row", "terms").collect()
        results.append(_search_block(texts, mine, top, strata, segment_postings))
    results = [stored(r, "ranked") for r in results if r is not None]
    if not results:
        nothing = queries.select(F.col("id").alias("item_id")).limit(0)
        kind = texts.schema["id"].dataType
        return nothing.select(
            "item_id", F.lit(0).alias("rank"), F.lit(None).cast(kind).alias("doc_id"), F.lit(0).cast("long").alias("score")
        )
    found = results[0]
    for more in results[1:]:
        found = found.unionByName(more)
    names = queries.select(F.col("row").alias("item_row"), F.col("id").alias("item_id"))
    return found.join(names, "item_row").select("item_id", "rank", "doc_id", "score")
