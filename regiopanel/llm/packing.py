"""Packing of documents into sequences, shortest pack first over the histogram of lengths.

Each document's ids, with the end id, are cut into pieces of the sequence length and one rest.
The pieces' lengths are placed longest first, each into the pack that is least full and has room,
many equal packs at a time; what this keeps is a count for each pattern of lengths.  Pieces
then find their place by length and rank among the pieces of that length.

Defined results: a null or empty text is a document of the end id alone; an empty table gives an
empty result; repeated rows are packed once each; rows with a null id keep it.  Only the id and the
text are read, so other columns can't clash.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.llm.common import columns, text_or_empty
from regiopanel.llm.memo import CHUNK, Memo, in_chunks
from regiopanel.session import stored

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
PLACED = PIECES + ", sequence_id long, offset long"
BLANK = str.maketrans("\t\n\x0b\x0c\r", "     ")


# How the tokenizer splits lower-cased text of the first 256 code points (fixed values).
LATIN = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa00-9²³¹¼½¾a-zªµºß-öø-ÿ]+"
)
PROBES = ["", "A b\tc's", "THE: 'tis 2²½ ÀÉß×÷ªµº, don't\x85we'LL\xa0go...'s", "x\x1cy_z  \n12"]
UNITS_AT_ONCE = 20_000


class WordIds:
    """Ids as packed unsigned 32-bit integers, put together from those of words met before.

    The tokenizer lower-cases, drops white space and encodes each run of letters, each digit and
    each run of other characters on its own.  Text beyond the first 256 code points is looked
    up by what lies between blanks, text with a special token's string goes to the library as it is.
    """

    def __init__(self, tokenizer_file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.units, self.words = Memo(self._many), Memo(self._each)
        for probe in PROBES:
            if self.whole(probe) != self.latin(probe) or self.whole(probe) != self.between_blanks(probe):
                raise ValueError(f"{tokenizer_file} splits text in another way; its ids can't be had word by word")

    def _each(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _many(self, units: list[str]) -> list[bytes]:
        """All units as one text; each ends with the one token that ends a word."""
        done = []
        for at in range(0, len(units), UNITS_AT_ONCE):
            part = units[at : at + UNITS_AT_ONCE]
            ids = np.array(self.tokenizer.encode(" ".join(part), add_special_tokens=False).ids, "<u4")
            cuts = np.flatnonzero(self.ends[ids]) + 1
            if len(cuts) != len(part):
                done += self._each(part)
                continue
            data, cuts = ids.tobytes(), [0, *(4 * cuts).tolist()]
            done += [data[a:b] for a, b in zip(cuts, cuts[1:])]
        return done

    def whole(self, text: str) -> bytes:
        return self._each([text])[0]

    def latin(self, text: str) -> bytes:
        return b"".join(self.units(LATIN.findall(text.lower())))

    def between_blanks(self, text: str) -> bytes:
        return b"".join(self.words(text.translate(BLANK).split(" ")))

    def __call__(self, text: str) -> bytes:
        if any(x in text for x in self.special):
            return self.whole(text)
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            one = self.between_blanks
        else:
            one = self.latin
        if len(text) <= CHUNK:
            return one(text)
        return b"".join(one(part) for part in in_chunks(text.translate(BLANK), " "))


@cache
def _ids(tokenizer_file: str) -> WordIds:
    return WordIds(tokenizer_file)


def _cut(tokenizer_file: str, end_id: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = _ids(tokenizer_file), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = encode(text.as_py()) + end
                total = len(ids) // 4
                for start in range(0, total, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    rows.append((doc_id, start, len(part) // 4, zlib.crc32(part), total))
            fields = zip(*rows, strict=True) if rows else [[]] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int64()) for f in fields], names)

    return run


def shortest_pack_first(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Packing patterns as (number of packs, lengths in the pack).

    ``open_packs`` holds, by the room that is left, packs as (count, pattern); a pattern is a linked
    list of lengths, shared by the packs that go on from it.
    """
    open_packs: dict[int, list[tuple[int, tuple]]] = {}
    rooms: list[int] = []  # a heap of the rooms that are left, largest first

    def put(room: int, count: int, pattern: tuple) -> None:
        if room not in open_packs:
            open_packs[room] = []
            heapq.heappush(rooms, -room)
        open_packs[room].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            while rooms and -rooms[0] not in open_packs:
                heapq.heappop(rooms)
            room = -rooms[0] if rooms else 0
            if room < length:
                put(capacity - length, left, (length, None))
                break
            count, pattern = open_packs[room].pop()
            used = min(count, left)
            if used < count:
                open_packs[room].append((count - used, pattern))
            if not open_packs[room]:
                del open_packs[room]
                heapq.heappop(rooms)
            put(room - length, used, (length, pattern))
            left -= used
    done = []
    for room in sorted(open_packs):
        for count, pattern in open_packs[room]:
            lengths = []
            while pattern:
                lengths.append(pattern[0])
                pattern = pattern[1]
            done.append((count, lengths[::-1]))
    return done


def slots(patterns: list[tuple[int, list[int]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset): which ranks of a length go where."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            rows.append((length, rank, sequence, offset))
            ranks[length], offset = rank + count, offset + length
        sequence += count
    table = np.array(rows, np.int64).reshape(-1, 4)
    return table[np.lexsort((table[:, 1], table[:, 0]))]


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        length, rank, sequence, offset = table.value.T
        first = np.searchsorted(length, np.arange(length.max(initial=0) + 2))
        for batch in batches:
            lengths, ranks = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(lengths), np.int64)
            for one in np.unique(lengths):
                rows, (a, b) = lengths == one, first[one : one + 2]
                at[rows] = a + np.searchsorted(rank[a:b], ranks[rows], "right") - 1
            placed = [pa.array(sequence[at] + ranks - rank[at]), pa.array(offset[at])]
            kept = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([*kept, *placed], names)

    return run


def pack(
    docs: DataFrame,
    tokenizer_file: str,
    end_id: int,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    texts = columns(docs, doc_id=id_col, text=text_col).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text")
    )
    pieces = texts.mapInArrow(_cut(tokenizer_file, end_id, capacity), PIECES)
    pieces = stored(pieces.withColumn("part", F.spark_partition_id()), "pieces")
    counts = stored(pieces.groupBy("length", "part").agg(F.count("*").alias("n")), "lengths")
    # At most ``capacity`` rows, whatever the input.
    histogram = {r.length: r.n for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    table = docs.sparkSession.sparkContext.broadcast(slots(shortest_pack_first(histogram, capacity)))
    # Rank among the pieces of a length: of parts before, then within the part. No group exceeds one part.
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")) - 1
    ranked = pieces.withColumn("within", within).join(counts, ["length", "part"])
    ranked = ranked.withColumn("rank", F.col("before") + F.col("within")).drop("before", "within", "part")
    return ranked.mapInArrow(_place(table), PLACED)
