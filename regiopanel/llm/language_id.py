"""Language identification by cross-parsing entropy.

For each language a suffix automaton of labelled text is built.  A text is parsed greedily into the
longest phrases that occur in that labelled text; the language that needs the fewest phrases, times the
logarithm of its labelled text's length and per character, wins.

The automaton is laid out as a table of states by symbols in which a missing transition leads to
where the next phrase starts, so many texts advance by a symbol at a time.  Parsing starts anew every
``SEGMENT`` symbols, which bounds the steps whatever a text's length.

Defined results: a null text, or one without a letter, is ``und`` with score 0, as is every text where
nothing is labelled; of languages that need equally much, the first by name wins; repeated rows
get a row each; an empty table gives an empty result.  Labels, sources and ids are never inputs of
a prediction.  Only the named columns are read, so others can't clash.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from regiopanel.llm.common import columns

UNKNOWN = "und"
# Bounds of the labelled sample: texts of a language, characters of a text, characters of a language,
# and characters of all languages together.
SAMPLE_TEXTS, SAMPLE_OF_TEXT, SAMPLE_CHARS, SAMPLE_ALL = 64, 2_000, 24_000, 400_000
LANGUAGES = 1_000
# Entries of a table that is laid out in full; a larger one, of many letters, holds only the moves there are.
DENSE = 1 << 23
SEGMENT = 1_024
# Symbols that are parsed together.
LANES = 1 << 21


@cache
def _letters() -> np.ndarray:
    """Code point to its lower-case letter, or to a blank if it is none."""
    table = np.full(0x110000, 0x20, np.uint32)
    for i in range(0x110000):
        if unicodedata.category(chr(i))[0] == "L":
            low = chr(i).lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def _codes(text: str) -> np.ndarray:
    return _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]


def suffix_automaton(symbols: list[int]) -> list[dict[int, int]]:
    """Transitions of the states of the automaton of all substrings; state 0 is the start."""
    moves, link, longest, last = [{}], [-1], [0], 0
    for s in symbols:
        new = len(moves)
        moves.append({})
        link.append(0)
        longest.append(longest[last] + 1)
        p = last
        while p >= 0 and s not in moves[p]:
            moves[p][s] = new
            p = link[p]
        if p >= 0:
            q = moves[p][s]
            if longest[q] == longest[p] + 1:
                link[new] = q
            else:
                clone = len(moves)
                moves.append(dict(moves[q]))
                link.append(link[q])
                longest.append(longest[p] + 1)
                while p >= 0 and moves[p].get(s) == q:
                    moves[p][s] = clone
                    p = link[p]
                link[q] = link[new] = clone
        last = new
    return moves


class _Table:
    """A language's automaton over the letters of its own sample; all others are its symbol 0, on which no
    state has a move. A move is the next state times twice the width, plus 1 where a phrase ended before the symbol."""

    def __init__(self, sample: np.ndarray, symbols: int):
        own = np.unique(sample[sample > 0])
        self.width = len(own) + 1
        self.local = np.zeros(symbols, np.int32)
        self.local[own] = np.arange(1, self.width)
        moves = suffix_automaton(self.local[sample].tolist())
        # A symbol that occurs nowhere is a phrase of its own: a state that every symbol leaves.
        alone = len(moves)
        start = np.array([moves[0].get(s, alone) for s in range(self.width)], np.int64) * (2 * self.width)
        at = np.array([k * self.width + s for k, out in enumerate(moves) for s in out], np.int64)
        to = np.array([x for out in moves for x in out.values()], np.int64) * (2 * self.width)
        first = np.arange(self.width)  # nothing ends before the first symbol
        self.dense = self.keys = None
        if (alone + 1) * self.width <= DENSE:
            self.dense = np.tile((start + 1).astype(np.int32), alone + 1)
            self.dense[first] = start
            self.dense[at] = to
        else:
            rest = at >= self.width
            order = np.argsort(at[rest])
            self.keys = np.concatenate([first, at[rest][order]])
            self.targets, self.missing = np.concatenate([start, to[rest][order]]), start + 1

    def moved(self, states: np.ndarray, symbols: np.ndarray) -> np.ndarray:
        at = (states >> 1) + symbols
        if self.dense is not None:
            return self.dense[at]
        place = np.minimum(np.searchsorted(self.keys, at), len(self.keys) - 1)
        return np.where(self.keys[place] == at, self.targets[place], self.missing[symbols])


class CrossParser:
    """Phrase counts of texts against each language's labelled text."""

    def __init__(self, samples: dict[str, str]):
        codes = {lang: _codes(text) for lang, text in samples.items()}
        known = np.unique(np.concatenate([*codes.values(), np.zeros(0, np.uint32)]))
        # 0: a letter that no sample holds
        self.symbol = np.zeros(0x110000, np.min_scalar_type(len(known)))
        self.symbol[known] = np.arange(1, len(known) + 1)
        self.symbol = self.symbol[_letters()]
        self.languages = sorted(samples)
        self.tables = [_Table(self.symbol[codes[x]], len(known) + 1) for x in self.languages]
        self.weights = np.array([np.log2(len(samples[x]) + 2) for x in self.languages])

    def symbols(self, text: str) -> np.ndarray:
        return self.symbol[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]

    def phrases(self, texts: list[np.ndarray]) -> np.ndarray:
        """Phrases that each text needs, by language."""
        lengths = np.array([len(x) for x in texts], np.int64)
        parts = -(-lengths // SEGMENT)
        owner = np.repeat(np.arange(len(texts)), parts)
        first = np.arange(len(owner)) - np.repeat(np.cumsum(parts) - parts, parts)
        size = np.minimum(SEGMENT, lengths[owner] - first * SEGMENT)
        order = np.argsort(-size, kind="stable")
        lanes = np.zeros((len(owner), SEGMENT), self.symbol.dtype)
        row = 0
        for x, n in zip(texts, parts, strict=True):
            lanes[row : row + n].reshape(-1)[: len(x)] = x
            row += n
        steps = np.ascontiguousarray(lanes[order].T)
        active = np.searchsorted(-size[order], -np.arange(SEGMENT), "left")
        counts = np.empty((len(texts), len(self.languages)), np.int64)
        for k, table in enumerate(self.tables):
            own = table.local[steps]
            wide = np.int32 if table.dense is not None else np.int64
            state, ended = np.zeros(len(owner), wide), np.zeros(len(owner), np.int32)
            for i in range(int(size.max(initial=0))):
                n = active[i]
                moved = table.moved(state[:n], own[i, :n])
                ended[:n] += moved & 1
                state[:n] = moved & -2
            ended[size[order] > 0] += 1
            counts[:, k] = np.bincount(owner[order], ended, len(texts))
        return counts

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and, as score, by how much the next best needs more."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        coded = [self.symbols(x) for x in texts]
        at, todo = 0, []
        size = 0
        for i, x in enumerate(coded):
            todo.append(i)
            size += len(x)
            if size >= LANES or i == len(coded) - 1:
                cost = self.phrases([coded[j] for j in todo]) * self.weights
                best = cost.argmin(axis=1)
                for j, row, k in zip(todo, cost, best, strict=True):
                    if not any(c.isalpha() for c in texts[j]):
                        continue
                    rest = np.delete(row, k).min(initial=np.inf)
                    names[j], scores[j] = self.languages[k], float(1 - row[k] / rest)
                todo, size = [], 0
        return names, scores


@cache
def _parser(samples: tuple[tuple[str, str], ...]) -> CrossParser:
    return CrossParser(dict(samples))


def labelled_sample(labelled: DataFrame, lang_col: str = "lang", text_col: str = "text") -> dict[str, str]:
    """Bounded text of each language, equally much of each, of distinct texts chosen by their hash."""
    rows = columns(labelled, lang=lang_col, text=text_col).filter("lang is not null and text is not null")
    rows = rows.select("lang", F.substring("text", 1, SAMPLE_OF_TEXT).alias("text"))
    rows = rows.withColumn("at", F.xxhash64("text"))
    # Copies count once. Texts are read again by the few hashes that are chosen, so only hashes are exchanged.
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("at"))
    least = rows.select("lang", "at").distinct().withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_TEXTS)
    least = least.orderBy("lang", "rank").limit(LANGUAGES * SAMPLE_TEXTS).select("lang", "at")
    chosen = rows.join(F.broadcast(least), ["lang", "at"]).groupBy("lang", "at").agg(F.min("text").alias("text"))
    texts: dict[str, list[str]] = {}
    for row in chosen.orderBy("lang", "at").toLocalIterator():
        found = texts.setdefault(row.lang, [])
        if sum(map(len, found)) < SAMPLE_CHARS:
            found.append(row.text)
    joined = {lang: "\n".join(x) for lang, x in texts.items()}
    each = min(SAMPLE_CHARS, SAMPLE_ALL // max(1, len(joined)))
    return {lang: text[:each] for lang, text in joined.items() if any(c.isalpha() for c in text)}


def identify(docs: DataFrame, samples: dict[str, str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, lang_pred, score."""
    texts = columns(docs, doc_id=id_col, text=text_col)
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = docs.sparkSession.sparkContext.broadcast(tuple(sorted(samples.items())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(model.value)
        for batch in batches:
            names, scores = parser.predict([x.as_py() or "" for x in batch.column("text")])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")
