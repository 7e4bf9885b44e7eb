"""SentencePiece encoding and decoding with the tokenizers library.

The model's protobuf is read and its normaliser, word marker, scores and byte fallback are rebuilt
as a pipeline of the tokenizers library, for unigram and for BPE models.  Every unit that is encoded is
also given to the sentencepiece library, and a document says whether both agree.

Defined results: a null or empty text has no ids and decodes to an empty text; repeated rows get a row
each; an empty table gives an empty result.  Only the id and the text are read, so other columns
can't clash.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiopanel.llm.common import columns, text_or_empty
from regiopanel.llm.memo import Memo, in_chunks

MARK = "▁"
UNITS_AT_ONCE = 20_000
ENCODED = "doc_id long, ids array<int>, n_ids long, decoded_sha256 string, round_trip boolean, parity boolean"
# Kinds of pieces in the protobuf (fixed values).
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, BYTE = 1, 2, 3, 4, 6
UNIGRAM, BPE = 1, 2


def parse(model_file: str):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    model.ParseFromString(Path(model_file).read_bytes())
    return model


def merges(pieces: list[tuple[str, float, int]]) -> list[tuple[str, str]]:
    """Pairs that may be merged, best score first: all ways to cut a piece into two others."""
    order = {p: (-score, i) for i, (p, score, kind) in enumerate(pieces) if kind in (NORMAL, USER_DEFINED)}
    found = []
    for piece, rank in order.items():
        cuts = [(piece[:k], piece[k:]) for k in range(1, len(piece))]
        found += [(rank, order[a], order[b], (a, b)) for a, b in cuts if a in order and b in order]
    return [pair for *_, pair in sorted(found)]


def _never_across(pieces: list[str]) -> tuple[bool, bool]:
    """Whether no piece holds a marker after another character, and whether none holds a newline."""
    return not any(MARK in p.lstrip(MARK) for p in pieces), not any("\n" in p for p in pieces)


class Codec:
    def __init__(self, model_file: str, threads: int = 1):
        import sentencepiece
        from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        os.environ.setdefault("RAYON_NUM_THREADS", str(threads))
        model, self.threads = parse(model_file), threads
        pieces = [(p.piece, p.score, p.type) for p in model.pieces]
        spec, trained = model.normalizer_spec, model.trainer_spec
        vocab = {p: i for i, (p, _, _) in enumerate(pieces)}
        unknown = next((i for i, p in enumerate(pieces) if p[2] == UNKNOWN), 0)
        if trained.model_type == UNIGRAM:
            inner = models.Unigram([(p, s) for p, s, _ in pieces], unknown, trained.byte_fallback)
        elif trained.model_type == BPE:
            inner = models.BPE(
                vocab, merges(pieces), unk_token=pieces[unknown][0], fuse_unk=True, byte_fallback=trained.byte_fallback
            )
        else:
            raise ValueError(f"{model_file}: model type {trained.model_type}")
        self.tokenizer = Tokenizer(inner)
        steps = [normalizers.Precompiled(spec.precompiled_charsmap)] if spec.precompiled_charsmap else []
        if spec.remove_extra_whitespaces:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if spec.add_dummy_prefix:
            steps.append(normalizers.Prepend(" "))
        if spec.escape_whitespaces:
            steps.append(normalizers.Replace(" ", MARK))
        self.tokenizer.normalizer = normalizers.Sequence(steps)
        words, lines = _never_across([p for p, _, kind in pieces if kind in (NORMAL, USER_DEFINED)])
        if words and trained.model_type == BPE:
            # Nothing merges across these cuts, and short parts are cheap.
            cut = f"{MARK}*[^{MARK}\n]+|{MARK}+|\n" if lines else f"{MARK}*[^{MARK}]+|{MARK}+"
            self.tokenizer.pre_tokenizer = pre_tokenizers.Split(Regex(cut), "removed", invert=True)
        self.by_unit = words and lines and trained.model_type == BPE and spec.add_dummy_prefix and not steps[2:]
        self.library = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.prefixed = spec.add_dummy_prefix
        self.starts = np.array([p.startswith(MARK) for p, _, _ in pieces])
        self.surface = [self._surface(p, kind, trained.unk_surface) for p, _, kind in pieces]
        self.memo, self.unlike = Memo(self._many), set()

    @staticmethod
    def _surface(piece: str, kind: int, unknown: str) -> bytes:
        if kind == BYTE:
            return bytes([int(piece[3:5], 16)])
        if kind == CONTROL:
            return b""
        return (unknown if kind == UNKNOWN else piece.replace(MARK, " ")).encode()

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.int32) for x in found]

    def decode(self, ids: np.ndarray) -> str:
        data = b"".join(map(self.surface.__getitem__, ids.tolist()))
        text = data.decode("utf-8", "replace")
        return text[1:] if self.prefixed and text[:1] == " " else text

    def _agree(self, texts: list[str], found: list[np.ndarray]) -> list[bool]:
        said = self.library.encode(texts, num_threads=self.threads)
        return [x.tolist() == y for x, y in zip(found, said, strict=True)]

    def _many(self, units: list[str]) -> list[bytes]:
        """Ids of units: words without a blank, that may begin with a newline; encoded as one text."""
        done = []
        for at in range(0, len(units), UNITS_AT_ONCE):
            part = units[at : at + UNITS_AT_ONCE]
            text = " ".join(part)
            ids = self.encode_batch([text])[0]
            cuts = np.flatnonzero(self.starts[ids])
            if len(cuts) == len(part) and self._agree([text], [ids])[0]:
                data, ends = ids.tobytes(), [*(4 * cuts).tolist(), 4 * len(ids)]
                done += [data[a:b] for a, b in zip(ends, ends[1:])]
                continue
            each = self.encode_batch(part)
            self.unlike.update(u for u, same in zip(part, self._agree(part, each), strict=True) if not same)
            done += [x.tobytes() for x in each]
        return done

    def encode(self, text: str) -> tuple[np.ndarray, bool]:
        """Ids, and whether the sentencepiece library has the same."""
        if not text:
            return np.zeros(0, np.int32), True
        odd = MARK in text or "  " in text or text[0] in " \n" or text[-1] == " " or " \n" in text
        if odd or not self.by_unit:
            ids = self.encode_batch([text])[0]
            return ids, self._agree([text], [ids])[0]
        out, same = [], True
        for k, part in enumerate(in_chunks(text, " ")):
            units = part.replace("\n", " \n").split(" ")
            units = units[1:] if k else units
            # A unit that begins with a newline had no blank before it, so its marker goes.
            out += [ids[4:] if u[:1] == "\n" else ids for u, ids in zip(units, self.memo(units), strict=True)]
            same = same and self.unlike.isdisjoint(units)
        return np.frombuffer(b"".join(out), np.int32), same


@cache
def codec(model_file: str, threads: int = 1) -> Codec:
    return Codec(model_file, threads)


def encode(
    docs: DataFrame, model_file: str, threads: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: doc_id, ids, n_ids, decoded_sha256, round_trip (decodes to the text), parity."""
    texts = columns(docs, doc_id=id_col, text=text_col)
    texts = texts.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(model_file, threads)
        for batch in batches:
            # A few texts at a time, as ids take more room than text.
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                ids, digests, trips, parity = [], [], [], []
                for x in part.column("text"):
                    text = x.as_py()
                    found, same = model.encode(text)
                    back = model.decode(found)
                    ids.append(found)
                    digests.append(hashlib.sha256(back.encode("utf-8", "surrogatepass")).hexdigest())
                    trips.append(back == text)
                    parity.append(same)
                ends = np.cumsum([0, *map(len, ids)])
                flat = np.concatenate([*ids, np.zeros(0, np.int32)])
                fields = [
                    part.column("doc_id"),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32())),
                    pa.array(np.diff(ends), pa.int64()),
                    pa.array(digests, pa.string()),
                    pa.array(trips, pa.bool_()),
                    pa.array(parity, pa.bool_()),
                ]
                names = ["doc_id", "ids", "n_ids", "decoded_sha256", "round_trip", "parity"]
                yield pa.RecordBatch.from_arrays(fields, names)

    return texts.mapInArrow(run, ENCODED)


def decode(encoded: DataFrame, model_file: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row: doc_id, text. Null ids decode to an empty text."""
    rows = columns(encoded, doc_id=id_col, ids=ids_col)
    rows = rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = codec(model_file)
        for batch in batches:
            texts = [model.decode(np.array(x.as_py() or [], np.int32)) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(run, "doc_id long, text string")
