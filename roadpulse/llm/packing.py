"""Packing along a space-filling curve (operator 2).

Documents become token ids; hashed token counts are projected to a few dimensions, whose Hilbert
key orders the documents so that neighbours on the curve are alike. The ordered ids form one
stream that is cut into sequences of a fixed length, so only the last sequence needs padding.

Rows: NULL text counts as empty and keeps its closing id; NULL or repeated ``doc_id`` values and equal
rows are separate documents (ties go by row number); an empty table gives no pieces; a text of any length is
encoded whole and cut at sequence ends; other columns of the input are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from struct import pack as pack_bytes

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Scratch, keep_alone, text_chunks
from roadpulse.llm.tokens import byte_letters

SEQUENCE = 4096
END_ID = 2
DIMS, BITS, FEATURES = 3, 10, 4096
CACHE_ENTRIES = 500_000

# Letters of the fast path: their case and class are the same in every Unicode version.
_L = "a-zß-öø-ÿ"
_PLAIN = re.compile(f"[\\t\\n\\r -~{_L}]*").fullmatch
# Fixed value: how the tokenizer file cuts lower-case text before merging.
_PIECE = re.compile(f"[{_L}]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^\\s{_L}0-9]+").findall
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Token ids as little-endian 32-bit bytes; words between white space are encoded once and remembered.

    The tokenizer cuts at white space and again inside words, so joining the pieces' ids gives the ids of the text. A new piece goes to
    the tokenizer's model alone. Texts with other letters than Latin-1's go to the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known = Tokenizer.from_file(path), {}
        self.model, self.letters = self.tokenizer.model, byte_letters()
        letters = [chr(c) for c in range(256) if _PLAIN(chr(c)) and not chr(c).isspace()]
        probe = " ".join([*letters, *(f"the{c} {c}12 it's{c * 2}they'll" for c in letters)]).lower()
        # Whether the tokenizer cuts as ``_PIECE`` does.
        self.by_words = b"".join(map(self._learn(probe.split()).get, probe.split())) == self._whole(probe)

    @staticmethod
    def of(path: str) -> Encoder:
        """One for each worker process and file."""
        keep_alone("packing", _encoders.clear)
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        return _encoders[path]

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        own = piece if piece.isascii() else "".join([self.letters[b] for b in piece.encode()])
        ids = [t.id for t in self.model.tokenize(own)]
        return pack_bytes(f"<{len(ids)}I", *ids)

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        known, marks, out = self.known, {}, {}
        for w in words:
            if w.isalpha():
                out[w] = self._piece(w)
                continue
            ids = []
            for p in _PIECE(w):
                own = known.get(p) or marks.get(p)
                if own is None:
                    own = self._piece(p)
                    if not p.isalpha():
                        marks[p] = own
                ids.append(own)
            out[w] = b"".join(ids)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        low = [t.lower() for t in texts]
        cut = [z.split() if self.by_words and _PLAIN(z) and "<|" not in z else None for z in low]
        get = self.known.get
        own = [None if w is None else list(map(get, w)) for w in cut]
        lacking = [i for i, found in enumerate(own) if found and None in found]
        if lacking:
            new = list({w for i in lacking for w, ids in zip(cut[i], own[i]) if ids is None})
            if len(self.known) + len(new) > CACHE_ENTRIES:
                self.known.clear()
            learnt = self._learn(new)
            self.known.update(learnt)
            for i in lacking:
                own[i] = [learnt[w] if ids is None else ids for w, ids in zip(cut[i], own[i])]
        return [self._whole(t) if ids is None else b"".join(ids) for t, ids in zip(texts, own)]


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """Position on the Hilbert curve of points with unsigned integer coordinates below 2**bits.

    Bits go from the highest down. At each level the cell is named by a Gray code and the axes of all
    lower levels are reflected or swapped with the first, so that the curve runs on from cell to cell.
    """
    x = points.astype(np.int64).T.copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        top, low = 1 << level, (1 << level) - 1
        for i in range(dims):
            flip = (x[i] & top) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(flip, low, swap)
            x[i] ^= swap
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= turn
    key = np.zeros(x.shape[1], np.int64)
    for level in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> level) & 1)
    return key


def project(ids: list[np.ndarray], seed: int = 7, dims: int = DIMS, bits: int = BITS) -> np.ndarray:
    """Grid points of documents: log counts of hashed ids times a fixed normal matrix, squashed to the grid."""
    matrix = np.random.default_rng(seed).standard_normal((FEATURES, dims))
    at = np.zeros((len(ids), dims))
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    if sizes.sum():
        # One sorted list of (document, bucket) for all documents, whose runs are the counts.
        hashed = (np.concatenate(ids).astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(20)
        key = np.sort(np.repeat(np.arange(len(ids)) * FEATURES, sizes) + hashed)
        starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        doc, weight = key[starts] // FEATURES, np.log1p(np.diff(np.r_[starts, len(key)]))
        norm = np.maximum(1e-9, np.sqrt(np.bincount(doc, weight * weight, len(ids))))
        rows = matrix[key[starts] % FEATURES]
        for k in range(dims):
            at[:, k] = np.bincount(doc, weight * rows[:, k], len(ids)) / norm
    return np.minimum((1 << bits) - 1, (1 << bits) / (1 + np.exp(-1.7 * at))).astype(np.int64)


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int = END_ID) -> DataFrame:
    """rid, doc_id, key (Hilbert position), n (ids with the closing one), ids (bytes)."""
    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, close = Encoder.of(tokenizer), np.array([end_id], "<u4").tobytes()
        for b in batches:
            for part, texts in text_chunks(b["text"]):
                raw = [r + close for r in encoder.encode(texts)]
                ids = [np.frombuffer(r, "<u4") for r in raw]
                narrow = [i.astype("<u2").tobytes() if i.max() < 65536 else r for i, r in zip(ids, raw)]
                yield pd.DataFrame({"rid": b["rid"].iloc[part].to_numpy(), "doc_id": b["doc_id"].iloc[part].to_numpy(),
                                    "key": hilbert_key(project(ids), BITS), "n": [len(i) for i in ids],
                                    "ids": narrow}).astype({"doc_id": "Int64"})

    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text").mapInPandas(
        encode, "rid long, doc_id long, key long, n long, ids binary")


def _running(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    keep_alone("packed")
    total = 0
    for b in batches:
        ends = b["n"].cumsum() + total
        total = int(ends.iloc[-1]) if len(b) else total
        yield pd.DataFrame({"rid": b["rid"], "part": b["part"], "n": b["n"], "own_start": ends - b["n"]})


def place(scratch: Scratch, encoded: DataFrame) -> DataFrame:
    """Each document's first position in the stream of all ids, along the curve.

    Only keys and lengths are range-sorted. Positions run within each task; one total per task, as many rows
    as tasks, then moves each to its place.
    """
    runs = scratch.store(
        encoded.select("key", "rid", "n").repartitionByRange("key", "rid").sortWithinPartitions("key", "rid")
        .withColumn("part", F.spark_partition_id()).mapInPandas(_running, "rid long, part int, n long, own_start long"), "runs")
    before, rows = 0, []
    for part, total in sorted(tuple(r) for r in runs.groupBy("part").agg(F.sum("n")).collect()):
        rows.append((part, before))
        before += total
    moved = scratch.spark.createDataFrame(rows, "part int, before long")
    return runs.join(F.broadcast(moved), "part").select("rid", (F.col("own_start") + F.col("before")).alias("place"))


def _cut(sequence: int, with_ids: bool):
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_alone("packed")
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        for b in batches:
            rows = []
            for doc, n, raw, place in zip(b["doc_id"], b["n"], b["ids"], b["place"]):
                ids = np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype("<u4")
                start = 0
                while start < n:
                    number, offset = divmod(place + start, sequence)
                    own = ids[start:start + sequence - offset].tobytes()
                    rows.append((doc, start, len(own) // 4, zlib.crc32(own), n, number, offset) + (own,) * with_ids)
                    start += len(own) // 4
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return cut


def pack(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of documents in sequences: one row for each run of ids of one document in one sequence.

    ``ids`` (little-endian 32-bit) comes with ``with_ids``; the pieces of a sequence, by ``offset``, are its tokens.
    """
    scratch = Scratch(docs.sparkSession, "packing")
    encoded = scratch.store(encode_documents(docs, tokenizer, end_id), "ids")
    placed = encoded.select("rid", "doc_id", "n", "ids").join(place(scratch, encoded), "rid").drop("rid")
    return placed.mapInPandas(
        _cut(sequence, with_ids), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
        "sequence_id long, offset long" + ", ids binary" * with_ids)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from roadpulse.llm.common import read_table

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
