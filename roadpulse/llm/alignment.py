"""Alignment of two tokenizers by inverted pair bitmaps (operator 12).

Each text, with a space before it, is encoded by a byte-level tokenizer (A) and by one of pieces (B). Both cut the same bytes, so every
stretch between neighbouring ends of any token lies in one A token and one B token: these stretches are the links. Documents
are numbered within blocks of bounded text. For each pair of ids a block holds a compressed bitmap of the documents with
such a link, OR-merged from its chunks of text, and planes of further bitmaps with the bits of the
multiplicity less one. A bitmap is a list of numbers or, where it is dense, the bits themselves. Blocks hold different documents, so the
popcounts of a pair's bitmaps add up to its number of documents; these are summed by pair, and the highest of each A id is marked. Each
block gets the scores of its own pairs back, and its postings hand them on to the documents.

What is shuffled are a row for each block and pair, not for each link, and the blocks once. No group is larger than
a block's distinct pairs or an A id's partners, however many documents there are.

Rows: NULL and empty texts, texts with U+2581 and others that B does not give back have no tokens: counts are 0 and the digest is
empty. NULL or repeated ``doc_id`` values and equal rows are documents of their own; an empty table gives no rows; very long texts are
worked in parts, cut where both tokenizers cut; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import CHUNK_CHARS, Scratch, chunks, documents_of, nullable, read_table
from roadpulse.llm.tokens import PreTokens, byte_letters

BLOCK_CHARS, BLOCK_DOCS = 16_000_000, 1 << 16
B_BITS = 24  # a pair of ids is one number, the B id in its low bits; both have less than 23
CACHE_ENTRIES = 300_000
_SEGMENTS = re.compile(" +[^ ]*").findall
_CUT_AT = re.compile(r"[!-~](?= )").search
_BLOCK = "block long, docs int, totals binary, digests array<string>, pairs binary, present binary, planes array<binary>"
_ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


class Ids:
    """Token ids of pieces of text as little-endian 32-bit bytes, remembered up to a bounded number of pieces."""

    def __init__(self, token_bytes: list[bytes]):
        self.token_bytes, self.known, self.bad = token_bytes, {}, set()
        self.sizes = np.array([len(t) for t in token_bytes], np.int64)

    def learn(self, pieces: set[str]) -> None:
        new = list(pieces.difference(self.known))
        if len(new) + len(self.known) > CACHE_ENTRIES:
            self.known.clear()
            self.bad.clear()
            new = list(pieces)
        for i in range(0, len(new), 20_000):
            own = new[i:i + 20_000]
            for piece, ids in zip(own, self.encode(own)):
                if b"".join([self.token_bytes[k] for k in ids]) != piece.encode("utf-8", "surrogatepass"):
                    self.bad.add(piece)
                self.known[piece] = np.array(ids, "<u4").tobytes()

    def pieces(self, texts: list[str]) -> tuple[list[list[str]], np.ndarray]:
        """The learnt pieces of each text, and whether their tokens give it back."""
        cut = [self.cut(t) for t in texts]
        self.learn(set().union(*cut))
        return cut, np.array([not self.bad or self.bad.isdisjoint(c) for c in cut], bool)

    def ids(self, cut: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        take = self.known.__getitem__
        raw = [b"".join(map(take, c)) for c in cut]
        return np.frombuffer(b"".join(raw), "<u4").astype(np.int64), np.fromiter(map(len, raw), np.int64, len(raw)) // 4


class ByteIds(Ids):
    """Ids of the byte-level tokenizer; strings of special tokens are plain text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.pre = PreTokens(self.library)
        byte = {c: b for b, c in enumerate(byte_letters())}
        names = sorted(self.library.get_vocab(with_added_tokens=False).items(), key=lambda v: v[1])
        assert [n for _, n in names] == list(range(len(names)))
        super().__init__([bytes(byte[c] for c in name) for name, _ in names])

    def cut(self, text: str) -> list[str]:
        return self.pre.cut(text)

    def encode(self, pieces: list[str]) -> Iterator[list[int]]:
        found = self.library.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        words = np.array(found.word_ids, np.int64)
        ends = np.searchsorted(words, np.arange(len(pieces)), "right").tolist()
        ids = found.ids
        return (ids[i:j] for i, j in zip([0, *ends], ends))


class PieceIds(Ids):
    """Ids of the tokenizer of pieces, which puts a space before a text.

    No piece holds a space behind another character, so nothing merges over the start of a run of spaces, and the
    segments between such starts are encoded each by itself.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.library.id_to_piece(i) for i in range(self.library.vocab_size())]
        if any(re.search("[^▁]▁", n) for n in names):
            raise ValueError("pieces that go on behind a space are not supported")
        self.space = self.library.encode("a ")[1:]  # for one space alone, as the library has no text for it
        super().__init__([bytes([int(n[3:-1], 16)]) if self.library.is_byte(i) else n.replace("▁", " ").encode()
                          for i, n in enumerate(names)])

    def cut(self, text: str) -> list[str]:
        return _SEGMENTS(text)

    def encode(self, pieces: list[str]) -> Iterator[list[int]]:
        return (ids or self.space for ids in self.library.encode([p[1:] for p in pieces], num_threads=1))


class Pair:
    """The two tokenizers of a task, and the work on a chunk of texts."""

    _own: dict[tuple[str, str], Pair] = {}

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteIds(path_a), PieceIds(path_b)
        na, nb = len(self.a.token_bytes), len(self.b.token_bytes)
        numbers = [str(i).encode() for i in range(max(na, nb))]
        self.text = np.array([n + b"," for n in numbers[:na]] + [n + b"|" for n in numbers[:na]] +
                             [n + b"," for n in numbers[:nb]] + [n + b";" for n in numbers[:nb]], object)

    @classmethod
    def of(cls, path_a: str, path_b: str) -> Pair:
        """One for each worker process and pair of files."""
        if (path_a, path_b) not in cls._own:
            cls._own[path_a, path_b] = cls(path_a, path_b)
        return cls._own[path_a, path_b]

    def align(self, cut_a: list[list[str]], cut_b: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
        """From the pieces of texts: n_a, n_b, n_groups, n_links of each, text number and pair of each link, and the text of each
        one's groups, closed by a semicolon."""
        n, (a, per_a), (b, per_b) = len(cut_a), self.a.ids(cut_a), self.b.ids(cut_b)
        end_a, end_b = np.cumsum(self.a.sizes[a]) - 1, np.cumsum(self.b.sizes[b]) - 1
        at_a, at_b = np.zeros(end_a[-1] + 1, bool), np.zeros(end_b[-1] + 1, bool)
        at_a[end_a] = at_b[end_b] = True
        text_a = np.repeat(np.arange(n), per_a)

        stretch = np.flatnonzero(at_a | at_b)
        link_a = (np.cumsum(at_a, dtype=np.int32)[stretch] - at_a[stretch])
        link_b = (np.cumsum(at_b, dtype=np.int32)[stretch] - at_b[stretch])
        link_text = text_a[link_a]
        both_a, both_b = at_b[end_a], at_a[end_b]
        totals = np.stack([per_a, per_b, np.bincount(text_a[both_a], minlength=n), np.bincount(link_text, minlength=n)])

        # Each token's place in the text of groups: A tokens of a group, then its B tokens.
        last_a, last_b = np.flatnonzero(both_a), np.flatnonzero(both_b)
        before_b = np.r_[0, last_b + 1][np.cumsum(both_a) - both_a]
        before_a = (last_a + 1)[np.cumsum(both_b) - both_b]
        names = np.empty(len(a) + len(b), np.int64)
        names[np.arange(len(a)) + before_b] = a + both_a * len(self.a.token_bytes)
        names[np.arange(len(b)) + before_a] = b + both_b * len(self.b.token_bytes) + 2 * len(self.a.token_bytes)
        written = self.text[names].tolist()
        ends = list(accumulate((per_a + per_b).tolist(), initial=0))
        groups = [b"".join(written[i:j]) for i, j in zip(ends, ends[1:])]
        return totals, link_text, a[link_a] << B_BITS | b[link_b], groups


def bitmaps(pair: np.ndarray, doc: np.ndarray, docs: int) -> bytes:
    """Bitmaps of documents by pair number; both sorted, by pair and document.

    Layout: number of pairs, their numbers and cardinalities (32 bits), all short lists (16 bits), all dense bit rows.
    """
    number, start, card = np.unique(pair, return_index=True, return_counts=True)
    dense = card * 16 > docs
    of = np.repeat(dense, card)
    row = (np.cumsum(dense) - 1)[np.searchsorted(number, pair[of])] if of.any() else np.zeros(0, np.int64)
    width = -(-docs // 8)
    bits = np.zeros((int(dense.sum()), width), np.uint8)
    np.bitwise_or.at(bits, (row, doc[of] >> 3), (1 << (doc[of] & 7)).astype(np.uint8))
    return b"".join([np.array([len(number)], "<u4").tobytes(), number.astype("<u4").tobytes(), card.astype("<u4").tobytes(),
                     doc[~of].astype("<u2").tobytes(), bits.tobytes()])


def _parts(raw: bytes, docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    number, card = np.frombuffer(raw, "<u4", n, 4), np.frombuffer(raw, "<u4", n, 4 + 4 * n)
    dense = card.astype(np.int64) * 16 > docs
    short = int(card[~dense].sum(dtype=np.int64))
    width = -(-docs // 8)
    bits = np.frombuffer(raw, np.uint8, int(dense.sum()) * width, 4 + 8 * n + 2 * short).reshape(-1, width)
    return number.astype(np.int64), dense, np.frombuffer(raw, "<u2", short, 4 + 8 * n), bits


def popcounts(raw: bytes, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Pair numbers and how many documents each bitmap holds."""
    number, dense, _, bits = _parts(raw, docs)
    card = np.frombuffer(raw, "<u4", len(number), 4 + 4 * len(number)).astype(np.int64)
    card[dense] = np.bitwise_count(bits).sum(1, dtype=np.int64)
    return number, card


def postings(raw: bytes, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """(pair number, document) of each set bit."""
    number, dense, short, bits = _parts(raw, docs)
    card = np.frombuffer(raw, "<u4", len(number), 4 + 4 * len(number))
    row, doc = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little")[:, :docs]) if len(bits) else (np.zeros(0, np.int64),) * 2
    return (np.r_[np.repeat(number[~dense], card[~dense]), number[dense][row]], np.r_[short.astype(np.int64), doc])


class Block:
    """Documents of bounded text, numbered from 0, with the postings of their pairs."""

    def __init__(self, pair: Pair):
        self.pair, self.doc_id, self.first, self.chars = pair, [], None, 0
        self.totals, self.hashes, self.left_out = [], [], set()
        self.links: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, first: int, doc_id: list, texts: list) -> None:
        """Texts of one chunk; those without tokens only count as documents."""
        self.first = first if self.first is None else self.first
        base = len(self.doc_id)
        self.doc_id += doc_id
        self.hashes += [None] * len(texts)
        parts: list[tuple[int, str]] = []
        for i, t in enumerate(texts):
            if t and "▁" not in t:
                parts += [(base + i, p) for p in text_parts(" " + t)]
        for part in chunks([len(p) for _, p in parts]):
            self._work(parts[part])
        self.chars += sum(len(t) for t in texts if t)

    def _work(self, parts: list[tuple[int, str]]) -> None:
        (cut_a, good_a), (cut_b, good_b) = (ids.pieces([p for _, p in parts]) for ids in (self.pair.a, self.pair.b))
        self.left_out.update(d for (d, _), good in zip(parts, good_a & good_b) if not good)
        stay = [i for i, (d, _) in enumerate(parts) if d not in self.left_out]
        if not stay:
            return
        number = np.array([parts[i][0] for i in stay])
        totals, text, pair, groups = self.pair.align([cut_a[i] for i in stay], [cut_b[i] for i in stay])
        self.totals.append((number, totals))
        for d, g in zip(number.tolist(), groups):
            if self.hashes[d] is None:
                self.hashes[d] = hashlib.sha256(g[:-1])
            else:
                self.hashes[d].update(b";" + g[:-1])
        key, times = np.unique(pair * BLOCK_DOCS + number[text], return_counts=True)
        self.links.append((key, times))

    def row(self) -> pd.DataFrame:
        docs = len(self.doc_id)
        totals = np.zeros((6, docs), np.int64)  # four counts, doc_id, and whether it is one
        totals[4] = [d or 0 for d in self.doc_id]
        totals[5] = [d is not None for d in self.doc_id]
        for number, own in self.totals:
            np.add.at(totals[:4], (slice(None), number), own)
        key = np.concatenate([k for k, _ in self.links] or [np.zeros(0, np.int64)])
        times = np.concatenate([t for _, t in self.links] or [np.zeros(0, np.int64)])
        self.links = []
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        if len(key):  # parts of one document can share a pair
            starts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, times = key[starts], np.add.reduceat(times, starts)
        if self.left_out:
            out = np.array(sorted(self.left_out))
            totals[:4, out] = 0
            stay = ~np.isin(key % BLOCK_DOCS, out)
            key, times = key[stay], times[stay]
        pairs, number = np.unique(key // BLOCK_DOCS, return_inverse=True)
        doc, planes = key % BLOCK_DOCS, []
        present = bitmaps(number, doc, docs)
        for k in range(int(times.max() - 1).bit_length() if len(times) else 0):
            own = (times - 1) >> k & 1 == 1
            planes.append(bitmaps(number[own], doc[own], docs))
        digests = ["" if h is None or d in self.left_out else h.hexdigest() for d, h in enumerate(self.hashes)]
        return pd.DataFrame({"block": [self.first], "docs": [docs], "totals": [totals.astype("<i8").tobytes()],
                             "digests": [digests], "pairs": [pairs.astype("<i8").tobytes()], "present": [present], "planes": [planes]})


def text_parts(text: str) -> Iterator[str]:
    """Cuts a long text before spaces that follow a visible ASCII character, where both tokenizers cut."""
    start = 0
    while len(text) - start > CHUNK_CHARS:
        at = _CUT_AT(text, start + CHUNK_CHARS)
        if not at:
            break
        yield text[start:at.end()]
        start = at.end()
    yield text[start:] if start else text


def _blocks(path_a: str, path_b: str, most_docs: int = BLOCK_DOCS):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pair = Pair.of(path_a, path_b)
        block = Block(pair)
        for b in batches:
            texts, doc_id = b["text"].tolist(), [None if none else d for d, none in zip(b["doc_id"].tolist(), b["no_id"])]
            for part in chunks([len(t) if t else 0 for t in texts]):
                while part.stop > part.start:
                    own = slice(part.start, min(part.stop, part.start + most_docs - len(block.doc_id)))
                    block.add(int(b["rid"].iloc[own.start]), doc_id[own], texts[own])
                    part = slice(own.stop, part.stop)
                    if len(block.doc_id) >= most_docs or block.chars >= BLOCK_CHARS:
                        yield block.row()
                        block = Block(pair)
        if block.doc_id:
            yield block.row()

    return run


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for block, docs, pairs, present in zip(b["block"], b["docs"], b["pairs"], b["present"]):
            number, card = popcounts(present, int(docs))
            yield pd.DataFrame({"pair": np.frombuffer(pairs, "<i8"), "block": block, "at": number.astype(np.int32), "n": card})


def _scored(key: tuple, blocks: pd.DataFrame, scores: pd.DataFrame) -> pd.DataFrame:
    """The scores of a block's pairs handed on along its postings."""
    row = blocks.iloc[0]
    docs = int(row["docs"])
    totals = np.frombuffer(row["totals"], "<i8").reshape(6, docs)
    count = np.zeros(len(row["pairs"]) // 8, np.int64)
    best = np.zeros(len(count), bool)
    at = scores["at"].to_numpy()
    count[at], best[at] = scores["n_docs"].to_numpy(), scores["best"].to_numpy()
    low, high = (count & 0xFFFFFF).astype(float), (count >> 24).astype(float)
    n_best, total = np.zeros(docs, np.int64), np.zeros(docs, np.int64)
    for times, raw in [(1, row["present"]), *((1 << k, p) for k, p in enumerate(row["planes"]))]:
        number, doc = postings(raw, docs)
        n_best += times * np.bincount(doc[best[number]], minlength=docs)
        for own, by in ((low, 1), (high, 1 << 24)):  # halves, as sums of doubles are exact below 2**53
            total += times * by * np.bincount(doc, own[number], docs).astype(np.int64)
    return pd.DataFrame({"doc_id": nullable(totals[4], totals[5] == 0), "n_a": totals[0], "n_b": totals[1], "n_groups": totals[2], "n_links": totals[3],
                         "n_best": n_best, "count_sum": total, "groups_sha256": list(row["digests"])})


def blocks(docs: DataFrame, path_a: str, path_b: str, most_docs: int = BLOCK_DOCS) -> DataFrame:
    """One row for each block of up to ``most_docs`` documents: their totals and digests, pairs, bitmaps and multiplicity planes."""
    return documents_of(docs).mapInPandas(_blocks(path_a, path_b, most_docs), _BLOCK)


def pair_counts(stored: DataFrame) -> DataFrame:
    """pair, block, at (the pair's number in the block), n (documents of the block that link it)."""
    return stored.select("block", "docs", "pairs", "present").mapInPandas(
        _counts, "pair long, block long, at int, n long")


def pair_scores(counts: DataFrame) -> DataFrame:
    """pair, n_docs over all blocks, and whether no pair of its A id has more."""
    total = counts.groupBy("pair").agg(F.sum("n").alias("n_docs"))
    return total.withColumn("a", F.shiftright("pair", B_BITS)).select(
        "pair", "n_docs", (F.col("n_docs") == F.max("n_docs").over(Window.partitionBy("a"))).alias("best"))


def align(docs: DataFrame, path_a: str, path_b: str, most_docs: int = BLOCK_DOCS) -> DataFrame:
    """Tokens, groups and links of each document, and what its links count over the whole table."""
    scratch = Scratch(docs.sparkSession, "alignment")
    stored = scratch.store(blocks(docs, path_a, path_b, most_docs), "blocks")
    counts = pair_counts(stored)
    scores = scratch.store(pair_scores(counts), "scores")
    scored = counts.drop("n").join(scores, "pair").select("block", "at", "n_docs", "best")
    return stored.groupBy("block").cogroup(scored.groupBy("block")).applyInPandas(_scored, _ROWS)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers as files

    return align(read_table(spark, sf_dir, "documents"), files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"))
