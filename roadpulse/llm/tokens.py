"""Token counts by rank-synchronous merging (operator 11).

Texts are cut into pre-tokens; the bytes of a batch's distinct pre-tokens lie one after another in a flat array of symbols with a
sequence number for each. A round looks up the rank of every pair of neighbours, takes the lowest rank of each sequence, and applies
all its occurrences at once, left ones first where they overlap. Sequences without a ranked pair leave; their symbols are their
tokens. In a byte-pair vocabulary each symbol is made by one merge and used only by later ones, so a merge never makes a pair
of lower rank, and applying all occurrences of a pair together gives what one merge after another gives.

Sequences of more than ``LONG`` symbols would need as many rounds as ranks over all their symbols. They are worked in order of
rank, with the places of each rank kept aside, so a round touches only the places it changes.

Rows: NULL text counts as empty; NULL or repeated ``doc_id`` values and equal rows are counted each by itself; an empty
table gives no rows; texts of any length are counted whole; other columns of the input are not read.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from roadpulse.llm.common import MIX_A, bound_batches, documents_of, nullable, read_table, text_chunks

LIMIT = 512
LONG = 128
CACHE_ENTRIES = 400_000
NONE = np.int64(1) << 40

# Fixed value: the pattern by which the tokenizer file cuts text, with the classes of Latin-1 written out.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", "\t-\r \x85\xa0"
_CUT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+").findall
_LATIN = re.compile("[\x00-\xff]*").fullmatch


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable bytes for themselves, the others in turn from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return [chr(b) if b in plain else chr(256 + b - sum(p < b for p in plain)) for b in range(256)]


class PreTokens:
    """Cuts texts as the tokenizer does before merging: by expression where all is Latin-1, else by the library's own cutter."""

    def __init__(self, tokenizer):
        self.cutter = tokenizer.pre_tokenizer

    def cut(self, text: str) -> list[str]:
        if _LATIN(text):
            return _CUT(text)
        return [text[i:j] for _, (i, j) in self.cutter.pre_tokenize_str(text)]


class Merger:
    """The merges of a byte-pair vocabulary: ranks by pair, in arrays."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, pairs = model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        key = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        # A table by hash, ten times as large as its entries; a taken place sends to the next one.
        self.shift = np.uint64(60 - len(key).bit_length())
        self.keys = np.full((1 << int(64 - self.shift)) + len(key), -1)
        self.ranks = np.full(len(self.keys), NONE)
        left = np.arange(len(key))
        at = self._slot(key)
        while len(left):
            free = np.flatnonzero(self.keys[at] < 0)
            first = free[np.unique(at[free], return_index=True)[1]]
            self.keys[at[first]], self.ranks[at[first]] = key[left[first]], left[first]
            rest = np.ones(len(left), bool)
            rest[first] = False
            left, at = left[rest], at[rest] + 1
        self.pair, self.made = key, np.array([vocab[a + b] for a, b in pairs], np.int64)
        self.byte = np.array([vocab[c] for c in byte_letters()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = self._slot(key)
        found = self.keys[at]
        rank = np.where(found == key, self.ranks[at], NONE)
        more = np.flatnonzero((found != key) & (found >= 0))
        while len(more):
            at[more] += 1
            found = self.keys[at[more]]
            rank[more] = np.where(found == key[more], self.ranks[at[more]], NONE)
            more = more[(found != key[more]) & (found >= 0)]
        return rank

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key.view(np.uint64) * MIX_A) >> self.shift).astype(np.int64)

    def counts(self, words: list[str]) -> np.ndarray:
        """How many tokens each pre-token becomes."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        long = size > LONG
        out = np.zeros(len(raw), np.int64)
        short = np.flatnonzero(~long)
        out[short] = self._together([raw[i] for i in short.tolist()], size[short])
        for i in np.flatnonzero(long).tolist():
            out[i] = self._in_order(raw[i])
        return out

    def _together(self, raw: list[bytes], size: np.ndarray) -> np.ndarray:
        symbol = self.byte[np.frombuffer(b"".join(raw), np.uint8)]
        owner = np.repeat(np.arange(len(raw)), size)
        out = np.zeros(len(raw), np.int64)
        while len(symbol):
            last = np.r_[owner[1:] != owner[:-1], True]
            rank = np.full(len(symbol), NONE)
            rank[:-1] = self.rank(symbol[:-1], symbol[1:])
            rank[last] = NONE
            starts = np.flatnonzero(np.r_[True, last[:-1]])
            lengths = np.diff(np.r_[starts, len(symbol)])
            least = np.minimum.reduceat(rank, starts)
            ended = least == NONE
            out[owner[starts[ended]]] = lengths[ended]
            hit = np.flatnonzero((rank == np.repeat(least, lengths)) & (rank < NONE))
            hit = hit[_alternate(np.r_[False, hit[1:] == hit[:-1] + 1][:len(hit)])]
            symbol[hit] = self.made[rank[hit]]
            keep = np.repeat(~ended, lengths)
            keep[hit + 1] = False
            symbol, owner = symbol[keep], owner[keep]
        return out

    def _in_order(self, raw: bytes) -> int:
        n = len(raw)
        symbol = np.append(self.byte[np.frombuffer(raw, np.uint8)], -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)
        places: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.rank(symbol[at], symbol[after[at]])
            at, rank = at[rank < NONE], rank[rank < NONE]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            for own in np.split(at, np.flatnonzero(rank[1:] != rank[:-1]) + 1) if len(at) else ():
                r = int(self.rank(symbol[own[:1]], symbol[after[own[:1]]])[0])
                if r not in places:
                    heapq.heappush(ranks, r)
                places.setdefault(r, []).append(own)

        note(np.arange(n - 1))
        while ranks:
            r = heapq.heappop(ranks)
            at = np.unique(np.concatenate(places.pop(r)))
            at = at[symbol[at] >= 0]
            at = at[symbol[at] << 32 | np.maximum(symbol[after[at]], 0) == self.pair[r]]
            at = at[symbol[after[at]] >= 0]
            at = at[_alternate(np.r_[False, after[at[:-1]] == at[1:]][:len(at)])]
            gone = after[at]
            symbol[at], symbol[gone] = self.made[r], -1
            after[at] = after[gone]
            before[after[gone]] = at
            left = before[at]
            note(np.unique(np.r_[at[after[at] < n], left[left >= 0]]))
        return int((symbol[:n] >= 0).sum())


def _alternate(follows: np.ndarray) -> np.ndarray:
    """Of each run of overlapping places (each but the first marked) the first, third, fifth and so on."""
    n = np.arange(len(follows))
    return (n - np.maximum.accumulate(np.where(follows, 0, n))) % 2 == 0 if len(n) else follows


class Counter:
    """Counts tokens of texts; pre-tokens of up to ``LONG`` characters are merged once and remembered, a bounded number of them."""

    _own: dict[str, Counter] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        special = [re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(sorted(special, key=len, reverse=True))) if special else None
        self.pre, self.merger, self.known = PreTokens(tokenizer), Merger(path), {}

    @classmethod
    def of(cls, path: str) -> Counter:
        """One for each worker process and file."""
        if path not in cls._own:
            cls._own[path] = cls(path)
        return cls._own[path]

    def count(self, texts: list[str]) -> list[int]:
        cut, extra = [], []
        for t in texts:
            parts = self.special.split(t) if self.special else [t]
            extra.append(len(parts) - 1)
            cut.append(self.pre.cut(parts[0]) if len(parts) == 1 else [p for part in parts for p in self.pre.cut(part)])
        seen: set[str] = set().union(*cut)
        new = list(seen.difference(self.known))
        if len(new) + len(self.known) > CACHE_ENTRIES:
            self.known.clear()
            new = list(seen)
        self.known.update(zip(new, self.merger.counts(new).tolist()))
        take = self.known.__getitem__
        out = [sum(map(take, p), n) for p, n in zip(cut, extra)]
        for p in new:
            if len(p) > LONG:
                del self.known[p]
        return out


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and whether there are more than ``limit``, for each row of ``docs``; nothing is shuffled."""
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = Counter.of(path)
        for b in batches:
            for part, texts in text_chunks(b["text"]):
                n = np.array(counter.count(texts), np.int64)
                yield pd.DataFrame({
                    "doc_id": nullable(b["doc_id"].iloc[part], b["no_id"].iloc[part]), "n_bytes": [len(t.encode("utf-8", "surrogatepass")) for t in texts],
                    "n_tokens": n, "over_limit": n > limit})

    bound_batches(docs.sparkSession)
    return documents_of(docs).drop("rid").mapInPandas(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op11_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
