"""Cross-entropy difference of matched n-gram models (operator 3).

A target model (documents labelled good) and a background model (all other documents) are word bigram models of one form over one
vocabulary: shares of pairs, shares of words, and a floor of word shares over both corpora are mixed by ``WEIGHTS``. The mean difference
of a document's losses per token is its score; lower means more like the target. A document's own words and pairs are taken off all counts before it
is scored, so no model holds the document it scores, and words that no other document has weigh the same in both. Every word and pair
is counted exactly, up to equal 62-bit hashes: none is left out or shares a counter, and the tables grow with the input.

The counts never meet in one place. Documents lie in blocks of bounded size, one stored row each, compressed. A block sends its distinct keys
with their counts, sorted and cut by their leading bits; the counts of up to about ``FAN`` blocks are added per cut, those sums by ``FAN`` again in finer cuts,
and so on. The totals go back down the same way, in the order of each block's keys, so the keys themselves move up only. A task holds one
cut of some ``FAN`` nodes, at every size of the input, and a key comes once from each of them, so no key is hot.

Rows: NULL, empty and blank texts have no tokens and scores of 0; NULL ``doc_id`` rows count as background; repeated ids and equal
rows count each, and only the row itself is taken off; an id with several labels is target if one of them is 1; an empty table gives no rows; without any
target document the target model is its floor; long texts are scored whole. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import MIX_A, MIX_B, Scratch, hash_words, mixed, nullable, read_table, text_chunks

# Characters of a block's texts, but for a single longer text.
BLOCK_CHARS = 8_000_000
# Nodes whose counts are added in one step, and bits by which a node's keys are cut for it.
FAN, CUT_BITS = 256, 8
# Weights of pairs, of words, and of the floor of words of both corpora; added to each count of the floor.
WEIGHTS, SMOOTHING = (0.6, 0.3, 0.1), 0.5
# Kinds of keys, in their last two bits; START is a key by itself.
WORD, PAIR, START = np.uint64(1), np.uint64(2), np.uint64(3)
NODES = "node long, part long, k binary, target binary, background binary"


def packed(texts: list[str]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress("".join(texts).encode("utf-8", "surrogatepass"))


def unpacked(data: bytes, lengths: np.ndarray) -> list[str]:
    whole = zstandard.ZstdDecompressor().decompress(data).decode("utf-8", "surrogatepass")
    ends = np.cumsum(lengths).tolist()
    return [whole[e - n:e] for e, n in zip(ends, lengths.tolist())]


def in_blocks(docs: DataFrame, most: int) -> DataFrame:
    """block, doc_ids, no_ids, lengths, texts: one row for a run of rows of one task with about ``most`` characters.

    Blocks depend on the task, so they must be stored."""
    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, total, held = TaskContext.get().partitionId() << 32, 0, []

        def row() -> pd.DataFrame:
            ids, missing, texts = zip(*held)
            return pd.DataFrame({"block": [block], "doc_ids": [list(ids)], "no_ids": [list(missing)],
                                 "lengths": [[len(t) for t in texts]], "texts": [packed(texts)]})

        for b in batches:
            for own in zip(b["doc_id"].tolist(), b["no_id"].tolist(), b["text"].tolist()):
                if held and total + len(own[2]) > most:
                    yield row()
                    block, total, held = block + 1, 0, []
                total += len(own[2])
                held.append(own)
        if held:
            yield row()

    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNull().alias("no_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(
        number, "block long, doc_ids array<long>, no_ids array<boolean>, lengths array<long>, texts binary")


def target_places(blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """block, places: the rows of each block whose id is labelled good. Texts do not move for it."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    rows = blocks.select("block", F.posexplode(F.arrays_zip("doc_ids", "no_ids")).alias("place", "own")).where("NOT own.no_ids")
    return rows.select("block", "place", F.col("own.doc_ids").alias("doc_id")).join(good, "doc_id", "left_semi").groupBy("block").agg(
        F.collect_list("place").alias("places"))  # at most the rows of one block


def token_keys(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Keys of each token as a word and of it with its predecessor (rows), and each text's number of tokens."""
    cut = [t.lower().split() for t in texts]
    lengths = np.array([len(own) for own in cut], np.int64)
    h = hash_words([w.encode("utf-8", "surrogatepass") for own in cut for w in own])
    before = np.r_[np.zeros(1, np.uint64), h[:-1]] if len(h) else h
    before[(np.cumsum(lengths) - lengths)[lengths > 0]] = 0  # a text's start
    kind = ~np.uint64(3)
    return np.stack([mixed(h * MIX_A + WORD) & kind | WORD, mixed(mixed(before * MIX_A + PAIR) + h * MIX_B) & kind | PAIR]), lengths


def block_keys(row: pd.Series, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of all tokens of a block as words, then with their predecessors, then a start for each text with words; each text's
    number of tokens; and whether each key is of the target."""
    parts = [token_keys(texts) for _, texts in text_chunks(unpacked(row["texts"], np.asarray(row["lengths"], np.int64)))]
    lengths = np.concatenate([n for _, n in parts])
    keys = np.concatenate([k for k, _ in parts], 1).ravel()
    own = np.repeat(flags, lengths)
    full = lengths > 0
    return np.r_[keys, np.full(full.sum(), START)], lengths, np.r_[own, own, flags[full]]


def counted(keys: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, their counts in target and background, and each key's number."""
    unique, number = np.unique(keys, return_inverse=True)
    good = np.bincount(number[target], minlength=len(unique))
    return unique, np.stack([good, np.bincount(number, minlength=len(unique)) - good]), number


def narrow(counts: np.ndarray) -> bytes:
    """Counts in as few bytes each as the greatest needs."""
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{max(1, len(data) // max(1, n))}").astype(np.int64)


def key_bytes(keys: np.ndarray) -> bytes:
    """Sorted distinct keys: bytes of a gap, the first key, and the gaps in that many bytes."""
    if not len(keys):
        return b""
    gaps = np.diff(keys)
    size = (int(gaps.max(initial=1)).bit_length() + 7) // 8
    return bytes([size]) + keys[:1].tobytes() + gaps.view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def keys_of(data: bytes) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint64)
    gaps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, data[0])
    every = np.zeros((len(gaps) + 1, 8), np.uint8)
    every[1:, :data[0]] = gaps
    keys = every.view(np.uint64).ravel()
    keys[0] = np.frombuffer(data, np.uint64, 1, 1)[0]
    return np.cumsum(keys, dtype=np.uint64)


def cuts(node: int, keys: np.ndarray, counts: np.ndarray, bits: int) -> pd.DataFrame:
    """Rows of a node, one for each value of the first ``bits`` bits of its sorted keys."""
    top = (keys >> np.uint64(64 - bits)).astype(np.int64)
    starts = np.flatnonzero(np.r_[True, top[1:] != top[:-1]]) if len(top) else np.zeros(0, np.int64)
    runs = [slice(a, b) for a, b in zip(starts, np.r_[starts[1:], len(top)])]
    return pd.DataFrame({"node": np.full(len(runs), node, np.int64), "part": top[starts], "k": [key_bytes(keys[r]) for r in runs],
                         "target": [narrow(counts[0, r]) for r in runs], "background": [narrow(counts[1, r]) for r in runs]})


def read_cuts(rows: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray]]:
    found = []
    for k, target, background in zip(rows["k"], rows["target"], rows["background"]):
        keys = keys_of(k)
        found.append((keys, np.stack([wide(target, len(keys)), wide(background, len(keys))])))
    return found


def added(nodes: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys of several nodes in order, and the sums of their counts."""
    unique, number = np.unique(np.concatenate([k for k, _ in nodes]), return_inverse=True)
    return unique, np.stack([np.bincount(number, np.concatenate([c[i] for _, c in nodes]), len(unique)).astype(np.int64) for i in (0, 1)])


def handed(rows: pd.DataFrame, nodes: list[tuple[np.ndarray, np.ndarray]], keys: np.ndarray, sums: np.ndarray) -> pd.DataFrame:
    """For each row of a node, the sums of its keys in their order."""
    at = [np.searchsorted(keys, k) for k, _ in nodes]
    return pd.DataFrame({"node": rows["node"].to_numpy(np.int64), "part": rows["part"].to_numpy(np.int64),
                         "target": [narrow(sums[0, a]) for a in at], "background": [narrow(sums[1, a]) for a in at]})


def totals(scratch: Scratch, rows: DataFrame, nodes: int, bits: int) -> tuple[DataFrame, np.ndarray]:
    """node, part, target, background: for each of ``rows``, the sums of its keys over all nodes, stored; and over all words
    their number and their tokens in target and background."""
    sums_of = "node long, part long, target binary, background binary"
    if nodes <= FAN:
        def top(rows: pd.DataFrame) -> pd.DataFrame:
            own = read_cuts(rows)
            keys, sums = added(own)
            word = keys & np.uint64(3) == WORD
            about = [int(word.sum()), *sums[:, word].sum(1).tolist()]
            return handed(rows, own, keys, sums).assign(words=[about] + [None] * (len(rows) - 1))

        found = scratch.store(rows.groupBy("part").applyInPandas(top, sums_of + ", words array<long>"), "totals")
        about = found.where("words IS NOT NULL").agg(*[F.sum(F.col("words")[i]) for i in range(3)]).first()
        return found.drop("words"), np.array([n or 0 for n in about], np.int64)

    parents = ceil(nodes / FAN)
    parent = F.pmod(F.xxhash64("node"), F.lit(parents)).alias("parent")

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        return cuts(int(rows["parent"].iloc[0]), *added(read_cuts(rows)), bits + CUT_BITS)

    def hand_down(rows: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        finer = read_cuts(above.sort_values("part"))
        if rows.empty:
            return pd.DataFrame({"node": [], "part": [], "target": [], "background": []})
        return handed(rows, read_cuts(rows), np.concatenate([k for k, _ in finer]), np.concatenate([c for _, c in finer], 1))

    rows = rows.select("*", parent)
    merged = scratch.store(rows.groupBy("parent", "part").applyInPandas(merge, NODES), "merged")
    sums, about = totals(scratch, merged, parents, bits + CUT_BITS)
    above = merged.select("node", "part", "k").join(sums, ["node", "part"]).withColumns(
        {"parent": F.col("node"), "coarse": F.shiftright("part", CUT_BITS)})
    found = scratch.store(rows.groupBy("parent", "part").cogroup(above.groupBy("parent", "coarse")).applyInPandas(hand_down, sums_of), "totals")
    return found, about


def flags_of(row: pd.Series, places) -> np.ndarray:
    flags = np.zeros(len(row["lengths"]), bool)
    for own in places:
        flags[np.asarray(own, np.int64)] = True
    return flags


def block_counts(blocks: DataFrame, good: DataFrame) -> DataFrame:
    """Rows of each block as a node: its distinct keys and their counts."""
    def count(block: pd.DataFrame, places: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        keys, _, target = block_keys(row, flags_of(row, places["places"]))
        return cuts(int(row["block"]), *counted(keys, target)[:2], CUT_BITS)

    return blocks.select("block", "lengths", "texts").groupBy("block").cogroup(good.groupBy("block")).applyInPandas(count, NODES)


def own_counts(number: np.ndarray, text: np.ndarray, size: int) -> np.ndarray:
    """How often each token's key is in the token's own text."""
    _, inverse, counts = np.unique(text * np.int64(size) + number, return_inverse=True, return_counts=True)
    return counts[inverse]


def losses(lengths: np.ndarray, flags: np.ndarray, sums: np.ndarray, number: np.ndarray, about: np.ndarray) -> np.ndarray:
    """Mean loss in nats of each text under the target and the background model of all other texts.

    ``sums``: counts of the distinct keys over all documents; ``number``: the place there of each key of ``block_keys``; ``about``: number of
    distinct words, and of tokens of both corpora. A pair's share is of all tokens of its first word, the last of a text among them.
    """
    n = int(lengths.sum())
    if not n:
        return np.zeros((len(lengths), 2))
    word, pair, start = number[:n], number[n:2 * n], number[2 * n]
    text = np.repeat(np.arange(len(lengths)), lengths)
    firsts = (np.cumsum(lengths) - lengths)[lengths > 0]
    own_word, own_pair = own_counts(word, text, sums.shape[1]), own_counts(pair, text, sums.shape[1])
    before, own_before = np.r_[start, word[:-1]], np.r_[1, own_word[:-1]]
    before[firsts], own_before[firsts] = start, 1
    size = lengths[text]
    floor = (sums.sum(0)[word] - own_word + SMOOTHING) / (about[1:].sum() - size + SMOOTHING * about[0])
    out = []
    for c, flag in ((0, flags[text]), (1, ~flags[text])):
        single = (sums[c, word] - own_word * flag) / np.maximum(1, about[1 + c] - size * flag)
        share = (sums[c, pair] - own_pair * flag) / np.maximum(1, sums[c, before] - own_before * flag)
        p = WEIGHTS[0] * share + WEIGHTS[1] * single + WEIGHTS[2] * floor
        out.append(np.bincount(text, -np.log(p), len(lengths)) / np.maximum(1, lengths))
    return np.stack(out, 1)


def score(scratch: Scratch, blocks: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, n_tokens, loss_target, loss_background and their difference ``score``, negative for texts like the target.

    ``blocks``: stored rows of ``in_blocks``, which both models are made of.
    """
    good = scratch.store(target_places(blocks, labels), "target")
    sums, about = totals(scratch, block_counts(blocks, good), blocks.count(), CUT_BITS)
    both = sums.select(F.col("node").alias("block"), "part", "target", "background", F.lit(None).cast("array<int>").alias("places")).unionByName(
        good.select("block", "places"), allowMissingColumns=True)

    def rate(block: pd.DataFrame, others: pd.DataFrame) -> pd.DataFrame:
        row = block.iloc[0]
        flags = flags_of(row, others["places"].dropna())
        keys, lengths, target = block_keys(row, flags)
        unique, counts, number = counted(keys, target)
        parts = others[others["part"].notna()].sort_values("part")
        widths = np.bincount((unique >> np.uint64(64 - CUT_BITS)).astype(np.int64), minlength=1 << CUT_BITS)
        if len(parts):
            counts = np.stack([np.concatenate([wide(d, widths[int(p)]) for p, d in zip(parts["part"], parts[c])]) for c in ("target", "background")])
        loss = losses(lengths, flags, counts, number, about)
        return pd.DataFrame({"doc_id": nullable(row["doc_ids"], row["no_ids"]), "n_tokens": lengths, "loss_target": loss[:, 0],
                             "loss_background": loss[:, 1], "score": loss[:, 0] - loss[:, 1]})

    return blocks.groupBy("block").cogroup(both.groupBy("block")).applyInPandas(
        rate, "doc_id long, n_tokens long, loss_target double, loss_background double, score double")


def op3_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "lm")
    blocks = scratch.store(in_blocks(read_table(spark, sf_dir, "documents"), BLOCK_CHARS), "blocks")
    return score(scratch, blocks, read_table(spark, sf_dir, "labels"))
