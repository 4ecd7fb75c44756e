"""Exact Jaccard links within regions of candidates, block by block.

Used by the operators that verify MinHash candidates. Items come with the hashes of their word shingles and with
the candidate keys they collided by. A region is a component of items that share keys. Its items are
dealt to blocks of bounded size, by set size, since sets that differ more in size than the
threshold allows cannot be alike; each pair of blocks is compared in one task and once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.llm.common import Scratch, components

THRESHOLD = 0.8
BLOCK_ITEMS = 256
# Shingles of one block at most, but for a single larger item.
BLOCK_SHINGLES = 500_000


def size_bin(column: str, threshold: float) -> F.Column:
    """Sets of sizes in one bin or in neighbouring bins may reach the threshold; others cannot."""
    return F.floor(F.log(F.greatest(F.col(column), F.lit(1))) / -math.log(threshold) + 1e-9).cast("int")


def signatures(sets: list[np.ndarray], count: int, seed: int, starts: np.ndarray | None = None) -> np.ndarray:
    """MinHash values of non-empty sets of 64-bit hashes, one row for each set; ``starts`` tells where they begin in one array."""
    rng = np.random.default_rng(seed)
    factors = rng.integers(1, 1 << 63, count, dtype=np.uint64) | np.uint64(1)
    shifts = rng.integers(0, 1 << 63, count, dtype=np.uint64)
    flat = np.concatenate(sets)
    if starts is None:
        starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(starts), count), np.uint64)
    for k in range(count):
        out[:, k] = np.minimum.reduceat(flat * factors[k] + shifts[k], starts)
    return out


def joined_keys(signature: np.ndarray, groups: int, width: int) -> np.ndarray:
    """One 64-bit key for each group of ``width`` values in sequence, different groups never sharing one by design."""
    from roadpulse.llm.common import MIX_A, mixed

    out = np.empty((len(signature), groups), np.uint64)
    for g in range(groups):
        h = np.full(len(signature), g + 1, np.uint64)
        for k in range(width):
            h = mixed(h * MIX_A + signature[:, g * width + k])
        out[:, g] = h
    return out


def compare_items(side: np.ndarray, item: np.ndarray, weight: np.ndarray, keys: list[bytes], shingles: list[bytes],
                  threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links between the items of two blocks, or within one: items, their links' weight, and one item they are joined with.

    ``side`` is 0 for the block of the lower name and 1 for the other; with one side only, the block is compared with itself.
    """
    sets = [np.frombuffer(s, np.uint64) for s in shingles]
    own = np.frombuffer(b"".join(keys), np.uint64).reshape(len(keys), -1)
    alone = side[0] == side[-1]
    left = np.arange(len(item)) if alone else np.flatnonzero(side == 0)
    right = left if alone else np.flatnonzero(side == 1)
    may = np.zeros((len(left), len(right)), bool)
    for k in range(own.shape[1]):
        may |= own[left, k][:, None] == own[right, k][None, :]
    if alone:
        may &= left[:, None] < right[None, :]
    size = np.fromiter(map(len, sets), np.int64, len(sets))
    may &= np.minimum(size[left][:, None], size[right][None, :]) >= threshold * np.maximum(size[left][:, None], size[right][None, :]) - 1e-9
    used = np.union1d(left[may.any(1)], right[may.any(0)])
    if not len(used):
        return item[:0], weight[:0], item[:0]
    linked = _linked(sets, size, left, right, may, threshold, used)
    total = np.zeros(len(item), np.int64)
    np.add.at(total, left, linked @ weight[right])
    np.add.at(total, right, linked.T @ weight[left])
    # Items joined here get the first item of what they are joined with as root.
    root = np.arange(len(item))
    a, b = np.nonzero(linked)
    a, b = left[a], right[b]
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        root = root[root]
        if (root == before).all():
            break
    got = np.flatnonzero(total)
    return item[got], total[got], item[root[got]]


def compare_runs(threshold: float):
    """Compares each run of rows of one cell, in rows sorted by cell, side and item. A run is a pair of blocks, so of bounded size."""
    cell = ["root", "b1", "s1", "b2", "s2"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        for last, b in _with_last(batches):
            rows = pd.concat([*held, b], ignore_index=True) if held else b
            if rows.empty:
                continue
            names = rows[cell].to_numpy(np.int64)
            cuts = np.r_[0, np.flatnonzero((names[1:] != names[:-1]).any(1)) + 1, len(rows)]
            side, item, weight = (rows[c].to_numpy(np.int64) for c in ("side", "item", "weight"))
            keys, sets = rows["keys"].tolist(), rows["shingles"].tolist()
            out = []
            for lo, hi in zip(cuts[:-1], cuts[1:] if last else cuts[1:-1]):
                same = names[lo, 1] == names[lo, 3] and names[lo, 2] == names[lo, 4]
                if hi - lo > 1 and (same or side[lo] != side[hi - 1]):
                    out.append(compare_items(side[lo:hi], item[lo:hi], weight[lo:hi], keys[lo:hi], sets[lo:hi], threshold))
            if out:
                yield pd.DataFrame({n: np.concatenate([o[i] for o in out]) for i, n in enumerate(("item", "links", "other"))})
            held = [] if last else [rows.iloc[cuts[-2]:]]

    return compare


def _with_last(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[bool, pd.DataFrame]]:
    """Batches, and whether each is the last."""
    before = None
    for b in batches:
        if before is not None:
            yield False, before
        before = b
    if before is not None:
        yield True, before


def _linked(sets, size, left, right, may, threshold, used) -> np.ndarray:
    """Which of the pairs in ``may`` reach the threshold: few are counted pair by pair, many by a product of 0/1 matrices."""
    linked = np.zeros_like(may)
    if may.sum() <= 4 * len(used):
        for i, j in zip(*np.nonzero(may)):
            a, b = sets[left[i]], sets[right[j]]
            common = len(a) + len(b) - len(np.union1d(a, b))
            linked[i, j] = common >= threshold * (len(a) + len(b) - common) - 1e-9
        return linked
    flat = np.concatenate([sets[u] for u in used])
    values, number = np.unique(flat, return_inverse=True)
    owner = np.repeat(used, size[used])
    common = np.zeros(may.shape, np.float32)
    order = np.argsort(number, kind="stable")
    number, owner = number[order], owner[order]
    width = max(256, (4 << 20) // max(1, int(size.shape[0])))
    cuts = np.searchsorted(number, np.arange(0, len(values) + width, width))
    place = np.arange(0, len(values) + width, width)
    for lo, hi, base in zip(cuts, cuts[1:], place):
        part = np.zeros((len(size), min(width, len(values) - base)), np.float32)
        part[owner[lo:hi], number[lo:hi] - base] = 1
        common += part[left] @ part[right].T
    union = size[left][:, None] + size[right][None, :] - common
    return may & (common >= threshold * union - 1e-4)


def verified_links(scratch: Scratch, items: DataFrame, regions: DataFrame, sets_of, threshold: float = THRESHOLD) -> DataFrame:
    """Stored rows (item, links, other): weights of exact links and what to join for components.

    ``items``: item long, weight long, n_shingles, keys binary; ``regions``: v long, root long. ``sets_of(frame)`` adds the
    ``shingles`` column (sorted distinct 64-bit hashes as bytes) to a frame that has ``item``.
    """
    own = scratch.store(items.join(regions.withColumnRenamed("v", "item"), "item").withColumn(
        "bin", size_bin("n_shingles", threshold)), "candidates")
    room = F.greatest(F.lit(2), F.least(F.lit(BLOCK_ITEMS), F.lit(BLOCK_SHINGLES) / F.pow(F.lit(1 / threshold), F.col("bin") + 1)))
    blocks = own.groupBy("root", "bin").agg(F.count("*").alias("n")).select(
        "root", "bin", F.ceil(F.col("n") / room).cast("int").alias("blocks"))
    # The bins of a region are as many as there are orders of size.
    held = blocks.groupBy("root").agg(F.map_from_entries(F.collect_list(F.struct("bin", "blocks"))).alias("held"))
    # Stored, so that the join of a hot region's items is a plain one that Spark can split.
    plan = scratch.store(held.select("root", "held", F.explode("held").alias("bin", "blocks")).select(
        "root", "bin", "blocks", F.coalesce(F.expr("try_element_at(held, bin + 1)"), F.lit(0)).alias("above"),
        F.coalesce(F.expr("try_element_at(held, bin - 1)"), F.lit(0)).alias("below")), "blocks")
    dealt = own.join(plan, ["root", "bin"]).withColumn("block", F.expr("pmod(xxhash64(item), blocks)"))
    # Each item goes to the pairs its block takes part in: with blocks of its bin, of the next one, and of the one before.
    pairs = sets_of(dealt).withColumn("pair", F.explode(F.expr("""
        concat(
          transform(sequence(0, blocks - 1), o -> named_struct('b1', bin, 's1', least(block, o), 'b2', bin,
                    's2', greatest(block, o), 'side', if(block <= o, 0, 1))),
          transform(filter(sequence(0, above), o -> o < above), o -> named_struct('b1', bin, 's1', block, 'b2', bin + 1,
                    's2', CAST(o AS BIGINT), 'side', 0)),
          transform(filter(sequence(0, below), o -> o < below), o -> named_struct('b1', bin - 1, 's1', CAST(o AS BIGINT),
                    'b2', bin, 's2', block, 'side', 1)))""")))
    cells = pairs.select("root", "pair.b1", "pair.s1", "pair.b2", "pair.s2", "pair.side", "item", "weight", "keys", "shingles")

    cell = ["root", "b1", "s1", "b2", "s2"]
    return scratch.store(cells.repartition(*cell).sortWithinPartitions(*cell, "side", "item").mapInPandas(
        compare_runs(threshold), "item long, links long, other long"), "verified")


def classes(scratch: Scratch, verified: DataFrame) -> DataFrame:
    """Components of the verified links: v, root."""
    return components(scratch, verified.select(F.col("item").alias("a"), F.col("other").alias("b")))
