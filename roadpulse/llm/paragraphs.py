"""Duplicate paragraphs by MinHash banding (operator 7).

A paragraph is a line with words. Bands of MinHash values over its five-word shingles, tuned for the target recall at the
threshold, bring candidates together; exact Jaccard similarity confirms them; components are clusters, of which
the first paragraph stays. A passage set into other paragraphs would not make them alike as wholes, so runs of ``RUN`` words
are also chosen by their hashes, from all words of a text, wherever its lines end. Of every ``PASSAGE`` words that stand in two places the same run is
chosen in both. A run that others equal is extended to either side for as long as one of them has the same words; as the next chosen run is near,
``CONTEXT`` words are enough, and spans that overlap or touch and have one cluster are reported as one, to the passage's ends.

Rows: NULL and blank texts have no paragraphs; lines of fewer than five words are compared as wholes, texts of fewer than ``PASSAGE`` words have no runs;
NULL ``doc_id`` stays NULL; repeated ids and equal rows are separate documents; an empty table gives no rows; a long
line is one paragraph and many runs. Extra columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import (MIX_A, MIX_B, Scratch, hash_words, mixed, read_table, run_hashes, signed, sliding, split_words, text_chunks,
                                  word_places)
from roadpulse.llm.forest import SIZE, grouped
from roadpulse.llm.jaccard import THRESHOLD, joined_keys, signatures

RECALL, ROWS, SEED = 0.995, 3, 5
PASSAGE, RUN = 24, 12
CONTEXT = PASSAGE - RUN


def bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """The fewest bands of ``rows`` values by which pairs at the threshold meet with the target recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


class Lines:
    """The words of several texts with the lines they stand in; code points count from each text's start."""

    def __init__(self, texts: list[str]):
        codes = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        inside = np.r_[False, ~((codes == 32) | ((codes >= 9) & (codes <= 13))), False]
        begin, stop = np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1
        starts = np.cumsum([0] + [len(t) + 1 for t in texts])
        text = np.searchsorted(starts, begin, "right") - 1
        self.h = hash_words("\n".join(texts).encode("utf-8", "surrogatepass").split())
        self.begin, self.stop, self.text = begin - starts[text], stop - starts[text], text
        number = np.searchsorted(np.flatnonzero(codes == 10), begin)
        #: First word of each line and the word after its last.
        self.first = np.flatnonzero(np.r_[True, number[1:] != number[:-1]]) if len(number) else number
        self.after = np.r_[self.first[1:], len(number)]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chosen runs: number of the text, place among its words, hash. The least of each ``PASSAGE`` words' runs, with all that are equal to it."""
        windows = len(self.h) - PASSAGE + 1
        if windows <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
        g, edge = run_hashes(self.h, RUN), np.zeros(CONTEXT, np.uint64)
        low = np.where(self.text[:windows] == self.text[PASSAGE - 1:], sliding(g, CONTEXT + 1, True), np.uint64(0))
        at = np.flatnonzero(sliding(np.r_[edge, low, edge], CONTEXT + 1, False) == g)
        text = self.text[at]
        return text, at - np.searchsorted(self.text, text), g[at]


def run_shingles(h: np.ndarray, first: np.ndarray, after: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of runs of words, sorted within each run, and where each run's begin; as ``shingles`` gives them."""
    lengths = after - first
    parts, owners = [], []
    for width in range(1, size + 1):
        runs = np.flatnonzero(lengths == width if width < size else lengths >= size)
        if not len(runs):
            continue
        count = lengths[runs] - width + 1
        owner = np.repeat(runs, count)
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + first[owner]
        g = np.full(len(at), width, np.uint64)
        for k in range(width):
            g = g * MIX_A + h[at + k] * MIX_B
        parts.append(mixed(g))
        owners.append(owner)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(len(first) + 1, np.int64)
    g, owner = np.concatenate(parts), np.concatenate(owners)
    # One key of both sorts faster; it leaves out low bits of the hashes.
    order = np.argsort(owner.astype(np.uint64) << np.uint64(44) | g >> np.uint64(20)) if len(first) < 1 << 20 else np.lexsort((g, owner))
    if ((g[order[1:]] < g[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])).any():
        order = np.lexsort((g, owner))
    g, owner = g[order], owner[order]
    fresh = np.r_[True, (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])]
    g, owner = g[fresh], owner[fresh]
    return g, np.searchsorted(owner, np.arange(len(first) + 1))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of non-empty runs, wrapping at 64 bits, as signed numbers."""
    return signed(np.add.reduceat(values, starts)) if len(starts) else np.zeros(0, np.int64)


def units(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """row, doc_id, start, end (code points), hi, lo (digest of a line's shingle set), n_shingles, keys; for runs hi is the hash, start the place, and keys NULL."""
    count = bands(threshold)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in text_chunks(b["text"]):
                own = Lines(texts)
                if not len(own.h):
                    continue
                rows, docs_of = b["row"].iloc[part].to_numpy(), b["doc_id"].iloc[part].array

                def frame(first: np.ndarray, after: np.ndarray, hi, lo, size, keys) -> pd.DataFrame:
                    text = own.text[first]
                    return pd.DataFrame({"row": rows[text], "doc_id": docs_of[text], "start": own.begin[first], "end": own.stop[after - 1],
                                         "hi": hi, "lo": lo, "n_shingles": size, "keys": keys}).astype({"doc_id": "Int64"})

                flat, offsets = run_shingles(own.h, own.first, own.after)
                keys = joined_keys(signatures([flat], count * ROWS, SEED, offsets[:-1]), count, ROWS)
                yield frame(own.first, own.after, _sums(mixed(flat), offsets[:-1]), _sums(mixed(flat ^ np.uint64(0xA5A5A5A5A5A5A5A5)), offsets[:-1]),
                            np.diff(offsets), [k.tobytes() for k in keys])
                text, place, g = own.runs()
                yield pd.DataFrame({"row": rows[text], "doc_id": docs_of[text], "start": place, "end": 0, "hi": signed(g), "lo": 0,
                                    "n_shingles": 0, "keys": None}).astype({"doc_id": "Int64"})

    return docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text").mapInPandas(
        cut, "row long, doc_id long, start long, end long, hi long, lo long, n_shingles long, keys binary")


def _clusters(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of runs sorted by k, those that have an equal one, with the id of their k's first by (none, id, row, place), the number of others, and whether
    they are that first. ``shape`` is equal for two k whose runs stand in the same texts at one distance from each other. Others of a batch's
    outer two k may be in another batch, so all runs of these come, without a number."""
    for b in batches:
        if b.empty:
            continue
        k = b["k"].to_numpy()
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        n = np.diff(np.r_[starts, len(k)])
        links = n - 1
        links[[0, -1]] = -1
        b, n, links = b[np.repeat(links != 0, n)], n[links != 0], links[links != 0]
        b = b.iloc[np.lexsort([b[c].to_numpy() for c in ("place", "row", "id", "none")] + [np.repeat(np.arange(len(n)), n)])]
        row, place = b["row"].to_numpy(), b["place"].to_numpy()
        starts = np.cumsum(n) - n
        head = np.repeat(starts, n)
        shape = np.add.reduceat(mixed(mixed(row.astype(np.uint64)) * MIX_A + (place - place[head]).astype(np.uint64) * MIX_B), starts)
        yield b.assign(shape=signed(np.repeat(shape, n)), first_none=b["none"].to_numpy()[head], first_id=b["id"].to_numpy()[head],
                       n_links=np.repeat(links, n), keep=head == np.arange(len(head)))


def clustered(scratch: Scratch, chosen: DataFrame) -> DataFrame:
    """k, row, doc_id, place, shape, class_id, n_links, keep of the runs that others equal. Dealt by ranges, so that a hot run lies in as many tasks
    as it needs; a task sorts by k alone, which Spark does without comparing rows."""
    order = ["k", "none", "id", "row", "place"]
    told = scratch.store_narrow(chosen.select(
        F.col("hi").alias("k"), F.col("doc_id").isNull().alias("none"), F.coalesce("doc_id", F.lit(0)).alias("id"), "row",
        F.col("start").cast("int").alias("place")).repartitionByRange(*order).sortWithinPartitions("k").mapInPandas(
        _clusters, "k long, none boolean, id long, row long, place int, shape long, first_none boolean, first_id long, n_links long, keep boolean"),
        "matched")
    told = told.select("k", "row", F.expr("if(none, NULL, id)").alias("doc_id"), "place", "shape",
                       F.expr("if(first_none, NULL, first_id)").alias("class_id"), "n_links", "keep")
    # Some k of each batch; their shapes are parts only, so that each has its own.
    late = told.where("n_links < 0").select("k", "row", "doc_id", "place", F.col("k").alias("shape"))
    sizes = late.groupBy("k").agg(
        F.count("*").alias("n"), F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row", "place")).alias("first")).where("n > 1")
    return told.where("n_links > 0").unionByName(late.join(sizes, "k").select(
        *late.columns, "class_id", (F.col("n") - 1).alias("n_links"), F.expr("row = first.row AND place = first.place").alias("keep")))


def _binary(values: np.ndarray, given: np.ndarray) -> pa.Array:
    """The rows of an array of 32-bit numbers as bytes, each where the next of ``given`` is true, and NULL elsewhere."""
    offsets = np.zeros(len(given) + 1, np.int32)
    np.cumsum(given * (4 * values.shape[1]), out=offsets[1:])
    parts = (np.packbits(given, bitorder="little"), offsets, np.ascontiguousarray(values, np.uint32))
    return pa.Array.from_buffers(pa.binary(), len(given), [pa.py_buffer(x.tobytes()) for x in parts])


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs at the given places with the words on either side, outwards, where these are asked for; for ends of chains, also the code points where a span
    that takes in 0, 1, ... of these begins or ends, the last one again where the text ends."""
    steps = np.arange(CONTEXT + 1)
    for b in batches:
        many = b.column("places").value_lengths().to_numpy()
        cuts, row = np.r_[0, np.cumsum(many)], b.column("row").to_numpy()
        k, place, head, side = (b.column(c).flatten().to_numpy() for c in ("ks", "places", "heads", "sides"))
        for part, texts in text_chunks(b.column("text").to_pylist()):
            own = slice(cuts[part.start], cuts[part.stop])
            flat, offsets = split_words(texts)
            begin, end = word_places("\n".join(texts))
            text = np.repeat(np.arange(len(texts)), many[part])
            origin = np.cumsum([0, *(len(t) + 1 for t in texts)])[text][:, None]
            low, high, at = offsets[text][:, None], offsets[text + 1][:, None], (offsets[text] + place[own])[:, None]
            asks = [side[own] & bit > 0 for bit in (1, 2, 4, 8)]
            near = [x[ask] for x, ask in zip((at - steps[1:], at + RUN - 1 + steps[1:]), asks)]
            near = [np.where((x >= low[ask]) & (x < high[ask]), x, len(flat)) for x, ask in zip(near, asks)]
            used, short = np.zeros(len(flat) + 1, bool), np.zeros(len(flat) + 1, np.uint32)
            for x in near:
                used[x] = True
            used = np.flatnonzero(used[:-1])
            short[used] = hash_words([flat[i] for i in used.tolist()]) >> np.uint64(32)
            starts = (begin[np.maximum(at - steps, low)] - origin)[asks[2]]
            ends = (end[np.minimum(at + RUN - 1 + steps, high - 1)] - origin)[asks[3]]
            columns = {"k": pa.array(k[own]), "row": pa.array(np.repeat(row[part], many[part])), "place": pa.array(place[own]),
                       "head": pa.array(head[own]), "before": _binary(short[near[0]], asks[0]), "behind": _binary(short[near[1]], asks[1]),
                       "starts": _binary(starts, asks[2]), "ends": _binary(ends, asks[3])}
            yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _equal_words(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.cumprod(a == b, axis=1).sum(1)


def _reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In rows sorted by k and words: the most words that each has like another of its k, -1 without another. The outer rows of the task
    come once more, with the task's number, as their neighbours are not seen here. Other columns stay."""
    def told(rows: pd.DataFrame, reach, task=None) -> pd.DataFrame:
        own = rows.assign(reach=reach, task=task, k=None, words=None)
        if task is not None:
            own["k"], own["words"] = rows["k"], rows["words"]
        return own.astype({"task": "Int64", "k": "Int64"})

    task, held, before = TaskContext.get().partitionId(), None, -1
    for b in batches:
        if b.empty:
            continue
        if held is None:
            yield told(b.iloc[:1], -1, 2 * task)
        rows = b if held is None else pd.concat([held, b], ignore_index=True)
        k, words = rows["k"].to_numpy(), np.frombuffer(b"".join(rows["words"]), np.uint32).reshape(len(rows), -1)
        like = np.where(k[1:] == k[:-1], _equal_words(words[1:], words[:-1]), -1)
        left = np.r_[before, like]
        yield told(rows.iloc[:-1], np.maximum(left[:-1], like))
        held, before = rows.iloc[-1:], int(left[-1])
    if held is not None:
        yield told(held, before)
        yield told(held, -1, 2 * task + 1)


def _points(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows with points and their reach, with the code point of that; the outer rows of the task come as they are."""
    for rows in _reach(batches):
        rows = rows[rows["task"].notna() | (rows["points"].notna() & (rows["reach"] >= 0))]
        if rows.empty:
            continue
        if rows["task"].isna().all():
            points = np.frombuffer(b"".join(rows["points"]), np.uint32).reshape(len(rows), -1)
            rows = rows.assign(point=points[np.arange(len(rows)), rows["reach"].to_numpy()].astype(np.int32), points=None)
        else:
            rows = rows.assign(point=-1)
        yield rows


def reaches(scratch: Scratch, runs: DataFrame, words: str, points: str) -> DataFrame:
    """row, head, place, reach, point of runs with points: the greatest reach of a place holds. Sorted, so that a hot run lies in as many tasks as it needs."""
    order = ["k", "words", "row", "place"]
    found = scratch.store_narrow(
        runs.where(f"{words} IS NOT NULL").select("k", F.col(words).alias("words"), "row", "place", "head", F.col(points).alias("points"))
        .repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
            _points, "row long, place int, head int, reach int, point int, task long, k long, words binary, points binary"), "reaches")
    # Two rows of each task.
    edge = found.where("task IS NOT NULL").orderBy("task").collect()
    over = [(-1, -1, -1, 0, -1)]
    for pair in zip(edge, edge[1:]):
        if pair[0]["task"] // 2 != pair[1]["task"] // 2 and pair[0]["k"] == pair[1]["k"]:
            n = int(_equal_words(*(np.frombuffer(x["words"], np.uint32)[None] for x in pair))[0])
            over += [(x["row"], x["head"], x["place"], n, int(np.frombuffer(x["points"], np.uint32)[n])) for x in pair if x["points"] is not None]
    names = ["row", "head", "place", "reach", "point"]
    return found.where("task IS NULL").select(*names).unionByName(scratch.spark.createDataFrame(
        pd.DataFrame(over, columns=names), "row long, head int, place int, reach int, point int").where("row >= 0"))


def passages(scratch: Scratch, docs: DataFrame, equal: DataFrame) -> DataFrame:
    """row, doc_id, start, end, class_id, n_links, keep: spans of equal runs extended as far as another place has the same words.

    Runs of one text and cluster that overlap or touch are a chain. Two neighbours in it of one shape stand in the same texts, so that the later one can
    add nothing on the left, nor the earlier one on the right; neither can a run that begins ``CONTEXT`` words after its chain's first on the
    left. Words are compared only for the other runs, and those that equal them.
    """
    cluster = ["row", "class_id", "n_links", "keep"]
    along = Window.partitionBy(*cluster).orderBy("place")
    chains = scratch.store(
        equal.withColumns({f"{at}_{c}": f(c).over(along) for at, f in (("last", F.lag), ("next", F.lead)) for c in ("place", "shape")})
        .withColumn("head", F.max(F.expr(f"if(place - last_place <= {RUN}, NULL, place)")).over(along.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("side", F.expr(f"""
            if(place - head >= {CONTEXT} OR (shape <=> last_shape AND place - last_place <= {RUN}), 0, 1)
            + if(shape <=> next_shape AND next_place - place <= {RUN}, 0, 2)""")).select("k", "doc_id", *cluster, "place", "head", "side"), "chains")
    scratch.drop(equal)
    # Stored, so that the join of a hot run's rows is a plain one that Spark can split.
    asked = scratch.store(chains.where("side > 0").groupBy("k").agg(F.bit_or("side").alias("asked")), "asked")
    wanted = chains.join(asked, "k").groupBy("row").agg(F.collect_list(F.struct(
        "k", "place", "head", F.expr("asked + 4 * side").alias("side"))).alias("runs")).select(
        "row", F.col("runs.k").alias("ks"), F.col("runs.place").alias("places"), F.col("runs.head").alias("heads"), F.col("runs.side").alias("sides"))
    texts = docs.select(F.monotonically_increasing_id().alias("row"), "text")
    runs = scratch.store(texts.join(wanted.hint("merge"), "row").mapInArrow(
        _contexts, "k long, row long, place int, head int, before binary, behind binary, starts binary, ends binary"), "runs")
    begins = reaches(scratch, runs, "before", "starts").select("row", "head", F.expr("place - reach").alias("word"), F.col("point").alias("start"))
    finishes = reaches(scratch, runs, "behind", "ends").select("row", "head", F.expr(f"place + {RUN} + reach").alias("after"), F.col("point").alias("end"))
    scratch.drop(runs)
    # One row of each chain has its cluster; those of its ends have the code points.
    spans = chains.where("place = head").select("doc_id", *cluster, "head").unionByName(begins, True).unionByName(finishes, True).groupBy(
        "row", "head").agg(*(F.max(c).alias(c) for c in ("doc_id", "class_id", "n_links", "keep", "after", "end")),
                           *(F.min(c).alias(c) for c in ("word", "start")))
    cluster = ["row", "doc_id", "class_id", "n_links", "keep"]
    along = Window.partitionBy(*cluster).orderBy("word", "after")
    cut = spans.withColumn("cut", (F.col("word") > F.max("after").over(along.rowsBetween(Window.unboundedPreceding, -1))).cast("int"))
    return cut.withColumn("span", F.sum(F.coalesce("cut", F.lit(0))).over(along.rowsBetween(Window.unboundedPreceding, 0))).groupBy(*cluster, "span").agg(
        F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end")).drop("span")


def paragraph_clusters(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Paragraphs and passages that are in clusters of two or more: row, doc_id, kind, start, end, cluster_doc_id, n_links, keep.

    ``cluster_doc_id``: the least id in the cluster; ``keep``: whether this is its first, by (doc_id, row, place). A passage's cluster is that
    of its runs; where these differ along a passage, each cluster has its span.
    """
    scratch = Scratch(docs.sparkSession, "paragraphs")
    inner = Scratch(docs.sparkSession, "lines")
    own = scratch.store(units(docs, threshold).withColumn(
        "rid", F.expr("if(keys IS NULL, NULL, monotonically_increasing_id())")), "units")
    lines, chosen = own.where("keys IS NOT NULL"), own.where("keys IS NULL")

    def sets_of(candidates: DataFrame) -> DataFrame:
        def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for part, texts in text_chunks(b["line"]):
                    words, offsets = split_words(texts)
                    flat, cuts = run_shingles(hash_words(words), offsets[:-1], offsets[1:])
                    raw, cuts = flat.tobytes(), (8 * cuts).tolist()
                    yield b.iloc[part].drop(columns="line").assign(shingles=[raw[x:y] for x, y in zip(cuts, cuts[1:])])

        places = lines.select(F.col("rid").alias("item"), "row", "start", "end").join(candidates, "item")
        texts = docs.select(F.monotonically_increasing_id().alias("row"), "text")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in candidates.schema) + ", shingles binary"
        return texts.join(places, "row").select(
            *candidates.columns, F.expr("substring(text, CAST(start AS INT) + 1, CAST(end - start AS INT))").alias("line")).mapInPandas(make, schema)

    of_lines = scratch.store(grouped(inner, lines, sets_of, threshold, ("row", "start", "end")).where("n_links > 0").select(
        "row", "doc_id", F.lit("paragraph").alias("kind"), "start", "end", "class_id", "n_links", "keep"), "of-lines")
    inner.clear()
    equal = clustered(scratch, chosen)
    scratch.drop(own)
    return of_lines.unionByName(passages(scratch, docs, equal).withColumn("kind", F.lit("passage"))).select(
        "row", "doc_id", "kind", "start", "end", F.col("class_id").alias("cluster_doc_id"), "n_links", "keep")


def op7_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paragraph_clusters(read_table(spark, sf_dir, "documents")).drop("row")
