"""Shared helpers: stored intermediate tables, word hashing, runs of equal keys, components.

Row identity: operators number rows with ``monotonically_increasing_id`` over the documents they are given,
and may read those documents again. The input must therefore be a stored table (a Parquet scan or
anything else that yields the same rows in the same partitions each time), which also lets a lost
executor's tasks be run again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadpulse.session import checkpoint_dir

MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
BATCH_BYTES = 4 << 20
# Rows of a few numbers that go to Python at once.
NARROW_ROWS = 30_000
CHUNK_CHARS = 2_000_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents_of(docs: DataFrame) -> DataFrame:
    """rid, doc_id (0 where there is none), no_id and text: without NULLs, which would make long ids doubles in pandas."""
    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.monotonically_increasing_id().alias("rid"), F.coalesce(doc_id, F.lit(0)).alias("doc_id"),
                       doc_id.isNull().alias("no_id"), "text")


def nullable(doc_id, no_id) -> pd.Series:
    """Ids as they are to be returned."""
    return pd.Series(np.asarray(doc_id, np.int64)).astype("Int64").mask(np.asarray(no_id, bool))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bound_batches(spark: SparkSession) -> None:
    """Sets two things for the session: a batch of rows sent to Python holds a bounded number of bytes, however long the texts are,
    and bounded tables that are collected come as columns, not as a Python object for each row."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    spark.conf.set("spark.sql.execution.arrow.pyspark.enabled", "true")


def without_shuffles(df: DataFrame) -> DataFrame:
    """The same rows, as a frame to be run once: Spark removes its shuffle files when that run ends, not when the driver happens to collect garbage.

    Spark takes the setting when a frame is made, so other frames of the session keep their own.
    """
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return df.select("*")
    finally:
        conf.set(name, before)


class Scratch:
    """Intermediate tables of one job, as Parquet below the shared folder the session names.

    Every table is written whole before it is read, so what follows does not depend on the
    executors that made it, and the shuffle files of its making go as soon as it is written.
    ``drop`` removes a table that no later step reads.
    """

    def __init__(self, spark: SparkSession, job: str):
        self.spark = spark
        self.root = f"{checkpoint_dir(spark)}/{job}-{uuid.uuid4().hex}"
        self.count = 0
        bound_batches(spark)

    def store(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}-{name}"
        schema = df.schema
        without_shuffles(df).write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)

    def store_narrow(self, df: DataFrame, name: str) -> DataFrame:
        """As ``store``, of what sends rows of a few numbers to Python: these are counted, as Spark would ask each column for its size at each row."""
        conf = self.spark.conf
        limits = {"spark.sql.execution.arrow.maxRecordsPerBatch": NARROW_ROWS, "spark.sql.execution.arrow.maxBytesPerBatch": (1 << 31) - 1}
        before = {limit: conf.get(limit) for limit in limits}
        try:
            for limit, value in limits.items():
                conf.set(limit, str(value))
            return self.store(df, name)
        finally:
            for limit, value in before.items():
                conf.set(limit, value)

    def drop(self, df: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        for file in {f.rpartition("/")[0] for f in df.inputFiles()}:
            if self.root.rpartition("/")[2] in file:
                path = jvm.org.apache.hadoop.fs.Path(file)
                path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)

    def clear(self) -> None:
        """Removes all tables of this job."""
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_kept: dict[str, Callable[[], None]] = {}


def keep_alone(name: str, clear: Callable[[], None] = lambda: None) -> None:
    """Says whose tasks a Python worker runs now; what other operators have kept in it is let go.

    Workers serve one task after another, so without this a pipeline would add up the caches of all its stages.
    """
    others = [k for k in _kept if k != name]
    for other in others:
        _kept.pop(other)()
    if others:
        pa.default_memory_pool().release_unused()
    _kept[name] = clear


def chunks(lengths: list[int], most: int = CHUNK_CHARS) -> Iterator[slice]:
    """Cuts a list of texts into runs of about ``most`` characters; a longer text is a run by itself."""
    start = total = 0
    for i, n in enumerate(lengths):
        if i > start and total + n > most:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(lengths):
        yield slice(start, len(lengths))


def text_chunks(texts, most: int = CHUNK_CHARS) -> Iterator[tuple[slice, list[str]]]:
    """Runs of texts of bounded size, NULL as the empty text."""
    own = [t if isinstance(t, str) else "" for t in texts]
    for part in chunks([len(t) for t in own], most):
        yield part, own[part]


def split_words(texts: list[str]) -> tuple[list[bytes], np.ndarray]:
    """All words (maximal runs of other than ASCII white space) and each text's first word's number."""
    parts = [t.encode("utf-8", "surrogatepass").split() for t in texts]
    offsets = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=offsets[1:])
    return [w for p in parts for w in p], offsets


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread, one to one."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(h: np.ndarray, size: int = 5) -> np.ndarray:
    """Distinct 64-bit hashes of runs of ``size`` words, sorted; of all words if there are fewer."""
    n = len(h)
    if not n:
        return h[:0]
    width = min(size, n)
    g = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        g = g * MIX_A + h[k:n - width + 1 + k] * MIX_B
    return np.unique(mixed(g))


def word_places(text: str) -> tuple[np.ndarray, np.ndarray]:
    """First code point and end of each word."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    inside = np.r_[False, ~((codes == 32) | ((codes >= 9) & (codes <= 13))), False]
    return np.flatnonzero(inside[1:-1] & ~inside[:-2]), np.flatnonzero(inside[1:-1] & ~inside[2:]) + 1


def run_hashes(h: np.ndarray, width: int) -> np.ndarray:
    """64-bit hashes of all runs of ``width`` words, by differences of one running polynomial."""
    n = len(h) - width + 1
    if n <= 0:
        return h[:0]
    base, inverse = int(MIX_A), pow(int(MIX_A), -1, 1 << 64)
    powers = np.full(len(h), base, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    back = np.full(n, inverse, np.uint64)
    back[0] = 1
    sums = np.r_[np.uint64(0), np.cumsum(h * powers, dtype=np.uint64)]
    return mixed((sums[width:] - sums[:n]) * np.cumprod(back, dtype=np.uint64) + np.uint64(width))


def sliding(x: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest value of each run of ``width`` values."""
    pick, have = np.minimum if least else np.maximum, 1
    while have < width:
        step = min(have, width - have)
        x = pick(x[:-step], x[step:])
        have += step
    return x


def signed(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64).view(np.int64)


def _linked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """In rows sorted by k, in any order within it: each row's link to the first of its run; the outer runs' heads with their key."""
    key = head = None
    first_key = None
    for b in batches:
        if b.empty:
            continue
        k, v = b["k"].to_numpy(), b["v"].to_numpy()
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        heads = np.repeat(v[starts], np.diff(np.r_[starts, len(k)]))
        if key is not None and k[0] == key:
            heads[:starts[1] if len(starts) > 1 else len(k)] = head
        if first_key is None:
            first_key = int(k[0])
            yield pd.DataFrame({"a": [int(v[0])], "b": [None], "k": [first_key]}).astype({"b": "Int64"})
        link = heads != v
        if link.any():
            yield pd.DataFrame({"a": v[link], "b": heads[link], "k": k[link]}).astype({"b": "Int64"})
        key, head = int(k[-1]), int(heads[-1])
    if key is not None and key != first_key:
        yield pd.DataFrame({"a": [head], "b": [None], "k": [key]}).astype({"b": "Int64"})


def run_links(scratch: Scratch, rows: DataFrame) -> DataFrame:
    """Links (a, b) that join all values v of each key k, found by sorting and looking at neighbours.

    ``rows`` (k, v: long) are read twice, so they must be stored or cheaply made from a stored table. They are range-sorted by (k, v), so a key with any share
    of the rows lies in as many tasks as it needs; a task sorts by k alone, which Spark does without comparing rows. Each row is linked to the
    first of its run in that task, and runs that a task border cuts are joined through one row per border.
    """
    found = scratch.store_narrow(
        rows.repartitionByRange("k", "v").sortWithinPartitions("k")
        .mapInPandas(_linked, "a long, b long, k long"), "runs")
    edge = found.where("b IS NULL")
    first = edge.groupBy("k").agg(F.min("a").alias("b"))
    return found.where("b IS NOT NULL").select("a", "b").unionByName(
        edge.drop("b").join(first, "k").where("a <> b").select("a", "b"))


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of (a, b) links: one row (v, root) per linked value, root the least of its component.

    Alternates large-star and small-star steps, which halve distances. Each step shuffles the links once, and the least neighbour
    is found where they arrive; the links are stored after each round, and rounds end when one changes nothing. ``edges`` are read once.
    """
    def digest(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b") % 1_000_003), F.sum(F.col("a").cast("decimal(38,0)")),
                            F.sum(F.col("b").cast("decimal(38,0)"))).first())

    least = F.min("b").over(Window.partitionBy("a"))
    now, seen = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), None
    while True:
        both = now.select(F.inline(F.expr("array(struct(a, b), struct(b AS a, a AS b))")))
        large = both.withColumn("m", F.least("a", least)).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # Both steps give links (a, b) with b < a.
        small = large.withColumn("m", least).select(F.inline(F.expr("array(struct(a, m AS b), struct(b AS a, m AS b))"))).where("a <> b")
        after = scratch.store(small.distinct(), "stars")
        if seen:
            scratch.drop(now)
        now, last, seen = after, seen, digest(after)
        if last == seen or not seen[0]:
            break
    return now.select(F.col("a").alias("v"), F.col("b").alias("root")).unionByName(
        now.select(F.col("b").alias("v"), F.col("b").alias("root")).distinct())
