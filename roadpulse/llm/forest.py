"""N-gram Jaccard join by MinHash bands (operator 4).

Each text's set of five-word shingles gets a label of MinHash values in each of several trees. The length of the labels
is the most with which pairs at the threshold meet in some tree with the target recall; it follows from the threshold, the recall and the
number of trees. This is fixed banding: no tries are built, and nothing is shortened by what was matched. Texts with an equal
label in a tree are candidates, which are then verified exactly.

Rows: texts of one to four words have one shingle of all their words; NULL, empty and blank texts have none, are linked to
nothing and form classes of their own; texts of equal shingle sets count as copies, linked to each other; NULL ``doc_id`` values are
kept, and a class is named by its least non-NULL id; repeated ids and equal rows are rows like others; an empty table
gives no rows; very long texts form blocks of their own. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import (Scratch, components, fresh, keep_alone, hash_words, mixed, read_table, run_links, shingles, signed, split_words,
                                  text_chunks)
from roadpulse.llm.jaccard import THRESHOLD, classes, joined_keys, signatures, verified_links

SIZE = 5
TREES, DEPTH, RECALL, SEED = 24, 8, 0.9999, 3


def prefix_length(threshold: float = THRESHOLD, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The longest prefix, going up from the full label, by which pairs at the threshold are found with the target recall."""
    for length in range(depth, 1, -1):
        if 1 - (1 - threshold ** length) ** trees >= recall:
            return length
    return 1


def text_sets(texts: list[str], size: int = SIZE) -> list[np.ndarray]:
    words, offsets = split_words(texts)
    h = hash_words(words)
    return [shingles(h[a:b], size) for a, b in zip(offsets, offsets[1:])]


def set_digest(s: np.ndarray) -> tuple[int, int]:
    """128 bits of a set of hashes."""
    if not len(s):
        return 0, 0
    return int(mixed(s).sum(dtype=np.uint64).view(np.int64)), int(mixed(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).view(np.int64))


def sketch(docs: DataFrame, trees: int = TREES, length: int | None = None) -> DataFrame:
    """rid, doc_id, digest of the shingle set (hi, lo), its size, and one prefix key for each tree."""
    width = length or prefix_length(trees=trees)

    def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keep_alone("forest")
        for b in batches:
            for part, texts in text_chunks(b["text"]):
                sets = text_sets(texts)
                full = [i for i, s in enumerate(sets) if len(s)]
                keys = np.zeros((len(sets), trees), np.uint64)
                if full:
                    keys[full] = joined_keys(signatures([sets[i] for i in full], trees * width, SEED), trees, width)
                digest = [set_digest(s) for s in sets]
                yield pd.DataFrame({
                    "rid": b["rid"].iloc[part].to_numpy(), "doc_id": b["doc_id"].iloc[part].to_numpy(),
                    "hi": [d[0] for d in digest], "lo": [d[1] for d in digest], "n_shingles": [len(s) for s in sets],
                    "keys": [k.tobytes() for k in keys]}).astype({"doc_id": "Int64"})

    return docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long"), "text").mapInPandas(
        make, "rid long, doc_id long, hi long, lo long, n_shingles long, keys binary")


def explode_keys(items: DataFrame) -> DataFrame:
    """(k, v): each key of each item."""
    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                keys = np.frombuffer(b"".join(b["keys"]), np.uint64)
                yield pd.DataFrame({"k": signed(keys), "v": np.repeat(b["item"].to_numpy(), len(keys) // len(b))})

    return items.select("item", "keys").mapInPandas(spread, "k long, v long")


def grouped(scratch: Scratch, rows: DataFrame, sets_of, threshold: float = THRESHOLD, also: tuple[str, ...] = ()) -> DataFrame:
    """rid, doc_id, class_id, copy_id, n_links, keep and the columns ``also`` for stored rows (rid, doc_id, hi, lo, n_shingles, keys).

    Rows of one digest are one item, so copies cost no links. Candidates come from equal keys, links from exact verification;
    ``sets_of(frame)`` adds ``shingles`` to a frame with ``item``, the rid of an item's first row.
    """
    blank = F.col("n_shingles") == 0
    items = scratch.store(
        rows.where(~blank).groupBy("hi", "lo").agg(
            F.min("rid").alias("item"), F.min("doc_id").alias("copy_id"), F.count("*").alias("weight"),
            F.max("n_shingles").alias("n_shingles")), "items")
    keyed = scratch.store(rows.select(F.col("rid").alias("item"), "keys").join(items.select("item", "weight", "n_shingles"), "item"), "keyed")
    regions = scratch.store(components(scratch, run_links(scratch, explode_keys(keyed))), "regions")
    verified = verified_links(scratch, keyed, regions, sets_of, threshold)
    joined = classes(scratch, verified)
    links = verified.groupBy("item").agg(F.sum("links").alias("links"))
    named = items.join(links, "item", "left").join(joined.withColumnRenamed("v", "item"), "item", "left").select(
        "hi", "lo", F.coalesce("root", "item").alias("root"), "copy_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    full = scratch.store(rows.where(~blank).select("rid", "doc_id", *also, "hi", "lo").join(named, ["hi", "lo"]).drop("hi", "lo"), "classes")
    # A class has the name of its least id; ids of its rows meet in an aggregate with partial sums. Rows without links are classes of their own.
    names = scratch.store(full.where("n_links > 0").groupBy("root").agg(
        F.min("doc_id").alias("class_id"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "rid")).alias("first")).select(
        "root", "class_id", F.col("first.rid").alias("kept")), "names")
    shown = ["rid", "doc_id", *also, "class_id", "copy_id", "n_links", "keep"]
    alone = full.where("n_links = 0").unionByName(rows.where(blank).select(
        "rid", "doc_id", *also, F.lit(None).cast("long").alias("root"), F.col("doc_id").alias("copy_id"), F.lit(0).cast("long").alias("n_links")))
    return full.where("n_links > 0").join(names, "root").withColumn("keep", F.col("rid") == F.col("kept")).select(*shown).unionByName(
        alone.withColumn("class_id", F.col("doc_id")).withColumn("keep", F.lit(True)).select(*shown))


def similarity_classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row for each document: rid, doc_id, class_id, copy_id, n_links, keep.

    ``class_id``: least doc_id of all that are joined by links, directly or through others; ``copy_id``: the same among texts with this
    set of shingles; ``n_links``: other documents at the threshold or above; ``keep``: whether the row is its class's first by (doc_id, row).
    """
    scratch = Scratch(docs.sparkSession, "forest")

    def sets_of(candidates: DataFrame) -> DataFrame:
        def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                for part, texts in text_chunks(b["text"]):
                    yield b.iloc[part].drop(columns="text").assign(shingles=[s.tobytes() for s in text_sets(texts)])

        texts = docs.select(F.monotonically_increasing_id().alias("item"), "text")
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in candidates.schema) + ", shingles binary"
        # Candidates grow with the documents, so they are never broadcast.
        return texts.join(candidates.hint("merge"), "item").select(*candidates.columns, "text").mapInPandas(make, schema)

    return grouped(scratch, scratch.store(sketch(docs, length=prefix_length(threshold)), "sketches"), sets_of, threshold)


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents without all but one, the first by id, of each class of near copies."""
    kept = Scratch(docs.sparkSession, "forest").store(similarity_classes(docs, threshold).where("keep").select("rid"), "kept")
    rid = fresh(docs, "rid")
    return docs.withColumn(rid, F.monotonically_increasing_id()).join(
        kept.withColumnRenamed("rid", rid).hint("merge"), rid, "left_semi").select(*docs.columns)


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity_classes(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "copy_id", "n_links")
