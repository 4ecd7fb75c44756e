"""Repeated passages by hashed anchors at minimisers (operator 5).

Only places at minimisers are kept: those whose run of ``ANCHOR`` words has the least hash among the runs that begin
within a window. Two texts that share ``PASSAGE`` words share such a place in them. The places are range-sorted by the hash of that run,
which stands in for the order of suffixes; around each whose neighbour has an equal hash, the match is extended left and right, by sliding a
window of ``PASSAGE`` words over it for as long as the window is found in another document too.

Rows: NULL texts and those of fewer than ``PASSAGE`` words have no passages; NULL ``doc_id`` stays NULL, and rows with one id
are still separate documents, as are equal rows; an empty table gives no rows; a long text has about two suffixes for each
``WINDOW`` words, and stretches of one repeated run have one. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Scratch, hash_words, read_table, run_hashes, signed, sliding, split_words, text_chunks, word_places

PASSAGE, ANCHOR = 50, 25


def minimisers(g: np.ndarray, window: int) -> np.ndarray:
    """Places that are least in some run of ``window`` places; of equal hashes in sequence, the first."""
    if len(g) < window:
        return np.zeros(0, np.int64)
    low = sliding(g, window, True)
    reach = sliding(np.r_[np.zeros(window - 1, np.uint64), low, np.zeros(window - 1, np.uint64)], window, False)
    chosen = reach == g
    chosen[1:] &= g[1:] != g[:-1]
    return np.flatnonzero(chosen)


def suffixes(docs: DataFrame, passage: int = PASSAGE, anchor: int = ANCHOR) -> DataFrame:
    """(k, rid, place): retained suffixes, k the hash of their first ``anchor`` words."""
    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in text_chunks(b["text"]):
                words, offsets = split_words(texts)
                h = hash_words(words)
                keys, rids, places = [], [], []
                for rid, lo, hi in zip(b["rid"].iloc[part], offsets, offsets[1:]):
                    if hi - lo < passage:
                        continue
                    g = run_hashes(h[lo:hi], anchor)
                    at = minimisers(g, passage - anchor + 1)
                    keys.append(g[at])
                    places.append(at)
                    rids.append(np.full(len(at), rid))
                if keys:
                    yield pd.DataFrame({"k": signed(np.concatenate(keys)), "rid": np.concatenate(rids), "place": np.concatenate(places)})

    return docs.select(F.monotonically_increasing_id().alias("rid"), "text").mapInPandas(keep, "k long, rid long, place int")


def _with_equal_neighbour(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by k, those with an equal neighbour; the outer two of the task too, whose neighbours are not seen here."""
    held, kept = None, True  # the last row so far, and whether it is known to stay
    for b in batches:
        if b.empty:
            continue
        rows = b if held is None else pd.concat([held, b], ignore_index=True)
        k = rows["k"].to_numpy()
        same = np.r_[False, k[1:] == k[:-1]]
        keep = same | np.r_[same[1:], False]
        keep[0] |= kept
        held, kept = rows.iloc[-1:], bool(keep[-1])
        yield rows[["rid", "place"]][np.r_[keep[:-1], False]]
    if held is not None:
        yield held[["rid", "place"]]


def _windows(passage: int, anchor: int):
    def extend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in text_chunks(b["text"]):
                words, offsets = split_words(texts)
                h = hash_words(words)
                out = []
                for rid, places, text, lo, hi in zip(b["rid"].iloc[part], b["places"].iloc[part], texts, offsets, offsets[1:]):
                    g = run_hashes(h[lo:hi], anchor)
                    matched = np.zeros(len(g), bool)
                    matched[np.asarray(places)] = True
                    # A matched run that repeats itself at the next places is matched there too.
                    heads = np.r_[True, g[1:] != g[:-1]]
                    matched = matched[np.flatnonzero(heads)[np.cumsum(heads) - 1]]
                    n = hi - lo - passage + 1
                    edge = np.zeros(n + 1, np.int64)
                    at = np.flatnonzero(matched)
                    np.add.at(edge, np.clip(at - (passage - anchor), 0, n), 1)
                    np.add.at(edge, np.clip(at + 1, 0, n), -1)
                    starts = np.flatnonzero(np.cumsum(edge)[:n] > 0)
                    begin, end = word_places(text)
                    out.append(pd.DataFrame({
                        "k": signed(run_hashes(h[lo:hi], passage)[starts]), "rid": rid, "word": starts,
                        "start": begin[starts], "end": end[starts + passage - 1]}))
                if out:
                    yield pd.concat(out, ignore_index=True)

    return extend


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of windows sorted by (k, rid, word), those that two documents have, with the first of these.

    A run of one k may be cut by a task border. Its rows carry their k then, as the first document may be in an earlier task,
    and are ``open`` if only one document of the run is in this task; a last run that is settled leaves
    a row without a place for later tasks. Only rows of one document are ever held.
    """
    def out(rows: pd.DataFrame, first, k, is_open: bool = False) -> pd.DataFrame:
        return rows[["rid", "word", "start", "end"]].assign(first_rid=first, k=k, open=is_open).astype(
            {"word": "Int64", "start": "Int64", "end": "Int64", "k": "Int64"})

    key = first = None
    shared = outer = False
    held: list[pd.DataFrame] = []
    for b in batches:
        if b.empty:
            continue
        b = b.reset_index(drop=True)
        k, rid = b["k"].to_numpy(), b["rid"].to_numpy()
        starts = np.flatnonzero(np.r_[True, k[1:] != k[:-1]])
        ends = np.r_[starts[1:], len(k)]
        goes_on = key is not None and k[0] == key
        if not goes_on and outer and held:  # the task's first run ended with its batch
            yield out(pd.concat(held, ignore_index=True), first, key, True)
        outer = key is None or (goes_on and outer)
        firsts, lasts = rid[starts].copy(), rid[ends - 1]
        if goes_on:
            firsts[0] = first
        else:
            held = []
        both = firsts != lasts
        both[0] |= goes_on and shared
        if both[0] and held:
            yield out(pd.concat(held, ignore_index=True), first, k[0] if outer else None)
            held = []
        run = np.repeat(np.arange(len(starts)), ends - starts)
        tell = both[run]
        if tell.any():
            names = pd.array(k[tell], "Int64")
            names[run[tell] > (0 if outer else -1)] = None
            yield out(b[tell], firsts[run][tell], names)
        if len(starts) > 1:
            if outer and not both[0]:
                yield out(pd.concat([*held, b.iloc[:ends[0]]], ignore_index=True), firsts[0], k[0], True)
            held, outer = [], False
        if not both[-1]:
            held.append(b.iloc[starts[-1]:])
        key, first, shared = int(k[-1]), int(firsts[-1]), bool(both[-1])
    if held:
        yield out(pd.concat(held, ignore_index=True), first, key, True)
    elif key is not None and not outer:
        yield out(pd.DataFrame({"rid": [first], "word": [None], "start": [None], "end": [None]}), first, key, True)


def _spans(passage: int):
    def merge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Windows sorted by (rid, word) joined where they overlap or touch."""
        def close(rows: pd.DataFrame, cuts: np.ndarray) -> pd.DataFrame:
            last = np.r_[cuts[1:], len(rows)] - 1
            take = {c: rows[c].to_numpy() for c in ("rid", "word", "start", "end", "first_rid")}
            return pd.DataFrame({
                "rid": take["rid"][cuts], "start": take["start"][cuts], "end": take["end"][last],
                "n_words": take["word"][last] - take["word"][cuts] + passage, "first_rid": take["first_rid"][cuts],
                "k": rows["k"].astype("Int64").array[cuts]})

        held = None
        for b in batches:
            if b.empty:
                continue
            rows = b if held is None else pd.concat([held, b], ignore_index=True)
            rid, word = rows["rid"].to_numpy(), rows["word"].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (rid[1:] != rid[:-1]) | (word[1:] > word[:-1] + passage)])
            if len(cuts) > 1:
                yield close(rows.iloc[:cuts[-1]], cuts[:-1])
            held = rows.iloc[cuts[-1]:].reset_index(drop=True)
        if held is not None:
            yield close(held, np.zeros(1, np.int64))

    return merge


def repeated_passages(docs: DataFrame, passage: int = PASSAGE, anchor: int = ANCHOR) -> DataFrame:
    """Maximal spans all of whose windows of ``passage`` words stand in another document too.

    rid, doc_id, start, end (code points), n_words, first_doc_id (id of the first row with the span's first window),
    is_first (whether no earlier row has that window).
    """
    scratch = Scratch(docs.sparkSession, "suffixes")
    sparse = scratch.store(suffixes(docs, passage, anchor), "suffixes")
    matched = sparse.repartitionByRange("k", "rid", "place").sortWithinPartitions("k", "rid", "place").mapInPandas(
        _with_equal_neighbour, "rid long, place int")
    of_doc = matched.groupBy("rid").agg(F.collect_set("place").alias("places"))
    texts = docs.select(F.monotonically_increasing_id().alias("rid"), "text")
    windows = scratch.store(texts.join(of_doc, "rid").mapInPandas(
        _windows(passage, anchor), "k long, rid long, word int, start int, end int"), "windows")
    scratch.drop(sparse)
    order = ["k", "rid", "word"]
    told = scratch.store(windows.repartitionByRange(*order).sortWithinPartitions(*order).mapInPandas(
        _shared, "rid long, word int, start int, end int, first_rid long, k long, open boolean"), "shared")
    scratch.drop(windows)
    # As many k as task borders.
    cut = told.where("k IS NOT NULL").groupBy("k").agg(
        F.least(F.min("first_rid"), F.min("rid")).alias("first"), F.min("rid").alias("low"), F.max("rid").alias("high"))
    cut = scratch.store(cut, "cut")
    late = told.where("open AND word IS NOT NULL").join(cut.where("low <> high").select("k"), "k", "left_semi")
    kept = told.where("NOT open").unionByName(late.select(*told.columns)).drop("open")
    spans = kept.repartition("rid").sortWithinPartitions("rid", "word").mapInPandas(
        _spans(passage), "rid long, start long, end long, n_words long, first_rid long, k long")
    spans = spans.join(cut.select("k", "first"), "k", "left").withColumn("first_rid", F.coalesce("first", "first_rid"))
    ids = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"))
    return spans.join(ids, "rid").join(ids.select(F.col("rid").alias("first_rid"), F.col("doc_id").alias("first_doc_id")), "first_rid").select(
        "rid", "doc_id", "start", "end", "n_words", "first_doc_id", (F.col("rid") == F.col("first_rid")).alias("is_first"))


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(read_table(spark, sf_dir, "documents")).drop("rid")
