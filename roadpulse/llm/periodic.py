"""Periodic runs of words, by tiles of each period octave (operator 13).

A run is a stretch of words with smallest period q, of ``SHORTEST`` words and two periods or more, that cannot be extended. Periods are
worked by octaves [lo, 2 lo). For an octave a document is exploded into overlapping tiles of eight times its least
period, so any two periods of a run lie whole in some tile. Every ``step`` words there is a boundary; a run holds one, c, with c + q still in
it. From the boundary two Z-functions tell how far the words behind c equal those behind c + p, and those before c
those before c + p, for all p of the octave: together they give the stretch of period p about c.

A boundary can only tell of a run where ``gram`` words at it equal those one period on, on one of its sides. These marks, of a boundary and a
period, are found by hashes when documents are read, and only tiles with a mark are exploded, as rows of their own (word numbers and
marks). Equal words have equal hashes, so none is missed. Boundaries whose marks lie in stretches found from others are passed over.
Tiles are dealt out by document, octave and place,
solved by themselves, and their fragments are stitched: first those of neighbouring tiles in a task, then, after a shuffle by
document and period, all that share a period or more. Multiples of a period give the same stretch, which keeps its least period.

What is shuffled are the marked tiles, fragments, and the texts that have marked tiles. One document's words and runs must fit a task.

Rows: NULL, empty and white texts have no words and no runs; a NULL ``doc_id`` leaves the words as they are; repeated ids and equal rows are
documents of their own; an empty table gives no rows; texts of any length are worked whole; other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.llm.common import MIX_A, MIX_B, Scratch, documents_of, mixed, nullable, read_table, split_words, text_chunks

SHORTEST = 12
TILE_ROWS = 2_000
TASK_TILES = 20_000
_READ = "rid long, doc_id long, no_id boolean, n long, text binary, digest string, octave int, tile long, ids binary, marks binary"
_DONE = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"


def octave(lo: int) -> tuple[int, int, int, int]:
    """For periods from ``lo``: the end of the octave, the distance of boundaries, words in a gram, and words in a tile.

    A run of period q reaches max(q, SHORTEST - q) words beyond its first period: at least ``step``, and half of it at least ``gram``.
    """
    if lo == 1:
        return 4, 8, 5, 32
    return 2 * lo, lo, max(3, lo // 2), 8 * lo


def octaves(n: int) -> Iterator[int]:
    """First periods of the octaves that ``n`` words have room for."""
    if n >= SHORTEST:
        yield 1
    lo = 4
    while 2 * lo <= n and n >= SHORTEST:
        yield lo
        lo *= 2


def repeat_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Fixed rule of the query's input: of every tenth document, by its id, the words from one on repeat a stretch."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    return np.where(at < a, at, a + (at - a) % p)


def _double(grams: np.ndarray, by: int) -> np.ndarray:
    out = grams * MIX_A
    if by < len(grams):
        ahead = grams[by:]
        out[:-by] += (ahead ^ (ahead >> np.uint64(29))) * MIX_B
    return out


def marked_boundaries(ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For each octave: document, place and period of the boundaries from which a run may be told.

    ``ids`` are the word numbers of all documents, one after another, from ``offsets``.
    """
    lengths = np.diff(offsets)
    one = mixed(ids.astype(np.uint64) + np.uint64(1))
    two = _double(one, 1)
    three, four = _double(two, 1), _double(two, 2)  # of three words with the middle one twice, which is as good
    grams = {3: three, 4: four, 5: _double(four, 1)}
    doc = np.repeat(np.arange(len(lengths)), lengths)
    base = offsets[:-1][doc]
    at = np.arange(len(ids)) - base
    for lo in octaves(int(lengths.max(initial=0))):
        hi, step, gram, _ = octave(lo)
        room = lengths[doc] >= max(SHORTEST, 2 * lo)
        doc, base, at = doc[room], base[room], at[room]
        if gram > 4 and gram not in grams:
            grams[gram] = _double(grams.pop(gram // 2), gram // 2)
        g = grams[gram]
        if lo == 1:
            cut = at % step == 0
            found = [(doc[cut], base[cut], at[cut], at[cut] + p) for p in range(1, hi)]
        else:
            found = [(doc, base, (at // step - 1) * step, at)]
        docs, places, periods = [], [], []
        for d, b, c, i in found:
            inside = (c >= 0) & (i < lengths[d])
            left, right = np.where(inside, b + c, 0), np.where(inside, b + i, 0)
            hit = g[left] == g[right]
            back = inside & (c >= gram)
            hit |= back & (g[np.where(back, left - gram, 0)] == g[np.where(back, right - gram, 0)])
            hit &= inside
            docs.append(d[hit])
            places.append(c[hit])
            periods.append((i - c)[hit])
        if any(map(len, docs)):
            yield lo, np.concatenate(docs), np.concatenate(places), np.concatenate(periods)


def tiles_of(ids: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """Document, octave, place, word numbers and marks (boundary in the tile, period) of each tile with a mark."""
    raw = ids.astype("<u4")
    for lo, doc, place, period in marked_boundaries(ids, offsets):
        size = octave(lo)[3]
        hop = size // 2
        tile = place // hop
        doc, tile, place, period = np.r_[doc, doc], np.r_[tile, tile - 1], np.r_[place, place], np.r_[period, period]
        order = np.flatnonzero((tile >= 0) & (place + period < tile * hop + size))
        order = order[np.lexsort((place[order], tile[order], doc[order]))]
        doc, tile = doc[order], tile[order]
        marks = np.stack([place[order] - tile * hop, period[order]], axis=1).astype("<u4")
        starts = np.flatnonzero(np.r_[True, (doc[1:] != doc[:-1]) | (tile[1:] != tile[:-1])][:len(doc)]).tolist()
        for i, j in zip(starts, [*starts[1:], len(doc)]):
            d, t = int(doc[i]), int(tile[i]) * hop
            first = int(offsets[d]) + t
            yield d, lo, t, raw[first:min(first + size, int(offsets[d + 1]))].tobytes(), marks[i:j].tobytes()


def _common(s: np.ndarray, i: int, k: int) -> int:
    """Length of the common prefix of s and s[i:], known to be k at least."""
    n, width = len(s), 16
    while i + k < n:
        differ = s[i + k:i + k + width] != s[k:k + width][:n - i - k]
        at = int(differ.argmax())
        if differ[at]:
            return k + at
        k += len(differ)
        width *= 4
    return k


def z_function(s: np.ndarray, stop: int) -> np.ndarray:
    """Lengths of the common prefixes of s and s[i:], for 0 < i < stop."""
    z = np.zeros(stop, np.int64)
    if not stop:
        return z
    left = right = 0
    for i in (np.flatnonzero(s[1:stop] == s[0]) + 1).tolist():
        k = 0
        if i < right:
            k = int(z[i - left])
            if k < right - i:
                z[i] = k
                continue
            k = right - i
        z[i] = k = _common(s, i, k)
        if i + k > right:
            left, right = i, i + k
    return z


def stretches(words: np.ndarray, c: int, lo: int) -> list[tuple[int, int, int]]:
    """(period, start, end) of the stretches about boundary c whose period is in the octave from ``lo``."""
    hi = octave(lo)[0]
    most = min(hi - 1, len(words) - c)  # c + p lies in the run or just behind it
    if most < lo:
        return []
    period = np.arange(lo, most + 1)
    ahead = np.zeros(hi, np.int64)
    z = z_function(words[c:], min(most + 1, len(words) - c))
    ahead[:len(z)] = z
    before, until = words[:c][::-1], words[:c + most][::-1]
    at = c + 1 + len(until) - (c + period)  # the words before c + p, read backwards, in the joined string
    z = z_function(np.concatenate([before, [-1], until]), int(at.max()) + 1)
    behind, ahead = (z[at] if c else np.zeros(len(at), np.int64)), ahead[period]
    long = behind + ahead + period >= np.maximum(SHORTEST, 2 * period)
    return list(zip(period[long].tolist(), (c - behind[long]).tolist(), (c + period + ahead)[long].tolist()))


def solve_tile(words: np.ndarray, marks: np.ndarray, lo: int) -> Iterator[tuple[int, int, int]]:
    """(period, start, end) of the stretches in a tile, from its (boundary, period) marks by boundary."""
    found: dict[int, list[tuple[int, int]]] = {}
    done = -1
    for c, p in marks.tolist():
        if c == done or any(s <= c and c + p <= e for s, e in found.get(p, ())):
            continue
        done = c
        for q, s, e in stretches(words, c, lo):
            own = found.setdefault(q, [])
            if (s, e) not in own:
                own.append((s, e))
                yield q, s, e


def stitch(rid: np.ndarray, period: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Joins fragments of one document and period that share a period of words or more."""
    order = np.lexsort((end, start, period, rid))
    rid, period, start, end = rid[order], period[order], start[order], end[order]
    out: list[list[int]] = []
    for r, p, s, e in zip(rid.tolist(), period.tolist(), start.tolist(), end.tolist()):
        if out and out[-1][0] == r and out[-1][1] == p and s + p <= out[-1][3]:
            out[-1][3] = max(out[-1][3], e)
        else:
            out.append([r, p, s, e])
    return tuple(np.array(out, np.int64).reshape(-1, 4).T)


def _solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        found: list[tuple[int, int, int, int]] = []
        for rid, lo, tile, ids, marks in zip(b["rid"], b["octave"], b["tile"], b["ids"], b["marks"]):
            words = np.frombuffer(ids, "<u4").astype(np.int64)
            found += [(rid, p, tile + s, tile + e) for p, s, e in solve_tile(words, np.frombuffer(marks, "<u4").reshape(-1, 2), lo)]
        yield pd.DataFrame(dict(zip(("rid", "period", "start", "end"), stitch(*np.array(found, np.int64).reshape(-1, 4).T))))


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for part, texts in text_chunks(b["text"]):
            rid, doc_id, no_id = (b[c].iloc[part].to_numpy() for c in ("rid", "doc_id", "no_id"))
            words, offsets = split_words(texts)
            for d, (i, none) in enumerate(zip(doc_id.tolist(), no_id)):
                first, last = int(offsets[d]), int(offsets[d + 1])
                moved = repeat_tail(None if none else i, last - first)
                if moved is not None:
                    own = words[first:last]
                    words[first:last] = [own[k] for k in moved.tolist()]
            number: dict[bytes, int] = {}
            ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
            marked = np.zeros(len(texts), bool)
            rows: list[tuple] = []
            for d, lo, at, own, marks in tiles_of(ids, offsets):
                marked[d] = True
                rows.append((rid[d], lo, at, own, marks))
                if len(rows) >= TILE_ROWS or len(own) > 1 << 20:
                    yield _frame(tiles=rows)
                    rows = []
            joined = [b" ".join(words[i:j]) for i, j in zip(offsets.tolist(), offsets[1:].tolist())]
            yield _frame(tiles=rows)
            yield _frame(docs={
                "rid": rid, "doc_id": doc_id, "no_id": no_id, "n": np.diff(offsets),
                "text": [t if m else None for t, m in zip(joined, marked)],
                "digest": [None if m else hashlib.sha256(t).hexdigest() for t, m in zip(joined, marked)]})


_TILE, _DOC = ("rid", "octave", "tile", "ids", "marks"), ("rid", "doc_id", "no_id", "n", "text", "digest")


def _frame(tiles: tuple | list = (), docs: dict | None = None) -> pd.DataFrame:
    """Rows of tiles, or of documents, with the other kind's columns empty."""
    own = pd.DataFrame(docs, columns=_DOC) if docs else pd.DataFrame(tiles, columns=_TILE)
    for c in {*_TILE, *_DOC}.difference(own.columns):
        own[c] = pd.Series([None] * len(own), dtype=object)
    return own


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that no run (start, length, period) holds behind its first period, with a space between."""
    change = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()])


def _finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        rows = []
        for text, digest, runs in zip(b["text"], b["digest"], b["runs"]):
            own = sorted((r["start"], r["length"], r["period"]) for r in runs) if runs is not None else []
            listed = "".join(f"{s},{n},{q}\n" for s, n, q in own).encode()
            start, length, period = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None, None, None)
            if digest is None:
                digest = hashlib.sha256(collapse(text.split(), own) if own else text).hexdigest()
            rows.append((len(own), start, length, period, 1000 * length // period if own else None,
                         hashlib.sha256(listed).hexdigest(), digest))
        out = pd.DataFrame(rows, columns=["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])
        out = out.astype({c: "Int64" for c in ("start", "length", "period", "exponent_milli")})
        out.insert(0, "doc_id", nullable(b["doc_id"], b["no_id"]))
        yield out


def runs_of(tiles: DataFrame) -> DataFrame:
    """rid, start, length and smallest period of each run, from exploded tiles (rid, octave, tile, ids, marks)."""
    # Tiles are few in bytes but costly to solve, so tasks are made by their number.
    tasks = max(tiles.sparkSession.sparkContext.defaultParallelism, -(-tiles.count() // TASK_TILES))
    fragments = tiles.repartitionByRange(tasks, "rid", "octave", "tile").sortWithinPartitions("rid", "octave", "tile").mapInPandas(
        _solve, "rid long, period long, start long, end long")
    order = Window.partitionBy("rid", "period").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    island = F.sum(F.when(reach.isNull() | (F.col("start") + F.col("period") > reach), 1).otherwise(0)).over(order)
    whole = fragments.withColumn("island", island).groupBy("rid", "period", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("rid", "start", "end").agg(F.min("period").alias("period")).select(
        "rid", "start", (F.col("end") - F.col("start")).alias("length"), "period")


def periodic_runs(docs: DataFrame) -> DataFrame:
    """The runs of each document: how many, the longest, and digests of all of them and of the text without repetitions."""
    scratch = Scratch(docs.sparkSession, "periodic")
    read = scratch.store(documents_of(docs).mapInPandas(_read, _READ), "read")
    own = read.where("octave IS NULL").select("rid", "doc_id", "no_id", "text", "digest")
    runs = runs_of(read.where("octave IS NOT NULL").select("rid", "octave", "tile", "ids", "marks"))
    listed = runs.groupBy("rid").agg(F.collect_list(F.struct("start", "length", "period")).alias("runs"))
    marked = own.where("text IS NOT NULL").join(listed, "rid", "left").drop("rid")
    plain = own.where("text IS NULL").drop("rid").withColumn("runs", F.lit(None).cast(marked.schema["runs"].dataType))
    return marked.unionByName(plain).mapInPandas(_finish, _DONE)


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(read_table(spark, sf_dir, "documents"))
