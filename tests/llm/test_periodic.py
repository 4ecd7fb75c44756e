import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.llm import periodic
from tests.llm.cases import frame, hard_rows, stored


def plain_runs(words):
    """(start, length, period) of all runs, by comparing every word with the one each period on."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            length = i + q - start
            if length >= max(12, 2 * q):
                out.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in out.items())


def plain_row(doc_id, text):
    words = (text or "").encode().split()
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    best = sorted(runs, key=lambda r: (-r[1], r[0], r[2]))[:1]
    start, length, period = best[0] if best else (None, None, None)
    return (doc_id, len(runs), start, length, period, 1000 * length // period if best else None,
            hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def solved(documents):
    """Runs of each document through tiles, without Spark's shuffles."""
    offsets = np.cumsum([0, *map(len, documents)])
    ids = np.array([i for d in documents for i in d], np.int64)
    found = [(d, p, t + s, t + e) for d, lo, t, own, marks in periodic.tiles_of(ids, offsets) for p, s, e in
             periodic.solve_tile(np.frombuffer(own, "<u4").astype(np.int64), np.frombuffer(marks, "<u4").reshape(-1, 2), lo)]
    out = [{} for _ in documents]
    for d, p, s, e in zip(*periodic.stitch(*np.array(found, np.int64).reshape(-1, 4).T)):
        out[d][s, e - s] = min(p, out[d].get((s, e - s), p))
    return [sorted((s, n, q) for (s, n), q in o.items()) for o in out]


words_lists = st.one_of(
    st.lists(st.integers(0, 1), max_size=90),
    st.lists(st.integers(0, 3), max_size=60),
    st.builds(lambda unit, times, head, tail: head + unit * times + tail, st.lists(st.integers(0, 5), min_size=1, max_size=40),
              st.integers(1, 12), st.lists(st.integers(0, 5), max_size=30), st.lists(st.integers(0, 5), max_size=30)),
    st.builds(lambda unit, n, cut: (unit * n)[:cut], st.lists(st.integers(0, 9), min_size=1, max_size=70), st.integers(2, 20), st.integers(1, 500)))


@settings(max_examples=400, deadline=None)
@given(st.lists(words_lists, min_size=1, max_size=4))
def test_tiles_give_all_runs(documents):
    assert solved(documents) == [plain_runs(d) for d in documents]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=1, max_size=80))
def test_z_function(words):
    s = np.array(words)
    want = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(1, len(s))]
    assert periodic.z_function(s, len(s))[1:].tolist() == want


def test_long_runs_of_every_octave():
    rng = random.Random(4)
    documents = []
    for q in (1, 2, 3, 5, 8, 13, 31, 32, 33, 100, 257, 700):
        unit = [rng.randrange(10_000) for _ in range(q)]
        head = [rng.randrange(10_000) for _ in range(rng.randrange(300))]
        documents.append(head + (unit * 4)[:2 * q + rng.randrange(q + 1)] + head[:50] + unit * 3)
    documents.append([7] * 3_000)
    documents.append([1, 2] * 900 + [1] + [2, 1, 3] * 500)
    assert solved(documents) == [plain_runs(d) for d in documents]


def test_stitching_needs_a_period_in_common():
    def joined(*rows):
        return [tuple(r) for r in zip(*(x.tolist() for x in periodic.stitch(*np.array(rows, np.int64).T)))]

    assert joined((1, 5, 0, 20), (1, 5, 15, 40), (1, 5, 36, 60)) == [(1, 5, 0, 40), (1, 5, 36, 60)]
    assert joined((2, 5, 10, 30), (1, 5, 0, 20), (1, 6, 0, 20)) == [(1, 5, 0, 20), (1, 6, 0, 20), (2, 5, 10, 30)]


@pytest.mark.parametrize("extra", [False, True])
def test_rows(spark, tmp_path, extra):
    rng = random.Random(9)
    tail = [next(i for i in range(k, k + 500) if zlib.crc32(str(i).encode()) % 10 == 0) for k in (100, 700, 2**60)]
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(700))
    rows = [r for r in hard_rows() if len(r[1] or "") < 100_000]
    rows += [(i, text, None, None, None) for i in (*tail, tail[0])] + [(None, "x y z " * 40, None, None, None), (3, "a " * 4000, None, None, None)]
    got = periodic.periodic_runs(stored(spark, frame(spark, rows, extra), tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted((plain_row(r[0], r[1]) for r in rows), key=str)


def test_empty_table(spark, tmp_path):
    assert periodic.periodic_runs(stored(spark, frame(spark, []), tmp_path)).count() == 0


def test_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, periodic.op13_periodic(spark, sf).collect()), key=str)
    short = {r["doc_id"] for r in rows if len((r["text"] or "").split()) <= 3_000}
    assert len(got) == len(rows) and len(short) > 150
    assert [g for g in got if g[0] in short] == sorted((plain_row(r["doc_id"], r["text"]) for r in rows if r["doc_id"] in short), key=str)
