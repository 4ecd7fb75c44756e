import random
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest

from roadpulse.llm import common, forest, jaccard, paragraphs, suffixes
from tests.llm.cases import Sets, frame, hard_rows, jaccard as similarity, sentence, shingle_set, stored, word_list


def crowd(n: int = 60) -> list[tuple]:
    """A group of near copies, exact copies, and texts of their own."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(100)]
    rows = []
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(0, 5)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10_000)}"
        rows.append((1000 + i, " ".join(own), "en", "s", 1))
    rows += [(2000 + i, " ".join(base), "en", "s", 1) for i in range(15)]
    return rows + [(3000 + i, sentence(rng, 60), "en", "s", 1) for i in range(20)]


def brute_classes(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t, *_ in rows]
    links, classes = Counter(), Sets(len(rows))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and similarity(sets[i], sets[j]) >= threshold:
                links[i] += 1
                links[j] += 1
                classes.join(i, j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[classes.find(i)].append(r[0])
    return Counter((r[0], min(least[classes.find(i)], default=None), links[i]) for i, r in enumerate(rows)), classes


@pytest.mark.parametrize("items", [8, 256])
def test_classes_equal_brute_force(spark, tmp_path, monkeypatch, items):
    monkeypatch.setattr(jaccard, "BLOCK_ITEMS", items)  # many blocks, or one
    rows = crowd() + hard_rows()
    docs = stored(spark, frame(spark, rows, True), tmp_path)
    got = forest.similarity_classes(docs).collect()
    want, classes = brute_classes(rows)
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in got) == want
    groups = len({classes.find(i) for i in range(len(rows))})
    assert sum(r["keep"] for r in got) == groups
    kept = forest.keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == groups


def test_classes_of_given_documents(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in forest.op4_jaccard(spark, sf).collect())
    assert got == brute_classes(rows)[0]


def test_matrix_and_pair_counts_agree(monkeypatch):
    rng = np.random.default_rng(4)
    pool = np.sort(rng.integers(0, 1 << 60, 300).astype(np.uint64))
    sets = [np.sort(rng.choice(pool, rng.integers(180, 290), replace=False)) for _ in range(40)]
    size = np.array([len(s) for s in sets])
    every = np.arange(40)
    may = np.triu(np.ones((40, 40), bool), 1)
    got = jaccard._linked(sets, size, every, every, may, 0.8, every)
    want = np.array([[i < j and len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8 for j, b in enumerate(sets)]
                     for i, a in enumerate(sets)])
    assert (got == want).all() and 0 < want.sum() < may.sum()


def test_prefix_reaches_the_recall():
    p = forest.prefix_length()
    assert 1 - (1 - 0.8 ** p) ** forest.TREES >= forest.RECALL > 1 - (1 - 0.8 ** (p + 1)) ** forest.TREES
    assert 1 - (1 - 0.8 ** paragraphs.ROWS) ** paragraphs.bands() >= paragraphs.RECALL


def test_components_of_paths_and_stars(spark, tmp_path):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(200, i) for i in range(100, 150)] + [(7, 7), (300, 301), (301, 300)]
    rng.shuffle(edges)
    got = dict(tuple(r) for r in common.components(common.Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect())
    assert all(got[i] == 0 for i in range(61)) and all(got[i] == 100 for i in [*range(100, 150), 200])
    assert got[300] == got[301] == 300 and 7 in got
    assert common.components(common.Scratch(spark, "t"), spark.createDataFrame([], "a long, b long")).count() == 0


def test_a_round_of_components_stores_one_table(spark, monkeypatch):
    """A round wrote two tables and shuffled five times, which is what many small partitions take their time for."""
    rng = random.Random(5)
    edges = [(rng.randrange(120), rng.randrange(120)) for _ in range(90)] * 2
    names, store = [], common.Scratch.store
    monkeypatch.setattr(common.Scratch, "store", lambda self, df, name: names.append(name) or store(self, df, name))
    got = dict(tuple(r) for r in common.components(common.Scratch(spark, "t"), spark.createDataFrame(edges, "a long, b long")).collect())
    root = list(range(120))
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {v: root[v] for e in edges if e[0] != e[1] for v in e}
    names.clear()
    star = spark.createDataFrame([(0, i) for i in range(1, 30)], "a long, b long")
    assert common.components(common.Scratch(spark, "t"), star).count() == 30 and len(names) <= 2


def test_runs_over_task_borders(spark):
    rows = [(k, k * 1000 + i) for k in range(3) for i in range(400)] + [(9, 1)]
    scratch = common.Scratch(spark, "t")
    df = scratch.store(spark.createDataFrame(rows, "k long, v long"), "rows")
    joined = dict(tuple(r) for r in common.components(scratch, common.run_links(scratch, df)).collect())
    assert all(joined[k * 1000 + i] == k * 1000 for k in range(3) for i in range(400) if k * 1000 + i != 1)


def brute_passages(rows, n=50):
    """Words of each row that lie in a run of n words found in another row too."""
    runs = defaultdict(set)
    words = [word_list(t) for _, t, *_ in rows]
    for i, w in enumerate(words):
        for k in range(len(w) - n + 1):
            runs[tuple(w[k:k + n])].add(i)
    out = []
    for i, w in enumerate(words):
        covered = np.zeros(len(w) + 1, bool)
        for k in range(len(w) - n + 1):
            if len(runs[tuple(w[k:k + n])]) > 1:
                covered[k:k + n] = True
        out.append(covered)
    return words, out


def passage_rows():
    rng = random.Random(2)
    shared = [sentence(rng, n) for n in (50, 51, 64, 90, 49)]
    rows = []
    for i in range(40):
        own = sentence(rng, rng.randrange(0, 150)).split()
        at = rng.randrange(0, len(own) + 1)
        rows.append((i, " ".join([*own[:at], shared[i % 5], *own[at:]]).replace(" w1", "\n w1"), "en", "s", 1))
    return rows


def test_passages_equal_brute_force(spark, tmp_path):
    rows = passage_rows() + [(500 + i, *r[1:]) for i, r in enumerate(hard_rows())] + crowd(8)
    rows += [(900, "same words " * 60, None, None, 1), (901, "same words " * 70, None, None, 1)]
    docs = stored(spark, frame(spark, rows, True), tmp_path)
    found = defaultdict(list)
    for r in suffixes.repeated_passages(docs).collect():
        found[r["doc_id"]].append((r["start"], r["end"], r["n_words"]))
    words, covered = brute_passages(rows)
    for i, (doc, text, *_) in enumerate(rows):
        places = common.word_places(text or "")
        got = np.zeros(len(words[i]) + 1, bool)
        for start, end, n in found.get(doc, []):
            a, b = np.searchsorted(places[0], start), np.searchsorted(places[1], end) + 1
            assert b - a == n and places[0][a] == start
            got[a:b] = True
        assert (got == covered[i]).all(), doc


def test_minimisers_are_shared():
    rng = np.random.default_rng(3)
    h = rng.integers(0, 1 << 60, 500).astype(np.uint64)
    for n in (50, 60):
        a = np.r_[rng.integers(0, 1 << 60, 37).astype(np.uint64), h[100:100 + n], rng.integers(0, 1 << 60, 20).astype(np.uint64)]
        g, o = common.run_hashes(h, 25), common.run_hashes(a, 25)
        assert set(g[suffixes.minimisers(g, 26)].tolist()) & set(o[suffixes.minimisers(o, 26)].tolist())
    assert (common.run_hashes(h[3:], 25) == common.run_hashes(h, 25)[3:]).all()


def test_no_passages(spark, tmp_path):
    assert suffixes.repeated_passages(stored(spark, frame(spark, []), tmp_path)).count() == 0


def lines_of(rows):
    for i, (doc, text, *_) in enumerate(rows):
        at = 0
        for line in (text or "").split("\n"):
            if word_list(line):
                lead = len(line) - len(line.lstrip(" \t\x0b\x0c\r"))
                yield i, doc, at + lead, shingle_set(line)
            at += len(line) + 1


def test_paragraphs_equal_brute_force(spark, tmp_path):
    rng = random.Random(6)
    common_lines = [sentence(rng, n) for n in (3, 12, 40, 80)]
    rows = []
    for i in range(30):
        own = [sentence(rng, rng.randrange(5, 60)) for _ in range(3)]
        words = common_lines[i % 4].split()
        if i % 3 == 0 and len(words) > 30:
            words[rng.randrange(len(words))] = f"y{i}"
        rows.append((i, "\n".join([own[0], " ".join(words), *own[1:]]), "en", "s", 1))
    rows += [(500 + i, *r[1:]) for i, r in enumerate(hard_rows())]
    docs = stored(spark, frame(spark, rows, True), tmp_path)
    got = [r for r in paragraphs.paragraph_clusters(docs).collect()]
    lines = list(lines_of(rows))
    classes = Sets(len(lines))
    links = Counter()
    for x in range(len(lines)):
        for y in range(x):
            if similarity(lines[x][3], lines[y][3]) >= 0.8:
                classes.join(x, y)
                links[x] += 1
                links[y] += 1
    least = defaultdict(list)
    for x, line in enumerate(lines):
        least[classes.find(x)].append(line[1])
    want = Counter((lines[x][1], lines[x][2], min(v for v in least[classes.find(x)] if v is not None), n) for x, n in links.items())
    own = [r for r in got if r["kind"] == "paragraph"]
    assert Counter((r["doc_id"], r["start"], r["cluster_doc_id"], r["n_links"]) for r in own) == want
    assert sum(r["keep"] for r in own) == len({classes.find(x) for x in links})
    texts = {r[0]: r[1] for r in rows}
    pieces = defaultdict(set)
    for r in got:
        if r["kind"] == "piece":
            pieces[tuple(word_list(texts[r["doc_id"]][r["start"]:r["end"]]))].add(r["keep"])
    assert all(k == {True, False} for k in pieces.values())


def test_set_in_passages_share_pieces(spark, tmp_path):
    rows = [r for r in passage_rows() if r[0] % 5 != 4]
    got = paragraphs.paragraph_clusters(stored(spark, frame(spark, rows), tmp_path))
    assert {r["doc_id"] for r in got.select("doc_id").distinct().collect()} == {r[0] for r in rows}
    assert paragraphs.paragraph_clusters(stored(spark, frame(spark, []), tmp_path, "none")).count() == 0


def test_set_in_passages_are_covered_whole(spark, tmp_path):
    rng = random.Random(12)
    rows = []
    for i in range(150):
        shared = " ".join(f"s{i}_{rng.randrange(10_000)}" for _ in range(rng.choice((24, 30, 52, 60, 200))))
        for doc in (2 * i, 2 * i + 1):
            own = [" ".join(f"d{doc}_{rng.randrange(10_000)}" for _ in range(rng.randrange(1, 30))) for _ in range(2)]
            rows.append((doc, f"{own[0]} {shared} {own[1]}".replace("5 ", "5\n"), "en", "s", 1))
    rows += [(1000 + i, f"x{i} y{i} " + "same " * (30 + i) + f"z{i}", "en", "s", 1) for i in range(3)]
    docs = stored(spark, frame(spark, rows).repartition(3), tmp_path)
    covered, spans = defaultdict(set), Counter()
    for r in paragraphs.paragraph_clusters(docs).where("kind = 'passage'").collect():
        covered[r["doc_id"]].update(range(r["start"], r["end"]))
        spans[r["doc_id"]] += 1
        if r["doc_id"] < 1000:
            assert r["cluster_doc_id"] == r["doc_id"] // 2 * 2 and r["n_links"] == 1 and r["keep"] == (r["doc_id"] % 2 == 0)
    for doc, text, *_ in rows:
        if doc < 1000:
            at, end = text.index("s"), max(text.rindex(w) + len(w) for w in text.split() if w[0] == "s")
            assert covered[doc] == set(range(at, end)) and spans[doc] == 1
    texts = {r[0]: r[1] for r in rows}
    assert all("same" not in "".join(c for i, c in enumerate(texts[d]) if i not in covered[d]) for d in (1000, 1001))


def brute_passages(rows) -> Counter:
    """Every chosen run extended by comparing its words with those of each equal run, one by one."""
    size, reach = paragraphs.RUN, paragraphs.CONTEXT
    runs = defaultdict(list)
    for i, (doc, text, *_) in enumerate(rows):
        for at in paragraphs.Lines([text or ""]).runs()[1].tolist():
            runs[tuple(word_list(text)[at:at + size])].append((doc is None, doc or 0, i, at))
    spans = defaultdict(list)
    for places in runs.values():
        first = min(places)
        for place in places if len(places) > 1 else ():
            def like(side):
                sides = [word_list(rows[i][1])[at + size:] if side else word_list(rows[i][1])[:at][::-1] for *_, i, at in (place, *(p for p in places if p != place))]
                own = sides[0][:reach] + ([None] * reach)[len(sides[0][:reach]):]
                return min(len(sides[0]), max(next((n for n, w in enumerate(own) if w != (dict(enumerate(o)).get(n))), reach) for o in sides[1:]))

            *_, i, at = place
            spans[i, None if first[0] else first[1], len(places) - 1, place == first].append((at - like(0), at + size + like(1)))
    found = Counter()
    for (i, cluster, n, keep), own in spans.items():
        merged = []
        for a, b in sorted(own):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        begin, end = common.word_places(rows[i][1])
        found.update((rows[i][0], int(begin[a]), int(end[b - 1]), cluster, n, keep) for a, b in merged)
    return found


def test_passages_equal_brute_force(spark, tmp_path):
    rng = random.Random(21)
    pool = [f"p{i}" for i in range(400)]
    rows = []
    for i in range(60):
        words = [f"d{i}_{j}" for j in range(rng.randrange(0, 20))]
        for _ in range(rng.randrange(1, 5)):  # stretches of common words of any length, at any place, next to each other or not
            at = rng.randrange(380)
            words += pool[at:at + rng.randrange(5, 120)] + [f"e{i}_{rng.randrange(10**6)}" for _ in range(rng.randrange(0, 6))]
        rows.append((None if i == 20 else i, " ".join(words), "en", "s", 1))
    rows += [(100 + i, sentence(rng, 300, 3), "en", "s", 1) for i in range(3)]
    docs = stored(spark, frame(spark, rows, True).repartition(3), tmp_path)
    want = brute_passages(rows)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for batch in ("7", before):  # equal runs over many batches, or in one
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
            got = paragraphs.paragraph_clusters(docs).where("kind = 'passage'").collect()
            assert Counter((r["doc_id"], r["start"], r["end"], r["cluster_doc_id"], r["n_links"], r["keep"]) for r in got) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_words_are_compared_at_the_ends_of_passages_only(spark, tmp_path, monkeypatch):
    rng = random.Random(2)
    text = sentence(rng, 3000, 10**6)
    rows = [(i, f"own{i} {text} other{i}", "en", "s", 1) for i in range(3)]
    docs, counts, store = stored(spark, frame(spark, rows), tmp_path), {}, common.Scratch.store

    def counted(self, df, name):
        out = store(self, df, name)
        counts[name] = out.count()
        return out

    monkeypatch.setattr(common.Scratch, "store", counted)
    got = paragraphs.paragraph_clusters(docs).where("kind = 'passage'").collect()
    assert [(r["start"], r["end"]) for r in got] == [(5, 5 + len(text))] * 3
    assert counts["matched"] > 600 and counts["runs"] < counts["matched"] / 4


def test_stored_tables_leave_no_shuffle_files(spark):
    import gc
    import time

    def shuffles() -> set[str]:
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllBlocks()
        return {name for i in range(blocks.size()) if (name := blocks.apply(i).toString()).startswith("shuffle_")}

    gc.disable()  # what is still in use must not be what keeps files
    try:
        before, mine = shuffles(), spark.range(100_000).selectExpr("hash(id) AS x")
        scratch, setting = common.Scratch(spark, "files"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
        assert scratch.store(mine.repartition(3, "x"), "rows").count() == 100_000
        for _ in range(50):
            if left := {n for n in shuffles() - before if n.endswith("_0")}:
                time.sleep(0.1)
        assert len({n.split("_")[1] for n in left}) <= 1  # of the count, at most
        assert spark.conf.get(setting) == "false"
    finally:
        gc.enable()


@pytest.mark.parametrize("cuts", [(), (3, 3, 4), (1, 2, 5, 6)])
def test_reach_over_batches(cuts, monkeypatch):
    import pandas as pd

    monkeypatch.setattr(paragraphs, "TaskContext", type("Task", (), {"get": staticmethod(lambda: type("T", (), {"partitionId": lambda self: 4})())}))
    rows = sorted([(1, (5, 5, 5)), (2, (1, 2, 3)), (2, (1, 2, 4)), (2, (1, 3, 3)), (2, (9, 9, 9)), (3, (1, 2, 3)), (3, (1, 2, 3))])
    df = pd.DataFrame({"run": range(7), "k": [k for k, _ in rows], "words": [np.array(w, np.uint32).tobytes() for _, w in rows]})
    got = pd.concat(list(paragraphs._reach(df.iloc[a:b].reset_index(drop=True) for a, b in zip((0, *cuts), (*cuts, 7)))))
    assert got[got["task"].notna()][["run", "task"]].values.tolist() == [[0, 8], [6, 9]]
    assert got[got["task"].isna()].groupby("run")["reach"].max().tolist() == [-1, 2, 2, 1, 0, 3, 3]


def test_windows_of_two_documents_are_told_over_batches_and_tasks():
    import pandas as pd

    rng = np.random.default_rng(0)
    for _ in range(150):
        n = rng.integers(1, 40)
        df = pd.DataFrame({"k": rng.integers(0, rng.integers(1, 12), n), "rid": rng.integers(0, 4, n)}).sort_values(["k", "rid"], ignore_index=True)
        df["word"] = df["start"] = df["end"] = np.arange(n)
        tasks, told = [0, *np.sort(rng.integers(0, n + 1, 3)), n], []
        for a, b in zip(tasks, tasks[1:]):
            batches = [a, *np.sort(rng.integers(a, b + 1, 3)), b]
            told += list(suffixes._shared(df.iloc[x:y].reset_index(drop=True) for x, y in zip(batches, batches[1:])))
        told = pd.concat(told)
        cut = told[told["k"].notna()].groupby("k").agg(first=("first_rid", "min"), low=("rid", "min"), high=("rid", "max"))
        late = told[told["open"] & told["word"].notna()]
        late = late[late["k"].isin(cut.index[cut["low"] != cut["high"]])]
        kept = pd.concat([told[~told["open"]], late])
        first = [f if pd.isna(k) else min(cut["first"][k], cut["low"][k]) for f, k in zip(kept["first_rid"], kept["k"])]
        ends = df.groupby("k")["rid"].agg(["min", "max"])
        want = sorted((w, ends["min"][k]) for w, k in zip(df["word"], df["k"]) if ends["min"][k] != ends["max"][k])
        assert sorted(zip(kept["word"], first)) == want


def test_clusters_of_rows_in_any_order_within_a_key():
    rng = np.random.default_rng(2)
    rows = pd.DataFrame({"k": np.sort(rng.integers(0, 60, 200)), "none": rng.random(200) < 0.2, "id": rng.integers(0, 9, 200),
                         "row": rng.integers(0, 50, 200), "place": rng.permutation(200).astype(np.int32)})
    order = ["k", "none", "id", "row", "place"]
    rows["id"] = rows["id"].where(~rows["none"], 0)
    (got,), (want,) = paragraphs._clusters(iter([rows])), paragraphs._clusters(iter([rows.sort_values(order)]))
    inner = got[got["n_links"] > 0]
    assert got.sort_values(order).reset_index(drop=True).equals(want.sort_values(order).reset_index(drop=True)) and len(inner) > 100
    for _, own in inner.groupby("k"):
        first = min(own[order].itertuples(index=False, name=None))
        assert own[order][own["keep"]].to_numpy().tolist() == [list(first)] and (own["first_id"] == first[2]).all()
        assert (own["n_links"] == len(own) - 1).all() and len(set(own["shape"])) == 1


def test_narrow_rows_come_many_at_once(spark, tmp_path):
    def sizes(batches):
        for b in batches:
            yield pd.DataFrame({"n": [len(b)]})

    scratch, name = common.Scratch(spark, "narrow"), "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    rows = spark.range(0, 35_000, 1, 1).mapInPandas(sizes, "n long")
    assert sorted(r[0] for r in scratch.store_narrow(rows, "sizes").collect()) == [5_000, 30_000]
    assert spark.conf.get(name) == before and max(r[0] for r in scratch.store(rows, "plain").collect()) == int(before)
