import itertools
import math
import random
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from roadpulse.llm import language, lm, quality
from tests.llm.cases import frame, hard_rows, stored

SF = "/root/testdata/sf0.01"


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    lengths = np.array([4, 0, 6, 1, 5])
    scores = rng.normal(0, 3, (7, 3)).astype(np.float32)
    code = rng.integers(0, 7, lengths.sum())
    got = language.viterbi(scores, code, lengths, 2.0)
    at = 0
    for n in lengths:
        own = scores[code[at:at + n]].astype(float)

        def value(path):
            return sum(own[i, p] for i, p in enumerate(path)) - 2.0 * sum(a != b for a, b in zip(path, path[1:]))

        if n:
            best = max(map(value, itertools.product(range(3), repeat=int(n))))
            assert value(got[at:at + n]) == pytest.approx(best)
        at += n


def test_language_of_held_out_documents(spark):
    truth = pd.read_parquet(f"{SF}/documents.parquet").set_index("doc_id")["lang"]
    got = language.op9_language(spark, SF).toPandas()
    held = got[got["held_out"]]
    assert len(got) == len(truth) and len(held) > 100
    assert (held["lang_pred"].to_numpy() == truth[held["doc_id"]].to_numpy()).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_mixed_text_has_spans(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(language.training_rows(docs))
    long = docs.where("n_chars BETWEEN 900 AND 3000")
    en, de = (long.where(f"lang = '{x}'").orderBy("doc_id").first()["text"] for x in ("en", "de"))
    mixed = spark.createDataFrame([(1, en + "\n" + de)], "doc_id long, text string")
    spans = language.identify(mixed, model).first()["spans"]
    assert [s["lang"] for s in spans] == ["en", "de"] and abs(spans[1]["start"] - len(en)) < 40
    assert spans[0]["start"] == 0 and spans[0]["end"] == spans[1]["start"] and spans[1]["end"] == len(en) + 1 + len(de)


def test_scripts_narrow_candidates():
    names = [s for _, s in language.SCRIPTS]
    codes = np.array([ord(c) for c in "aéжカ漢한"])
    assert [language._NAMES[i] for i in language.scripts(codes)] == ["latin", "latin", "cyrillic", "kana", "han", "hangul"]
    uses = np.zeros((len(language._NAMES), 2), bool)
    uses[language._NAMES.index("latin"), 0] = uses[language._NAMES.index("cyrillic"), 1] = True
    model = language.Model(["en", "ru"], np.zeros((language.BUCKETS, 2), np.float32), uses)
    scores = language.word_scores(model, ["word", "слово", "漢字"])
    assert scores[0, 0] > scores[0, 1] and scores[1, 1] > scores[1, 0] and scores[2, 0] == scores[2, 1] and "latin" in names


@pytest.mark.parametrize("extra", [False, True])
def test_language_of_hard_rows(spark, extra):
    docs = frame(spark, hard_rows(), extra)
    got = {r["doc_id"]: r for r in language.identify(docs, language.train(language.training_rows(docs))).collect()}
    assert got[0]["lang_pred"] == got[1]["lang_pred"] == got[13]["lang_pred"] == "und"
    assert language.identify(docs, language.train(docs.limit(0))).where("lang_pred <> 'und'").count() == 0
    kept = language.keep_identified(docs, language.train(docs.where("lang IS NOT NULL")))
    assert kept.columns == docs.columns and kept.where("text IS NULL").count() == 0
    assert language.identify(frame(spark, []), language.train(docs.where("lang IS NOT NULL"))).count() == 0


def test_quality_of_held_out_documents(spark):
    labels = pd.read_parquet(f"{SF}/labels.parquet").set_index("doc_id")["quality"]
    got = quality.op8_quality(spark, SF).toPandas().set_index("doc_id")
    held = got[got["held_out"]].join(labels, how="inner")
    good, bad = held[held["quality"] == 1]["score"].to_numpy(), held[held["quality"] == 0]["score"].to_numpy()
    auc = (good[:, None] > bad[None, :]).mean()
    assert len(bad) >= 5 and auc > 0.9
    assert (held["predicted"] == (held["score"] >= 0.7)).all() and held[held["quality"] == 1]["predicted"].mean() > 0.9


@pytest.mark.parametrize("extra", [False, True])
def test_quality_of_hard_rows(spark, extra):
    docs = frame(spark, hard_rows(), extra)
    labels = spark.createDataFrame([(5, 1, 0), (9, 0, 0), (None, 0, 0), (5, 1, 0), (77, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels)
    rows = quality.score(docs, model).collect()
    assert len(rows) == len(hard_rows()) and all(0 <= r["score"] <= 1 for r in rows)
    empty = quality.train(docs, labels.limit(0))
    assert {r["score"] for r in quality.score(docs, empty).collect()} == {0.5}
    assert quality.score(frame(spark, []), model).count() == 0


def test_scores_equal_the_mean_of_the_features(spark):
    rng = np.random.default_rng(2)
    weights = rng.normal(size=quality.BUCKETS).astype(np.float32)
    texts = ["some words and some more words é%%%", "", "one", "same same same other", "two words"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: r["score"] for r in quality.score(docs, (weights, 0.25)).collect()}
    for i, t in enumerate(texts):
        at, share = quality._bag(t)
        assert got[i] == pytest.approx(1 / (1 + math.exp(-0.25 - float((weights[at] * share).sum()))), rel=1e-5)
    assert quality.BUCKETS - 1 in quality._bag("same same")[0] and quality.BUCKETS - 1 not in quality._bag("same other")[0]


def make_lm(spark, tmp_path):
    rng = random.Random(3)
    kinds = {True: ["the cat sat", "on a warm mat", "and slept all day"], False: ["buy cheap pills", "click here now", "free money fast"]}
    rows = [(i, " ".join(rng.choice(kinds[i % 4 == 0]) for _ in range(30)), None, None, 1) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 4)] + [(1, 0, 0)], "doc_id long, quality int, toxic int")
    labels.write.mode("overwrite").parquet(f"{tmp_path}/labels.parquet")
    stored(spark, frame(spark, rows + hard_rows()), tmp_path, "documents")
    return rows


def test_lm_scores(spark, tmp_path):
    rows = make_lm(spark, tmp_path)
    got = lm.op3_lm(spark, str(tmp_path)).toPandas()
    assert len(got) == len(rows) + len(hard_rows()) and np.isfinite(got["score"]).all()
    unseen = got[got["doc_id"].between(120, 199)]
    like = unseen["doc_id"] % 4 == 0
    assert unseen[like]["score"].max() < unseen[~like]["score"].min()
    none = got[got["n_tokens"] == 0]
    assert len(none) >= 3 and (none["score"] == 0).all()


def test_lm_does_not_know_the_scored_document(spark, tmp_path):
    rows = [(i, " ".join(f"only{i}x{j}" for j in range(50)), None, None, 1) for i in range(20)]
    stored(spark, frame(spark, rows), tmp_path, "documents")
    spark.createDataFrame([(i, 1, 0) for i in range(5)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = lm.op3_lm(spark, str(tmp_path)).toPandas()
    assert len(got) == 20 and (got["score"].abs() < 1e-9).all() and (got["loss_target"] > 5).all()


def test_lm_keys_come_back_from_their_gaps():
    rng = np.random.default_rng(4)
    for n in (0, 1, 2, 1000):
        for top in (1 << 12, 1 << 64):
            keys = np.unique(rng.integers(0, top - 1, n, np.uint64, endpoint=True))
            assert (lm.keys_of(lm.key_bytes(keys)) == keys).all()
    ends = np.array([0, (1 << 64) - 1], np.uint64)
    assert (lm.keys_of(lm.key_bytes(ends)) == ends).all()


def test_lm_of_an_empty_table(spark, tmp_path):
    stored(spark, frame(spark, []), tmp_path, "documents")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert lm.op3_lm(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("most, fan", [(20_000, 256), (4_000, 3), (8_000_000, 256)])
def test_lm_counts_every_word_and_pair(spark, tmp_path, monkeypatch, most, fan):
    monkeypatch.setattr(lm, "BLOCK_CHARS", most)  # many blocks, or few
    monkeypatch.setattr(lm, "FAN", fan)  # sums in several levels, or one
    monkeypatch.setattr(lm, "CUT_BITS", 2 if fan < 256 else 8)
    rng = random.Random(8)
    rows = [(i, " ".join(f"w{int(30_000 * rng.random() ** 3)}" for _ in range(rng.randrange(1, 200))), None, None, 1) for i in range(120)]
    rows += [(1000, " ".join(f"once{i}" for i in range(5_000)), None, None, 1)]
    stored(spark, frame(spark, rows + hard_rows()[:3]), tmp_path, "documents")
    spark.createDataFrame([(i, 1, 0) for i in range(0, 120, 3)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r for r in lm.op3_lm(spark, str(tmp_path)).where("n_tokens > 0").collect()}
    texts = {r[0]: r[1].split() for r in rows}
    size, want = len({w for t in texts.values() for w in t}), {}
    everything = Counter(w for t in texts.values() for w in t)
    for good, column in ((True, "loss_target"), (False, "loss_background")):
        own = {i: t for i, t in texts.items() if (i < 120 and i % 3 == 0) == good}
        words, pairs = Counter(w for t in own.values() for w in ["", *t]), Counter(p for t in own.values() for p in zip(["", *t], t))
        n = sum(map(len, own.values()))
        for i, t in texts.items():
            mine, one, two, inside = Counter(t), Counter(["", *t]), Counter(zip(["", *t], t)), i in own
            p = [0.6 * (pairs[a, w] - two[a, w] * inside) / max(1, words[a] - one[a] * inside)
                 + 0.3 * (words[w] - one[w] * inside) / max(1, n - len(t) * inside)
                 + 0.1 * (everything[w] - mine[w] + 0.5) / (sum(everything.values()) - len(t) + 0.5 * size)
                 for a, w in zip(["", *t], t)]
            want[i, column] = -sum(map(math.log, p)) / len(t)
    assert got.keys() == texts.keys()
    assert all(got[i][column] == pytest.approx(loss, rel=1e-9) for (i, column), loss in want.items())
