import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadpulse.llm import tokens
from tests.llm.cases import frame, hard_rows, stored

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def by_library(text):
    return len(LIBRARY.encode(text or "", add_special_tokens=False).ids)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=60) | st.text(alphabet="aeth 's\n.<|endofx>1é漢\x1c\x85\xa0", max_size=200), max_size=6))
def test_counts_are_the_library_s(texts):
    assert tokens.Counter.of(PATH).count(texts) == [by_library(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="aehnotr-", min_size=1, max_size=400))
def test_both_orders_of_work_agree(word):
    merger = tokens.Merger(PATH)
    raw = word.encode()
    assert merger._in_order(raw) == merger._together([raw], tokens.np.array([len(raw)]))[0]


def test_every_character_is_cut_as_by_the_library():
    pre = tokens.PreTokens(LIBRARY)
    for code in [*range(0x600), 0x1C80, 0x2028, 0x200B, 0x3000, 0xA7CE, 0xFEFF, 0x10940, 0x1F600]:
        text = f"x{chr(code)}1{chr(code)}!{chr(code)} {chr(code)}"
        assert pre.cut(text) == [text[i:j] for _, (i, j) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)], code


def test_long_pre_tokens():
    rng = random.Random(3)
    words = ["a" * 50_000, "ab" * 9_999, "".join(rng.choice("etaoinshr") for _ in range(30_000)), "-=" * 4_000, "é" * 500]
    assert tokens.Counter.of(PATH).count(words) == [by_library(w) for w in words]


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 5)
    counter = tokens.Counter(PATH)
    texts = [" ".join(f"word{i}x{j}" for j in range(4)) for i in range(20)]
    assert [counter.count([t])[0] for t in texts] == [by_library(t) for t in texts]
    assert len(counter.known) < 40


@pytest.mark.parametrize("extra", [False, True])
def test_rows(spark, tmp_path, extra):
    rows = [*hard_rows(), (2**60 + 1, "an id that no double holds", None, None, None)]
    got = tokens.count_tokens(stored(spark, frame(spark, rows, extra), tmp_path), PATH)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(((r[0], len((r[1] or "").encode()), by_library(r[1]), by_library(r[1]) > 512) for r in rows), key=str)
    assert sorted((tuple(r) for r in got.collect()), key=str) == want


def test_empty_table(spark, tmp_path):
    assert tokens.count_tokens(stored(spark, frame(spark, []), tmp_path), PATH).count() == 0


def test_whole_table(spark, sf):
    rows = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    got = tokens.op11_tokens(spark, sf).collect()
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {k: by_library(t) for k, t in rows.items()} and len(got) == len(rows)
