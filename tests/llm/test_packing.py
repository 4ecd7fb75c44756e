import itertools
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.llm import packing
from tests.llm.cases import frame, hard_rows, stored

PATH = public_tokenizers.path("word_bpe_49k.json")


def own_ids(text):
    return packing.Encoder.of(PATH).tokenizer.encode(text or "", add_special_tokens=False).ids + [2]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=40) | st.text(alphabet="aB'stéß1 2.,!<|endofx>\n", max_size=40), max_size=5))
def test_encoder_equals_the_tokenizer(texts):
    got = packing.Encoder.of(PATH).encode(texts)
    assert [np.frombuffer(r, "<u4").tolist() for r in got] == [own_ids(t)[:-1] for t in texts]


def test_hilbert_steps_are_neighbours():
    for dims, bits in ((2, 4), (3, 3)):
        points = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        key = packing.hilbert_key(points, bits)
        order = points[np.argsort(key)]
        assert sorted(key.tolist()) == list(range(len(points)))
        assert (np.abs(np.diff(order, axis=0)).sum(1) == 1).all()


def test_like_documents_are_near():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 49000, 400)
    b = a.copy()
    b[:8] = 17
    points = packing.project([a, b, rng.integers(0, 49000, 400)]).astype(int)
    assert np.abs(points[0] - points[1]).sum() < np.abs(points[0] - points[2]).sum()


@pytest.mark.parametrize("sequence", [64, 4096])
def test_round_trip(spark, tmp_path, sequence):
    rows = hard_rows()
    docs = stored(spark, frame(spark, rows, True), tmp_path)
    pieces = packing.pack(docs, PATH, sequence=sequence, with_ids=True).collect()
    total = sum(len(own_ids(t)) for _, t, *_ in rows)
    by_sequence = {}
    for p in pieces:
        assert p["ids_crc32"] == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"]
        by_sequence.setdefault(p["sequence_id"], []).append(p)
    assert sorted(by_sequence) == list(range(-(-total // sequence)))
    for k, own in by_sequence.items():
        own.sort(key=lambda p: p["offset"])
        at = 0
        for p in own:
            assert p["offset"] == at
            at += p["length"]
        assert at == sequence or k == max(by_sequence)
    whole = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        if p["start"] == 0:
            whole.setdefault(p["doc_id"], []).append([])
        assert p["start"] == len(whole[p["doc_id"]][-1])
        whole[p["doc_id"]][-1] += np.frombuffer(p["ids"], "<u4").tolist()
    want = {}
    for doc, text, *_ in rows:
        want.setdefault(doc, []).append(own_ids(text))
    assert {k: sorted(v) for k, v in whole.items()} == {k: sorted(v) for k, v in want.items()}


def test_empty_table(spark, tmp_path):
    assert packing.pack(stored(spark, frame(spark, []), tmp_path), PATH).count() == 0


def test_words_that_are_known_are_not_cut_again(monkeypatch):
    texts = ["It's 12 o'clock, said the\tthird; ÀÉ ß-x", "the 12 third, <said>\r\nÀÉ's"]
    encoder = packing.Encoder(PATH)
    first = encoder.encode(texts)
    assert [np.frombuffer(r, "<u4").tolist() for r in first] == [own_ids(t)[:-1] for t in texts]
    calls, cut = [], packing._PIECE
    monkeypatch.setattr(packing, "_PIECE", lambda z: calls.append(z) or cut(z))
    assert encoder.encode(texts[::-1]) == first[::-1] and not calls


def test_words_known_are_let_go_before_pieces_are_cut():
    for step in (packing._running, packing._cut(64, True)):
        packing.Encoder.of(PATH)
        assert not list(step(iter([]))) and not packing._encoders
