import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadpulse.llm import alignment
from tests.llm.cases import frame, hard_rows, stored

PATH_A, PATH_B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(PATH_A)
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATH_B)


def alphabet():
    """Bytes of the letters of byte-level tokens: printable ones are themselves, the others follow from U+0100."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + i): b for i, b in enumerate(rest)}}


LETTERS = alphabet()


def plain_tokens(text):
    """(id, bytes) of both tokenizers for the whole text, or nothing."""
    if not text:
        return [], []
    a = [(i, bytes(LETTERS[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in B.encode(text):
        piece = B.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()))
    want = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == want == b"".join(x for _, x in b) else ([], [])


def spans(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def plain_document(text):
    """n_a, n_b, n_groups, links, text of groups, by looking at every pair near each other."""
    a, b = map(spans, plain_tokens(text))
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    groups, start = [], 0
    ia = ib = 0
    for end in ends:
        ga, gb = [], []
        while ia < len(a) and a[ia][2] <= end:
            ga.append(str(a[ia][0]))
            ia += 1
        while ib < len(b) and b[ib][2] <= end:
            gb.append(str(b[ib][0]))
            ib += 1
        groups.append(",".join(ga) + "|" + ",".join(gb))
        start = end
    links, j = [], 0
    for i, s, e in a:
        while j < len(b) and b[j][2] <= s:
            j += 1
        k = j
        while k < len(b) and b[k][1] < e:
            links.append((i, b[k][0]))
            k += 1
    return len(a), len(b), len(groups), links, ";".join(groups)


def plain_rows(rows):
    docs = [(r[0], *plain_document(r[1])) for r in rows]
    count = Counter(p for d in docs for p in set(d[4]))
    highest = Counter()
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    return [(d, na, nb, ng, len(links), sum(count[p] == highest[p[0]] for p in links), sum(count[p] for p in links),
             hashlib.sha256(text.encode()).hexdigest() if na else "") for d, na, nb, ng, links, text in docs]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=50) | st.text(alphabet="aeth s\n.<>0xA▁é漢\x00\x1c\xa0", max_size=120), min_size=1, max_size=5))
def test_pieces_give_the_tokens_of_whole_texts(texts):
    texts = [t for t in texts if t and "▁" not in t]
    if not texts:
        return
    pair = alignment.Pair.of(PATH_A, PATH_B)
    (cut_a, good_a), (cut_b, good_b) = (ids.pieces([" " + t for t in texts]) for ids in (pair.a, pair.b))
    assert (good_a & good_b).tolist() == [bool(plain_tokens(t)[0]) for t in texts]
    assert pair.a.ids(cut_a)[0].tolist() == [i for t in texts for i in A.encode(" " + t, add_special_tokens=False).ids]
    assert pair.b.ids(cut_b)[0].tolist() == [i for t in texts for i in B.encode(t)]


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 300), st.integers(0, 2**32 - 1))
def test_bitmaps_come_back(docs, seed):
    rng = np.random.default_rng(seed)
    own = [(p, d) for p in range(0, 40, 3) for d in np.flatnonzero(rng.random(docs) < rng.random()).tolist()]
    pair, doc = np.array([p for p, _ in own], np.int64), np.array([d for _, d in own], np.int64)
    raw = alignment.bitmaps(pair, doc, docs)
    assert sorted(zip(*(x.tolist() for x in alignment.postings(raw, docs)))) == own
    assert dict(zip(*(x.tolist() for x in alignment.popcounts(raw, docs)))) == Counter(p for p, _ in own)


@pytest.mark.parametrize("most", [1 << 16, 3])
def test_rows(spark, tmp_path, most):
    rows = [*hard_rows(), (40, "special <|endoftext|> and <s> </s>", None, None, None), (41, "with ▁ inside", None, None, None),
            (None, "a a a a a a a a the the the the", None, None, None), (2**60 + 1, "big id", None, None, None)]
    docs = stored(spark, frame(spark, rows, True), tmp_path)
    made = alignment.blocks(docs, PATH_A, PATH_B, most).select("docs").collect()
    assert sum(r["docs"] for r in made) == len(rows) and (len(made) > 5) == (most == 3)
    assert collected(alignment.align(docs, PATH_A, PATH_B, most)) == sorted(plain_rows(rows), key=str)


def test_texts_in_parts(monkeypatch):
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdé \n.") for _ in range(rng.randrange(1, 9))) for _ in range(4_000))
    whole = alignment.Block(alignment.Pair.of(PATH_A, PATH_B))
    whole.add(0, [1], [text])
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 500)
    parts = list(alignment.text_parts(" " + text))
    cut = alignment.Block(alignment.Pair.of(PATH_A, PATH_B))
    cut.add(0, [1], [text])
    assert len(parts) > 20 and "".join(parts) == " " + text
    assert whole.row().to_dict("list") == cut.row().to_dict("list")


def test_a_text_that_does_not_come_back_has_no_tokens(monkeypatch):
    pair = alignment.Pair(PATH_A, PATH_B)
    monkeypatch.setattr(pair.b, "token_bytes", [b"?" if t == b" bad" else t for t in pair.b.token_bytes])
    block = alignment.Block(pair)
    block.add(0, [1, 2], ["good and fine", "good or bad"])
    row = block.row().iloc[0]
    totals = np.frombuffer(row["totals"], "<i8").reshape(6, 2)
    assert totals[:4, 1].tolist() == [0, 0, 0, 0] and totals[0, 0] == 3 and row["digests"][1] == ""
    assert set(alignment.postings(row["present"], 2)[1].tolist()) == {0}


def test_empty_table(spark, tmp_path):
    assert alignment.align(stored(spark, frame(spark, []), tmp_path), PATH_A, PATH_B).count() == 0


def test_whole_table(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert collected(alignment.op12_alignment(spark, sf)) == sorted(plain_rows(rows), key=str)
