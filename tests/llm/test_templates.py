import random
import re
from collections import defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from roadpulse.llm import templates
from tests.llm.cases import frame, hard_rows, sentence, stored

ITEM = ("A train leaves Berlin at 9 with 120 passengers and travels 340 km to Munich in 4 hours. "
        "How fast does the train from Berlin travel if Anna Schmidt counts 120 passengers again?")


# Words, numbers, ends of sentences and signs, as the operator's docstring has them.
PATTERN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[.!?:\n]|[%$€£°]")


def plain_template(text):
    """Token by token: (kind, word or value)."""
    out, start = [], True
    for t in PATTERN.findall(text or ""):
        if t in ".!?:\n":
            start = True
            continue
        if t[0].isdigit():
            out.append(["num", t])
        elif t in "%$€£°" or (out and out[-1][0] == "num" and not start and t.lower() in templates.UNITS):
            out.append(["unit", t])
        elif t.lower() not in templates.UNITS and not start and len(t) > 1 and t[0].isupper() and t[1:].islower():
            if out and out[-1][0] == "name":
                out[-1][1] += " " + t
            else:
                out.append(["name", t])
        else:
            out.append(["", t.lower()])
        start = False
    return [tuple(o) for o in out]


def plain_windows(tokens, width):
    for i in range(len(tokens) - width + 1):
        own = tokens[i:i + width]
        if sum(not k for k, _ in own) >= templates.WORD_SHARE * width:
            yield i, tuple(k or v for k, v in own), tuple(v for k, v in own if k)


def brute(docs, items, coverage=0.5):
    out = set()
    for item, text in items:
        tokens = plain_template(text)
        if len(tokens) < templates.MIN_TOKENS:
            continue
        width = min(templates.WINDOW, len(tokens))
        theirs = list(plain_windows(tokens, width))
        for doc, doc_text in docs:
            own = defaultdict(list)
            if len(plain_template(doc_text)) >= templates.MIN_TOKENS:
                for j, key, slots in plain_windows(plain_template(doc_text), width):
                    own[key].append((j, slots))
            runs = defaultdict(lambda: (set(), set()))
            for i, key, slots in theirs:
                for j, doc_slots in own[key]:
                    runs[j - i][0].add(i)
                    runs[j - i][1].update(zip(slots, doc_slots))
            good = [(p, v) for p, v in runs.values() if len({a for a, _ in v}) == len(v)]
            places = set().union(*(p for p, _ in good)) if good else set()
            if theirs and places and len(places) / len(theirs) >= coverage:
                out.add((doc, item, len(places), round(len(places) / len(theirs), 9), all(a == b for _, v in good for a, b in v)))
    return out


def texts():
    rng = random.Random(4)
    filler = [sentence(rng, 60) for _ in range(4)]
    changed = (ITEM.replace("120", "75").replace("Berlin", "Madrid").replace("Munich", "Cadiz").replace("340", "410")
               .replace("km", "miles").replace("Anna Schmidt", "Eva"))
    broken = ITEM.replace("120 passengers and", "75 passengers and").replace("Berlin at", "Paris at")
    return [(0, filler[0] + ". " + ITEM + " " + filler[1]), (1, f"{filler[1]} {changed}\n{filler[2]}"), (2, filler[2] + ". " + broken),
            (3, filler[3]), (4, ITEM[:60]), (5, ITEM + " " + changed), (6, ITEM.upper()), (7, "six plain words stand right here"),
            (8, "only four short words")]


def test_reparameterised_items_are_found(spark, tmp_path):
    rows = [(i, t, "en", "s", len(t)) for i, t in texts()] + [(100 + i, *r[1:]) for i, r in enumerate(hard_rows())]
    items = [(1, ITEM), (2, "Six plain words stand right here"), (3, "only four short words"), (4, None), (5, ""), (None, ITEM), (1, ITEM)]
    docs = stored(spark, frame(spark, rows, True), tmp_path)
    bench = spark.createDataFrame(items, "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/bench.parquet")
    bench = spark.read.parquet(f"{tmp_path}/bench.parquet")
    got = templates.contamination(docs, bench).collect()
    found = {(r["doc_id"], r["item_id"], r["n_windows"], round(r["coverage"], 9), r["exact"]) for r in got}
    assert found == brute([r[:2] for r in rows], items)
    pairs = {(r["doc_id"], r["item_id"]): r["exact"] for r in got}
    assert pairs[0, 1] and not pairs[1, 1] and (2, 1) not in pairs and (3, 1) not in pairs and (7, 2) in pairs and (8, 3) not in pairs
    kept = templates.clean_of(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in rows if r[0] not in {d for d, _ in pairs})
    assert templates.contamination(docs, bench.limit(0)).count() == 0
    assert templates.contamination(stored(spark, frame(spark, []), tmp_path, "none"), bench).count() == 0


def test_given_documents_equal_brute_force(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    got = {(r["doc_id"], r["item_id"], r["n_windows"], round(r["coverage"], 9), r["exact"]) for r in
           templates.op1_templates(spark, sf).collect()}
    assert got == brute(docs, items)


@pytest.mark.parametrize("text,kinds", [
    ("In 5 km Anna Lee ran 3.5% more", ["in", "num", "unit", "name", "ran", "num", "unit", "more"]),
    ("Anna ran. Bob Bobson sat", ["anna", "ran", "bob", "name", "sat"]), ("", []), ("day 7 days", ["day", "num", "unit"])])
def test_templates(text, kinds):
    own = templates.Templates(templates.Tokens([text]))
    names = {templates.NUM: "num", templates.UNIT: "unit", templates.NAME: "name"}
    assert [names.get(k, own.names[own.code[own.at[i]]].lower()) for i, k in enumerate(own.kind.tolist())] == kinds


def test_bitmap_passes_its_hashes(spark):
    rows = [(h,) for h in (0, -1, 5, 1 << 62, -(1 << 63), 123456789012345)]
    bits = templates.hash_filter(spark.createDataFrame(rows, "h long"), 12)
    import numpy as np

    assert templates.passes(bits, np.array([r[0] for r in rows]).view(np.uint64)).all()
    other = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    assert templates.passes(bits, other).mean() < 0.05


def test_items_of_any_kind_are_found_where_they_stand(spark, tmp_path):
    rng = random.Random(11)
    items = [(1, "What is 12 + 34 + 56?"), (2, "Compute 12 * 34 + 56 - 78."), (3, "What is the capital of France?"), (4, "only four"),
             (5, " ".join(str(rng.randrange(99)) for _ in range(30))), (6, ITEM), (7, "Who was Anna Lee?"), (8, None), (9, " ")]
    rows = [(100 + i, f"{sentence(rng, 20)} {t} {sentence(rng, 20)}", "en", "s", 1) for i, t in items if t]
    rows += [(200, "we ask What is the capital of Spain? of all", "en", "s", 1), (201, "What is 12 - 34 - 56?", "en", "s", 1), *hard_rows()]
    docs = stored(spark, frame(spark, rows), tmp_path, "documents")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = {(r["doc_id"], r["item_id"]): r["exact"] for r in templates.op1_templates(spark, str(tmp_path)).collect()}
    plain = {(d, i) for d, text, *_ in rows for i, t in items if t and t.strip() and t.lower() in (text or "").lower()}
    assert plain <= got.keys() and all(got[k] for k in plain)
    assert got.keys() - plain == {(200, 3)} and not got[200, 3]
    kept = {r["doc_id"] for r in templates.clean_of(docs, spark.read.parquet(f"{tmp_path}/benchmark.parquet"), whole=True).collect()}
    assert kept == {r[0] for r in rows} - {d for d, _ in got}


def test_a_word_is_cut_once(monkeypatch):
    text = "In 5 km, Anna's team_a ran\n\n3.5% more -\x1c ﬁn x²\r\n"
    expected = templates._tokens(text) * 30
    calls, cut = [], templates._tokens
    monkeypatch.setattr(templates, "_tokens", lambda t: calls.append(t) or cut(t))
    templates.Vocabulary.forget()
    own = templates.Tokens([text, ""] * 30)
    assert [own.vocabulary.tokens[c] for c in own.code] == expected
    assert own.text.tolist() == [2 * i for i in range(30) for _ in range(len(expected) // 30)]
    assert len(calls) == len(set(calls)) and not templates.Tokens([None or ""]).code.size


PARTS = re.compile(r"\d+|[^\W\d_]+|[^\w\s]|_").findall


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(max_size=30) | st.text(alphabet="aBKm'’1²½.,: \n_İΣσςΟ\u0307ǅ٣\x1c\ud800%", max_size=30), max_size=5))
def test_tokens_are_cut_as_by_the_pattern(texts):
    own = templates.Tokens(texts)
    want = [(i, t) for i, text in enumerate(texts) for t in templates._tokens(text)]
    assert [(i, own.vocabulary.tokens[c]) for i, c in zip(own.text.tolist(), own.code.tolist())] == want
    assert own.kind.tolist() == [templates._class(t) for _, t in want]
    parts = [(i, p) for i, t in want for p in PARTS(t.lower())]
    assert own.part_text.tolist() == [i for i, _ in parts]
    hashes = [*zip([t.lower() for _, t in want], own.h.tolist()), *zip([p for _, p in parts], own.part_h.tolist())]
    assert len(set(hashes)) == len({t for t, _ in hashes}) == len({h for _, h in hashes})


def test_work_on_new_words_is_not_done_one_by_one(monkeypatch):
    rng = random.Random(5)
    text = " ".join("".join(rng.choices("abcdeFGH", k=9)) for _ in range(5000))
    calls, own = [], templates._class
    monkeypatch.setattr(templates, "_class", lambda t: calls.append(t) or own(t))
    templates.Vocabulary.forget()
    assert len(templates.Tokens([text]).code) == 5000 and len(calls) < 200
