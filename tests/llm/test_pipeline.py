import numpy as np
import public_tokenizers

import corpus_pipeline
from roadpulse.llm import packing, pii
from roadpulse.llm.queries import all_queries
from tests.llm.cases import Sets, frame, hard_rows, jaccard, sentence, shingle_set
from tests.llm.test_templates import ITEM, brute


def make(spark, folder, rows):
    frame(spark, rows, True).write.mode("overwrite").parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.mode("overwrite").parquet(f"{folder}/benchmark.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def test_every_operator_is_registered_once():
    numbers = sorted(int(n[2:].split("_")[0]) for n in all_queries())
    assert numbers == list(range(1, 14))
    assert len(corpus_pipeline.STAGES) == 5


def test_stages_do_their_work(spark, tmp_path):
    import random

    rng = random.Random(8)
    rows = hard_rows() + [(100, sentence(rng, 40) + " " + ITEM, "en", "s", 1), (101, sentence(rng, 40) + " mail a@b.co", "en", "s", 1)]
    docs = make(spark, tmp_path, rows)
    columns = docs.columns
    outs = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(f"{tmp_path}/out-{k}")
        docs = spark.read.parquet(f"{tmp_path}/out-{k}")
        outs.append([tuple(r) for r in docs.select("doc_id", "text").collect()] if k < 4 else docs.collect())
        assert docs.columns == columns or k == 4
    identified, single, clean, redacted, pieces = outs
    letters = [(d, t) for d, t, *_ in rows if t and any(c.isalpha() for c in t)]
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(identified, key=key) == sorted(letters, key=key)
    sets, groups = [shingle_set(t) for _, t in identified], Sets(len(identified))
    for i in range(len(sets)):
        for j in range(i):
            if jaccard(sets[i], sets[j]) >= 0.8:
                groups.join(i, j)
    assert len(single) == len({groups.find(i) for i in range(len(sets))}) and set(single) <= set(identified)
    hit = {d for d, *_ in brute(single, [(1, ITEM)])}
    assert hit == {100} and sorted(clean, key=key) == sorted((r for r in single if r[0] not in hit), key=key)
    assert len(redacted) == len(clean) and "mail [EMAIL]" in dict(redacted)[101]
    assert not any(pii.scored(t) for _, t in redacted)
    encoder = packing.Encoder.of(public_tokenizers.path("word_bpe_49k.json"))
    want = sorted([*np.frombuffer(r, "<u4").tolist(), 2] for r in encoder.encode([t for _, t in redacted]))
    stream = b"".join(p["ids"] for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])))
    got, own = [], []
    for p in np.frombuffer(stream, "<u4").tolist():
        own.append(p)
        if p == 2:
            got.append(own)
            own = []
    if all(2 not in w[:-1] for w in want):
        assert sorted(got) == want
    assert len(stream) // 4 == sum(map(len, want))
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((p["doc_id"] or -1, p["start"], p["ids_crc32"]) for p in whole) == sorted(
        (p["doc_id"] or -1, p["start"], p["ids_crc32"]) for p in pieces)


def test_empty_tables(spark, tmp_path):
    make(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
