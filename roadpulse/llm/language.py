"""Language of texts and of spans in them (operator 9).

The scripts of a word's letters narrow its candidate languages; hashed letter trigrams score it in each; Viterbi with a
penalty for each change labels the words of a text in sequence. Counts are taken over all training documents.

Rows: NULL texts and texts without letters get ``und`` and score 0; NULL ``doc_id`` stays NULL and trains nothing; equal rows
give equal rows; an empty table gives no rows; without any training row every text is ``und``; long texts take as
many steps as words, in batches of bounded size. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Scratch, fresh, keep_alone, read_table, text_chunks
from roadpulse.llm.grams import code_points, hashed_grams

BUCKETS = 1 << 15
SWITCH = 12.0
SMOOTHING = 0.1
# A language is a candidate for a script that makes up this share of its training letters or more.
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
# Documents of which less is in any one language are rejected.
LEAST_SHARE = 0.5

_word_signs = re.compile(r"[^\W\d_]+")


def letter_words(text: str) -> list[str]:
    """Runs of letters. Number signs such as fractions and Roman numeral signs are word characters, but no letters."""
    found = _word_signs.findall(text)
    if all(map(str.isalpha, found)):
        return found
    return [w for part in found for w in "".join(c if c.isalpha() else " " for c in part).split()]


def word_starts(text: str) -> list[int]:
    """Where each run of letters begins."""
    return [m.start() + i for m in _word_signs.finditer(text) for i, c in enumerate(m.group())
            if c.isalpha() and not (i and m.group()[i - 1].isalpha())]


# First code points of blocks, and the script from there on.
SCRIPTS = ((0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0780, "other"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"),
           (0x0E80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"),
           (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3130, "hangul"),
           (0x3190, "kana"), (0x3400, "han"), (0xA000, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"),
           (0xFB00, "latin"), (0xFB07, "other"), (0x20000, "han"))
_STARTS = np.array([a for a, _ in SCRIPTS])
_NAMES = sorted({s for _, s in SCRIPTS})
_NUMBER = np.array([_NAMES.index(s) for _, s in SCRIPTS])


def scripts(codes: np.ndarray) -> np.ndarray:
    return _NUMBER[np.searchsorted(_STARTS, codes, "right") - 1]


@dataclass
class Model:
    """langs; log probability of each trigram bucket by language; whether a language uses a script."""

    langs: list[str]
    grams: np.ndarray
    uses: np.ndarray


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND crc32(CAST(doc_id AS STRING)) % 5 <> 0")


def _count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams: dict[str, np.ndarray] = {}
    for b in batches:
        for lang, own in b.groupby("lang")["text"]:
            total = grams.setdefault(lang, np.zeros(BUCKETS + len(_NAMES), np.int64))
            for _, texts in text_chunks(own):
                seen = Counter(w for t in texts for w in letter_words(t.lower()))
                if not seen:
                    continue
                weights = np.fromiter(seen.values(), np.int64, len(seen))
                codes, numbers = code_points(list(seen))
                bucket, word = hashed_grams(codes, numbers, 3, BUCKETS)
                total[:BUCKETS] += np.bincount(bucket, weights[word], BUCKETS).astype(np.int64)
                letter = codes != 10
                total[BUCKETS:] += np.bincount(scripts(codes[letter]), weights[numbers[letter]], len(_NAMES)).astype(np.int64)
    for lang, total in grams.items():
        at = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": total[at]})


def train(docs: DataFrame) -> Model:
    """Counts over all given rows (text, lang); only sums by language and bucket, a fixed number for each language, are collected."""
    Scratch(docs.sparkSession, "language")
    counts = (docs.select("lang", "text").mapInPandas(_count, "lang string, bucket long, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas())
    langs = sorted(counts["lang"].unique())
    table = np.zeros((BUCKETS + len(_NAMES), len(langs)))
    table[counts["bucket"].to_numpy(np.int64), np.searchsorted(langs, counts["lang"].to_numpy(str))] = counts["n"].to_numpy()
    grams, letters = table[:BUCKETS] + SMOOTHING, table[BUCKETS:]
    return Model(langs, np.log(grams / grams.sum(0)).astype(np.float32), letters >= SCRIPT_SHARE * letters.sum(0))


def word_scores(model: Model, words: list[str]) -> np.ndarray:
    """Log likelihood of each word in each language; languages that do not use its script are out unless all are."""
    codes, numbers = code_points(words)
    bucket, word = hashed_grams(codes, numbers, 3, BUCKETS)
    order = np.argsort(word, kind="stable")
    starts = np.searchsorted(word[order], np.arange(len(words)))
    scores = np.add.reduceat(model.grams[bucket[order]], starts, axis=0)
    first = np.flatnonzero(codes == 10)[:-1] + 1
    uses = model.uses[scripts(codes[first])]
    return np.where(uses | ~uses.any(1, keepdims=True), scores, scores.min(1, keepdims=True) - 1000)


def viterbi(scores: np.ndarray, code: np.ndarray, lengths: np.ndarray, switch: float = SWITCH) -> np.ndarray:
    """Best label of each word, where each change of label within a text costs ``switch``.

    All texts go forward together, longest first: step t handles word t of every text that has one.
    """
    starts = np.r_[0, np.cumsum(lengths)[:-1]]
    order = np.argsort(-lengths, kind="stable")
    ranked, begin = lengths[order], starts[order]
    steps, labels = int(ranked[0]), np.zeros(len(code), np.int16)
    active = np.searchsorted(-ranked, -np.arange(steps), "left")  # texts longer than t
    back: list[np.ndarray | None] = [None] * steps
    best = scores[code[begin[:active[0]]]].astype(np.float64)
    ends = np.zeros(active[0], np.int16)
    for t in range(1, steps):
        n = active[t]
        if n < len(best):
            ends[n:len(best)] = best[n:].argmax(1)
            best = best[:n]
        top = best.argmax(1)
        other = best[np.arange(n), top] - switch
        stay = best >= other[:, None]
        back[t] = np.where(stay, np.arange(best.shape[1], dtype=np.int16), top[:, None].astype(np.int16))
        best = np.where(stay, best, other[:, None]) + scores[code[begin[:n] + t]]
    ends[:len(best)] = best.argmax(1)
    for t in range(steps - 1, -1, -1):
        n = active[t]
        labels[begin[:n] + t] = ends[:n]
        if t:
            ends[:n] = back[t][np.arange(n), ends[:n]]
    return labels


def label_texts(model: Model, texts: list[str]) -> tuple[list[list[str]], np.ndarray, np.ndarray]:
    """Words of each text, the number of words, and all words' labels in sequence."""
    words = [letter_words(t.lower()) for t in texts]
    lengths = np.array([len(w) for w in words])
    flat = [w for own in words for w in own]
    if not flat or not model.langs:
        return words, lengths, np.zeros(len(flat), np.int16)
    unique = list(dict.fromkeys(flat))
    number = dict(zip(unique, range(len(unique))))
    code = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    return words, lengths, viterbi(word_scores(model, unique), code, lengths)


def _spans(langs: list[str], text: str, labels: np.ndarray) -> list[dict]:
    """Runs of equally labelled words: from their first letter to the start of the next run, the first from 0."""
    if not len(labels):
        return []
    cuts = np.flatnonzero(labels[1:] != labels[:-1]) + 1
    if not len(cuts):
        return [{"lang": langs[labels[0]], "start": 0, "end": len(text)}]
    places = word_starts(text)
    if len(places) != len(labels):  # lower case changed the number of words
        places = word_starts(text.lower())
    edges = [0, *(min(places[c], len(text)) for c in cuts), len(text)]
    return [{"lang": langs[labels[c]], "start": a, "end": b} for c, a, b in zip([0, *cuts], edges, edges[1:])]


def _labels(docs: DataFrame, model: Model, with_spans: bool, name: str) -> DataFrame:
    """The input with a column of that name: lang_pred, score, spans."""
    Scratch(docs.sparkSession, "language")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # a fixed number of values for each language

    @F.pandas_udf("struct<lang_pred:string,score:double,spans:array<struct<lang:string,start:int,end:int>>>")
    def label(column: pd.Series) -> pd.DataFrame:
        keep_alone("language")
        own, out = shared.value, []
        count = max(1, len(own.langs))
        for _, texts in text_chunks(column):
            words, lengths, labels = label_texts(own, texts)
            letters = np.fromiter((len(w) for ws in words for w in ws), np.int64, int(lengths.sum()))
            share = np.bincount(np.repeat(np.arange(len(texts)), lengths) * count + labels, letters,
                                len(texts) * count).reshape(len(texts), -1)
            ends = np.cumsum(lengths)
            for i, t in enumerate(texts):
                if not own.langs or not lengths[i]:
                    out.append((UNKNOWN, 0.0, []))
                    continue
                k = int(share[i].argmax())
                out.append((own.langs[k], float(share[i][k] / share[i].sum()),
                            _spans(own.langs, t, labels[ends[i] - lengths[i]:ends[i]]) if with_spans else []))
        return pd.DataFrame(out, columns=["lang_pred", "score", "spans"])

    return docs.withColumn(name, label("text"))


def identify(docs: DataFrame, model: Model, with_spans: bool = True) -> DataFrame:
    """The input's columns, lang_pred (the language of most letters), score (its share of the letters), spans by code point."""
    name = fresh(docs, "label")
    return _labels(docs, model, with_spans, name).select(
        *[c for c in docs.columns if c not in ("lang_pred", "score", "spans")], f"{name}.*")


def keep_identified(docs: DataFrame, model: Model, least: float = LEAST_SHARE) -> DataFrame:
    """The documents with letters, of which ``least`` or more are in one language."""
    name = fresh(docs, "label")
    return _labels(docs, model, False, name).where(
        (F.col(f"{name}.lang_pred") != UNKNOWN) & (F.col(f"{name}.score") >= least)).select(*docs.columns)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return identify(docs.select("doc_id", "text"), train(training_rows(docs)), with_spans=False).select(
        "doc_id", F.expr("coalesce(crc32(CAST(doc_id AS STRING)) % 5 = 0, false)").alias("held_out"), "lang_pred", "score")
