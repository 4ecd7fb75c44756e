"""Supervised quality classifier over hashed subwords (operator 8).

Words, their letter 3- and 4-grams and pairs of neighbouring words are hashed to learned vectors. A word is the mean of its own
vector and those of its n-grams, a text the mean of its words and pairs, and a softmax over the two labels scores it. All pairs of a
word with itself share one vector, as repeating says more than the word. Trained by stochastic gradient descent in numpy, in one task, on a bounded
sample: ``SAMPLE`` labelled rows of each class, chosen by a hash of the id, whole texts. Scoring needs one number for
each bucket, as a sum of logits is the logit of the mean.

Rows: NULL and empty texts have no features and get the score of the bias alone; NULL ``doc_id`` rows are scored and train
nothing; of repeated labelled ids each row counts; an empty table gives no rows; with fewer than two
classes every score is the share of label 1, or 0.5 without labels. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import MIX_A, Scratch, mixed, read_table, text_chunks
from roadpulse.llm.grams import code_points, hashed_grams

# The first buckets are for words and n-grams, the others for pairs, the last for pairs of a word with itself.
SUBWORDS, PAIRS = 1 << 16, 1 << 15
BUCKETS, DIM = SUBWORDS + PAIRS + 1, 8
SAMPLE = 2000
EPOCHS, RATE, SEED = 6, 0.5, 11
GRAMS = (3, 4)
KEEP = 0.7


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and word number of each feature (the whole word and its n-grams), and a 64-bit hash of each word."""
    codes, numbers = code_points(words)
    found = [hashed_grams(codes, numbers, size, SUBWORDS) for size in GRAMS]
    starts, letters = np.flatnonzero(codes == 10)[:-1], codes[:-1]  # without the line end after the last word
    spread = (letters ^ (letters << np.uint64(17))) * MIX_A
    at = np.arange(len(letters), dtype=np.uint64) - starts[numbers[:-1]].astype(np.uint64)
    whole = mixed(np.add.reduceat(spread * (at * np.uint64(2) + np.uint64(1)), starts))
    own = (whole % np.uint64(SUBWORDS)).astype(np.int64)
    return np.concatenate([own, *(b for b, _ in found)]), np.concatenate([np.arange(len(words)), *(w for _, w in found)]), whole


def pair_buckets(code: np.ndarray, whole: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of each pair of neighbouring words; ``code`` has the words' numbers in texts of these lengths."""
    text = np.repeat(np.arange(len(lengths)), lengths)
    at = np.flatnonzero(text[1:] == text[:-1])
    a, b = code[at], code[at + 1]
    bucket = SUBWORDS + (mixed(whole[a] * MIX_A + whole[b]) % np.uint64(PAIRS)).astype(np.int64)
    return np.where(a == b, BUCKETS - 1, bucket), text[at]


def numbered(words: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct words, and the number of each word among them."""
    unique = list(dict.fromkeys(words))
    number = dict(zip(unique, range(len(unique))))
    return unique, np.fromiter(map(number.__getitem__, words), np.int64, len(words))


def _bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text with their shares."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    unique, code = numbered(words)
    bucket, word, whole = features(unique)
    each = np.bincount(code, minlength=len(unique)) / np.bincount(word, minlength=len(unique))
    pairs, _ = pair_buckets(code, whole, np.array([len(words)]))
    total = np.bincount(bucket, each[word], BUCKETS) + np.bincount(pairs, minlength=BUCKETS)
    at = np.flatnonzero(total)
    return at, total[at] / total.sum()


def fit(texts: list[str], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Logit of label 1 for each bucket, and the bias."""
    if not len(labels) or labels.min() == labels.max():
        share = float(labels.mean()) if len(labels) else 0.5
        share = min(1 - 1e-6, max(1e-6, share))
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    rng = np.random.default_rng(SEED)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS, DIM))
    out, bias = np.zeros((DIM, 2)), np.zeros(2)
    bags = [_bag(t) for t in texts]
    steps, done = EPOCHS * len(texts), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(texts)):
            rate = RATE * (1 - done / steps)
            done += 1
            at, share = bags[i]
            mean = share @ vectors[at]
            logits = mean @ out + bias
            p = np.exp(logits - logits.max())
            slope = p / p.sum()
            slope[int(labels[i])] -= 1
            back = out @ slope
            out -= rate * np.outer(mean, slope)
            bias -= 0.1 * rate * slope
            vectors[at] -= (20 * rate) * np.outer(share, back)
    return (vectors @ (out[:, 1] - out[:, 0])).astype(np.float32), float(bias[1] - bias[0])


def training_sample(labels: DataFrame, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` labelled rows of each class, those of the least hash, of ids that may be learned from."""
    own = labels.where("doc_id IS NOT NULL AND quality IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 4 <> 2").select(
        "doc_id", "quality", F.xxhash64("doc_id").alias("order"))
    return own.where("quality = 0").orderBy("order", "doc_id").limit(size).unionByName(
        own.where("quality = 1").orderBy("order", "doc_id").limit(size)).drop("order")


def train(docs: DataFrame, labels: DataFrame, size: int = SAMPLE) -> tuple[np.ndarray, float]:
    """A classifier of ``text`` by ``quality``; the sample is bounded, so it is joined by broadcast and fitted in one task."""
    scratch = Scratch(docs.sparkSession, "quality")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows = pd.concat(batches or [pd.DataFrame(columns=["doc_id", "text", "quality"])]) if (batches := list(batches)) else \
            pd.DataFrame({"doc_id": [], "text": [], "quality": []})
        rows = rows.sort_values(["doc_id", "text"])
        texts = [t if isinstance(t, str) else "" for t in rows["text"]]
        weights, bias = fit(texts, rows["quality"].to_numpy(np.int64))
        yield pd.DataFrame({"weights": [weights.tobytes()], "bias": [bias]})

    rows = docs.select("doc_id", "text").join(F.broadcast(training_sample(labels, size)), "doc_id")
    found = scratch.store(rows, "sample").repartition(1).mapInPandas(learn, "weights binary, bias double").first()
    if found is None:
        return np.zeros(BUCKETS, np.float32), 0.0
    return np.frombuffer(found["weights"], np.float32), found["bias"]


def score(docs: DataFrame, model: tuple[np.ndarray, float]) -> DataFrame:
    """The input's columns and ``score``, the probability of label 1."""
    Scratch(docs.sparkSession, "quality")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # one number for each bucket

    @F.pandas_udf("double")
    def rate(column: pd.Series) -> pd.Series:
        (weights, bias), out = shared.value, []
        for _, texts in text_chunks(column):
            words = [t.split() for t in texts]
            lengths = np.array([len(w) for w in words])
            flat = [w for own in words for w in own]
            logit = np.full(len(texts), bias)
            if flat:
                unique, code = numbered(flat)
                bucket, word, whole = features(unique)
                mean = np.bincount(word, weights[bucket], len(unique)) / np.bincount(word, minlength=len(unique))
                pairs, of = pair_buckets(code, whole, lengths)
                doc = np.repeat(np.arange(len(texts)), lengths)
                total = np.bincount(doc, mean[code], len(texts)) + np.bincount(of, weights[pairs], len(texts))
                logit += total / np.maximum(1, lengths + np.maximum(0, lengths - 1))
            out.append(1 / (1 + np.exp(-np.clip(logit, -50, 50))))
        return pd.Series(np.concatenate(out) if out else np.zeros(0))

    return docs.withColumn("score", rate("text"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, train(docs, read_table(spark, sf_dir, "labels"))).select(
        "doc_id", F.expr("coalesce(crc32(CAST(doc_id AS STRING)) % 4 = 2, false)").alias("held_out"), "score",
        F.expr(f"CAST(score >= {KEEP} AS INT)").alias("predicted"))
