"""Rows that are hard to handle, and plain helpers for brute-force comparisons."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ("rid", "item", "keys", "k", "v", "score", "pii", "_rid", "_label", "kept", "place")


def sentence(rng: random.Random, n: int, words: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def hard_rows() -> list[tuple]:
    rng = random.Random(5)
    base = sentence(rng, 120)
    words = base.split()
    near = " ".join([*words[:60], "other", *words[61:]])
    texts = [None, "", "   \n\t ", "one", "one two three four", base, base, near, sentence(rng, 80), sentence(rng, 30_000, 200_000),
             "The The " * 200, "été naïve ß İstanbul   漢字 かな 한국어 русский текст", "a\n" * 50, "…!?\x1c\x85", "mail a.b@c.example.org now"]
    rows = [(i if i != 8 else None, t, "en" if i % 2 else "fr", f"src{i % 3}", None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[5], rows[0], (5, texts[7], None, None, None)]  # an equal row, an equal NULL text, an id used twice
    return rows


def frame(spark, rows, extra: bool = False):
    df = spark.createDataFrame(rows, SCHEMA).coalesce(3)
    if extra:
        for c in CLASHING:
            from pyspark.sql import functions as F

            df = df.withColumn(c, F.lit("clash"))
    return df


def stored(spark, df, tmp_path, name="docs"):
    """As a table on disk, as the operators find their input."""
    df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
    return spark.read.parquet(f"{tmp_path}/{name}.parquet")


def word_list(text: str | None) -> list[str]:
    return [w.decode("utf-8", "surrogatepass") for w in (text or "").encode("utf-8", "surrogatepass").split()]


def shingle_set(text: str | None, size: int = 5) -> frozenset:
    w = word_list(text)
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def jaccard(a: frozenset, b: frozenset) -> float:
    return len(a & b) / len(a | b) if a or b else 0.0


class Sets:
    """Components by union of linked pairs."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        while self.up[i] != i:
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = sorted((self.find(i), self.find(j)))
        self.up[b] = a
