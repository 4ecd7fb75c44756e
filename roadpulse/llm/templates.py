"""Benchmark decontamination by templates (operator 1).

Texts become template tokens: lower-case words, and the placeholders for numbers, units after numbers, and names. Windows
of tokens meet by hash; matched windows of one alignment form a run, and a run counts when its slots are consistent:
each value of the benchmark item stands for one value of the document throughout, whether or not it is the same value. An item's capitalised
first word is a word in one set of windows and a name in another, as it may stand inside a sentence. Templates need words:
items of fewer than ``MIN_TOKENS`` template tokens, and windows with less than ``WORD_SHARE`` words, have none. So every item
of any length is also looked for as it stands, by a hash of all its tokens (words, numbers and signs, in lower case); with other values such items are not found.

Rows: NULL and empty texts on either side match nothing; NULL ids stay NULL; repeated items and documents are reported each; an empty table on either side gives
no rows; long texts are cut into windows whole. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import MIX_A, MIX_B, Scratch, fresh, keep_alone, mixed, read_table, signed, text_chunks

WINDOW = 8
MIN_TOKENS = 5
# Share of a window's tokens that must be words, and of an item's windows that consistent runs must cover.
WORD_SHARE, COVERAGE = 0.6, 0.5
SALTS = 16
FILTER_BITS = 23
# Tokens of an item's beginning, by which its places are found before the whole is hashed.
PREFIX = 8

# Unit words that are slots when they follow a number.
UNITS = frozenset((
    "mm cm m km in ft yd mi mg g kg t lb lbs oz ml cl l gal s sec secs ms min mins h hr hrs day days week weeks month months "
    "year years second seconds minute minutes hour hours meter meters metre metres kilometer kilometers kilometre kilometres "
    "mile miles foot feet inch inches gram grams kilogram kilograms pound pounds ounce ounces liter liters litre litres "
    "percent euro euros dollar dollars cent cents usd eur gbp mph kmh kph kw kwh w v a hz khz mhz ghz kb mb gb tb").split())

_tokens = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*|\d+(?:[.,]\d+)*|[^\w\s]|_|\n").findall
# Characters of texts that are worked on at once.
CHUNK = 1 << 19
_ENDS = frozenset(".!?:\n")
_SIGNS = frozenset("%$€£°")
WORD, NUM, UNIT, NAME, END, UNIT_WORD, OTHER = range(7)
# What characters make: ``_tokens`` cuts at their borders, but for marks inside words and numbers.
SPACE, LETTER, DIGIT, SIGN, LINE = range(1, 6)
_INSIDE = {"'": LETTER, "’": LETTER, ".": DIGIT, ",": DIGIT}
# The one letter that has two characters in lower case; ``MARK``, a number beyond all characters, follows it for the second.
_DOTTED, MARK = "İ", 0x110000
# A capital among letters that are counted.
_CAPITAL = 1 << 32


def _class(token: str) -> int:
    """What a token is by itself; a unit word is a unit and a capitalised word a name only in some places."""
    if token in _ENDS:
        return END
    if token[0].isdigit():
        return NUM
    if token in _SIGNS:
        return UNIT
    if not token[0].isalpha():
        return OTHER
    if token.lower() in UNITS:
        return UNIT_WORD
    return NAME if len(token) > 1 and token[0].isupper() and token[1:].islower() else WORD


def _values(codes: list[int]) -> np.ndarray:
    return mixed(np.array(codes, np.uint64) * MIX_A + MIX_B)


class Characters:
    """What characters are, told when one first occurs; one for a worker. ``part`` is 0 for those not told yet."""

    own: Characters | None = None

    def __init__(self):
        self.part, self.kind, self.inside = (np.zeros(MARK + 1, np.int8) for _ in range(3))
        self.low, self.case = np.zeros(MARK + 1, np.uint64), np.zeros(MARK + 1, np.int64)
        self.part[MARK], self.low[MARK] = SIGN, _values([0x307])[0]
        self.units = np.zeros(0, np.uint64)

    @classmethod
    def of_worker(cls) -> Characters:
        keep_alone("templates", cls.forget)
        if cls.own is None:
            cls.own = cls()
            cls.own.units = np.sort(Tokens(sorted(UNITS)).h)
        return cls.own

    @classmethod
    def forget(cls) -> None:
        cls.own = None

    def parts(self, codes: np.ndarray) -> np.ndarray:
        part = self.part[codes]
        if part.all():
            return part
        new = np.unique(codes[part == 0])
        self.low[new] = _values([ord(chr(c).lower()[0]) for c in new.tolist()])
        for c in new.tolist():
            t = chr(c)
            kind = _class(t)
            self.part[c] = LINE if t == "\n" else SPACE if t.isspace() else DIGIT if t.isdecimal() else LETTER if t.isalnum() else SIGN
            self.kind[c], self.inside[c] = WORD if kind == UNIT_WORD else kind, _INSIDE.get(t, 0)
            self.case[c] = _CAPITAL if t.isupper() else 2 * _CAPITAL if t.istitle() else int(t.islower())
        return self.part[codes]


class Vocabulary:
    """The texts of tokens by their numbers, cut out when asked for."""

    forget = Characters.forget

    def __init__(self, codes: np.ndarray, first: np.ndarray, after: np.ndarray):
        self.codes, self.first, self.after, self.tokens = codes, first, after, self

    def __getitem__(self, number: int) -> str:
        own = self.codes[self.first[number]:self.after[number]]
        return own[own != MARK].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


def _joined(codes: np.ndarray, first: np.ndarray, after: np.ndarray, part: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """Whether each part is of one token with the part before: around an apostrophe inside a word, a point or comma inside a number, or MARK."""
    out, marks = np.zeros(len(first), bool), np.flatnonzero(codes[first] == MARK)
    part = part.copy()
    part[marks] = LETTER
    at = np.flatnonzero(inside[1:-1]) + 1
    at = at[(part[at - 1] == inside[at]) & (part[at + 1] == inside[at]) & (after[at - 1] == first[at]) & (after[at] == first[at + 1])]
    out[at] = out[at + 1] = out[marks] = True
    marks = marks[marks < len(first) - 1]
    out[marks[(part[marks + 1] == LETTER) & (after[marks] == first[marks + 1])] + 1] = True
    return out


class Tokens:
    """Tokens of several texts, as ``_tokens`` cuts them: number (``code``), ``text`` (number of the text), ``kind`` (what each is by itself) and ``h``
    (hash in lower case); ``part_text`` and ``part_h`` of the smallest parts (words, numbers and signs). All texts are cut at once, along their
    characters, as most words of a corpus are rare: looking them up costs more than working them out.
    """

    def __init__(self, texts: list[str]):
        own, line = Characters.of_worker(), " ".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        codes = np.frombuffer(line.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
        if _DOTTED in line:
            codes = np.insert(codes, np.flatnonzero(codes == ord(_DOTTED)) + 1, MARK)
            sizes += np.array([t.count(_DOTTED) for t in texts])
        starts = np.cumsum(sizes + 1) - sizes - 1
        part = own.parts(codes)
        first = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (part[1:] >= SIGN)]) if len(codes) else np.zeros(0, np.int64)
        after = np.r_[first[1:], len(codes)][:len(first)]
        used = part[first] != SPACE
        first, after = first[used], after[used]
        part = part[first]
        heads = np.flatnonzero(~_joined(codes, first, after, part, own.inside[codes[first]]))
        ends = np.r_[heads[1:], len(first)][:len(heads)] - 1
        begin, stop = first[heads], after[ends]
        low = own.low[codes]
        if "Σ" in line:
            self._sigmas(codes, begin, stop, low)
        powers, back = np.full(len(codes), MIX_A), np.full(len(codes), np.uint64(pow(int(MIX_A), -1, 1 << 64)))
        powers[:1] = back[:1] = 1
        back = np.cumprod(back, dtype=np.uint64)
        sums = np.r_[np.uint64(0), np.cumsum(low * np.cumprod(powers, dtype=np.uint64), dtype=np.uint64)]

        def hashes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return mixed((sums[b] - sums[a]) * back[a] + (b - a).astype(np.uint64) * MIX_B)

        def texts_of(places: np.ndarray) -> np.ndarray:
            return np.repeat(np.arange(len(texts)), np.diff(np.r_[np.searchsorted(places, starts), len(places)]))

        h = hashes(first, after)
        self.count, self.code, self.text = len(texts), np.arange(len(heads)), texts_of(begin)
        self.vocabulary = Vocabulary(codes, begin, stop)
        self.h, several = h[heads], ends > heads
        self.h[several] = hashes(begin[several], stop[several])
        shown = part != LINE
        self.part_h, self.part_text = h[shown], texts_of(first[shown])
        self.kind = own.kind[codes[begin]]
        words = np.flatnonzero(self.kind == WORD)
        cased = np.r_[0, np.cumsum(own.case[codes])]
        rest = cased[stop[words]] - cased[begin[words] + 1]
        self.kind[words[(own.case[codes[begin[words]]] == _CAPITAL) & (rest > 0) & (rest < _CAPITAL)]] = NAME
        if len(own.units):
            near = np.searchsorted(own.units, self.h[words]).clip(max=len(own.units) - 1)
            self.kind[words[own.units[near] == self.h[words]]] = UNIT_WORD

    @staticmethod
    def _sigmas(codes: np.ndarray, begin: np.ndarray, stop: np.ndarray, low: np.ndarray) -> None:
        """The lower case of this letter depends on its place in a word."""
        at = np.flatnonzero(codes == ord("Σ"))
        for token in np.unique(np.searchsorted(begin, at, "right") - 1).tolist():
            own = codes[begin[token]:stop[token]]
            word = "".join([chr(c) if c != MARK else "\u0307" for c in own.tolist()]).replace(_DOTTED, "I").lower()
            places = np.flatnonzero(own == ord("Σ"))
            low[begin[token] + places] = _values([ord(word[i]) for i in places.tolist()])


class Templates:
    """Template tokens of several texts: ``kind``, ``h`` (hash of the lower-case word, or of the slot's kind), ``text`` (number of the text).

    A capitalised word is a name unless a sentence or the text starts with it; names that follow each other are one slot.
    """

    def __init__(self, tokens: Tokens, inside: bool = False):
        """``inside``: the texts' first words stand inside sentences."""
        used = tokens.kind != OTHER
        code, kind, text = tokens.code[used], tokens.kind[used], tokens.text[used]
        self.names, self.code = tokens.vocabulary.tokens, code
        first = np.r_[True, text[1:] != text[:-1]] if len(text) else np.zeros(0, bool)
        before = np.where(first, WORD if inside else END, np.r_[kind[:1], kind[:-1]])
        kind = np.where((kind == NAME) & (before == END), WORD, kind)
        kind = np.where(kind == UNIT_WORD, np.where(before == NUM, UNIT, WORD), kind)
        previous = np.where(first, END, np.r_[kind[:1], kind[:-1]])
        kept = (kind != END) & ~((kind == NAME) & (previous == NAME))
        self.at = np.flatnonzero(kept)
        self.kind, self.text = kind[self.at], text[self.at]
        self.h = mixed(np.where(self.kind == WORD, tokens.h[code[self.at]], self.kind.astype(np.uint64)))
        self.all_kinds = kind

    def value(self, i: int) -> str:
        """The text of a slot."""
        end = self.at[i] + 1
        if self.kind[i] == NAME:
            stop = self.at[i + 1] if i + 1 < len(self.at) else len(self.code)
            while end < stop and self.all_kinds[end] == NAME:
                end += 1
        return " ".join([self.names[c] for c in self.code[self.at[i]:end].tolist()])

    def windows(self, width: int) -> tuple[np.ndarray, np.ndarray]:
        """First token and hash of each window of ``width`` tokens of one text that has enough words."""
        n = len(self.h) - width + 1
        if n <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        words = np.r_[0, np.cumsum(self.kind == WORD)]
        g = np.full(n, width, np.uint64)
        for k in range(width):
            g = g * MIX_A + self.h[k:n + k]
        at = np.flatnonzero((words[width:] - words[:n] >= WORD_SHARE * width) & (self.text[:n] == self.text[width - 1:]))
        return at, mixed(g[at])


def _rows(name: str, tokens: Tokens, idents: np.ndarray, widths: list[int] | None, bits: np.ndarray | None,
          inside: bool = False) -> pd.DataFrame:
    """Windows of texts, of the given widths or, for items, of the usual one or as long as a shorter item."""
    found, out = Templates(tokens, inside), []
    starts = np.searchsorted(found.text, np.arange(tokens.count + 1))
    lengths = np.diff(starts)
    for width in widths or sorted({min(WINDOW, n) for n in lengths.tolist() if n >= MIN_TOKENS}):
        at, h = found.windows(width)
        total = np.zeros(tokens.count, np.int64)
        if bits is not None:
            hit = passes(bits, h)
            at, h = at[hit], h[hit]
        fit = lengths[found.text[at]] >= MIN_TOKENS
        if widths is None:
            fit &= np.minimum(WINDOW, lengths[found.text[at]]) == width
            total = np.bincount(found.text[at[fit]], minlength=tokens.count)
        at, h = at[fit], h[fit]
        for i, k in zip(at.tolist(), signed(h).tolist()):
            slots = [found.value(j) for j in range(i, i + width) if found.kind[j] != WORD]
            t = found.text[i]
            out.append((idents[t], i - starts[t], k, total[t], width, slots))
    return pd.DataFrame(out, columns=[name, "place", "h", "total", "width", "slots"])


def item_windows(items: DataFrame, inside: bool = False) -> DataFrame:
    """Windows of benchmark items: item_row, place, h, total, width, slots. Short items are one window.

    ``inside``: also windows of items inside a sentence, if these differ, under ``-1 - item_row``.
    """
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in text_chunks(b["text"], CHUNK):
                ids = b["item_row"].iloc[part].to_numpy()
                yield _rows("item_row", Tokens(texts), ids, None, None)
                named = [i for i, t in enumerate(texts) if _class(next((w for w in _tokens(t) if _class(w) != OTHER), ".")) == NAME]
                if inside and named:
                    yield _rows("item_row", Tokens([texts[i] for i in named]), -1 - ids[named], None, None, True)

    return items.select("item_row", "text").mapInPandas(
        cut, "item_row long, place long, h long, total long, width int, slots array<string>")


def hash_filter(own: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bitmap of fixed size, two bits a hash. Only words of the bitmap are collected, 2**(bits-6) at most."""
    size = 1 << bits
    at = own.select(F.explode(F.array(F.expr(f"pmod(h, {size})"), F.expr(f"pmod(shiftright(h, 32), {size})"))).alias("bit"))
    words = at.groupBy(F.shiftright("bit", 6).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("bits")).toPandas()
    out = np.zeros(size >> 6, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def passes(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    size = np.int64(len(bitmap) << 6)
    ok = np.ones(len(h), bool)
    for bit in (signed(h) % size, (signed(h) >> np.int64(32)) % size):
        ok &= (bitmap[bit >> 6] >> (bit & 63).astype(np.uint64)) & np.uint64(1) == 1
    return ok


class Runs:
    """Hashes of runs of the smallest parts of tokens, with the values kept. Equal runs have one hash wherever they stand."""

    def __init__(self, tokens: Tokens):
        h, self.text = tokens.part_h, tokens.part_text
        self.lengths = np.bincount(self.text, minlength=tokens.count)
        self.starts = np.cumsum(self.lengths) - self.lengths
        base, inverse = np.full(len(h), MIX_A), np.full(len(h), np.uint64(pow(int(MIX_A), -1, 1 << 64)))
        base[:1] = inverse[:1] = 1
        self.back = np.cumprod(inverse, dtype=np.uint64)
        self.sums = np.r_[np.uint64(0), np.cumsum(mixed(h) * np.cumprod(base, dtype=np.uint64), dtype=np.uint64)]
        self.left = np.repeat(self.starts + self.lengths, self.lengths) - np.arange(len(h))

    def at(self, places: np.ndarray, width) -> np.ndarray:
        return mixed((self.sums[places + width] - self.sums[places]) * self.back[places] + np.asarray(width).astype(np.uint64) * MIX_B)


def item_runs(numbered: DataFrame) -> DataFrame:
    """item_row, h (hash of the whole item as it stands), n (its parts), prefix (hash of its beginning)."""
    def whole(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for part, texts in text_chunks(b["text"], CHUNK):
                own = Runs(Tokens(texts))
                full = np.flatnonzero(own.lengths)
                n, at = own.lengths[full], own.starts[full]
                yield pd.DataFrame({"item_row": b["item_row"].iloc[part].to_numpy()[full], "h": signed(own.at(at, n)), "n": n,
                                    "prefix": signed(own.at(at, np.minimum(PREFIX, n)))})

    return numbered.select("item_row", "text").mapInPandas(whole, "item_row long, h long, n long, prefix long")


def _copies(tokens: Tokens, ids: np.ndarray, starts: np.ndarray, wholes: np.ndarray, lengths: list[int]) -> pd.DataFrame:
    """rid, h and n of the runs of texts that may be a whole item."""
    own, out = Runs(tokens), []
    for width in sorted({min(PREFIX, n) for n in lengths}):
        begun = np.flatnonzero(own.left >= width)
        begun = begun[passes(starts, own.at(begun, width))]
        for n in lengths:
            if min(PREFIX, n) == width:
                at = begun[own.left[begun] >= n]
                h = own.at(at, n)
                hit = passes(wholes, h)
                out.append(pd.DataFrame({"rid": ids[own.text[at[hit]]], "h": signed(h[hit]), "n": n}))
    return pd.concat(out).drop_duplicates() if out else pd.DataFrame({"rid": [], "h": [], "n": []}, dtype=np.int64)


def contamination(docs: DataFrame, items: DataFrame, coverage: float = COVERAGE, whole: bool = False) -> DataFrame:
    """One row (rid, doc_id, item_id, n_windows, coverage, exact) for each document and benchmark item it holds.

    ``exact``: all matched slots have the item's own values. Document windows are first put through a bitmap of the items'
    window hashes, whose size does not grow; what passes is joined by hash, salted since a passage may be in any share of the documents.
    ``whole``: also items inside a sentence, and items that only stand there word by word, with ``n_windows`` 0 and ``coverage`` 1.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "templates")
    numbered = scratch.store(items.select(F.monotonically_increasing_id().alias("item_row"), F.col("item_id").cast("long"), "text"), "items")
    theirs = scratch.store(item_windows(numbered, whole), "item-windows")
    runs_of = scratch.store(item_runs(numbered), "item-runs") if whole else None
    shared = spark.sparkContext.broadcast((
        hash_filter(theirs), sorted(r[0] for r in theirs.select("width").distinct().collect()),
        *((hash_filter(runs_of.select(F.col("prefix").alias("h"))), hash_filter(runs_of),
           sorted(r[0] for r in runs_of.select("n").distinct().collect())) if whole else (None, None, []))))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits, widths, starts, wholes, lengths = shared.value
        for b in batches:
            for part, texts in text_chunks(b["text"], CHUNK):
                tokens, ids = Tokens(texts), b["rid"].iloc[part].to_numpy()
                if widths:
                    yield _rows("rid", tokens, ids, widths, bits).assign(n=pd.Series(dtype="Int64"))
                if lengths:
                    hit = _copies(tokens, ids, starts, wholes, lengths)
                    yield hit.assign(place=pd.Series(dtype="Int64"), total=pd.Series(dtype="Int64"), width=pd.Series(dtype="Int64"),
                                     slots=None)[["rid", "place", "h", "total", "width", "slots", "n"]]

    # One reading of the documents for both: windows of templates, and runs that may be a whole item (those have n).
    seen = scratch.store(docs.select(F.monotonically_increasing_id().alias("rid"), "text").mapInPandas(
        cut, "rid long, place long, h long, total long, width int, slots array<string>, n long").withColumn(
        "salt", F.expr(f"CAST(pmod(rid, {SALTS}) AS INT)")), "seen")
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    own = seen.where("n IS NULL").select("rid", F.col("place").alias("doc_place"), "h", "width", F.col("slots").alias("doc_slots"), "salt")
    pairs = own.join(theirs.withColumn("salt", salts), ["h", "width", "salt"]).where(
        "size(doc_slots) = size(slots)")
    runs = pairs.groupBy("rid", "item_row", (F.col("doc_place") - F.col("place")).alias("shift")).agg(
        F.collect_set("place").alias("places"), F.max("total").alias("total"),
        F.array_distinct(F.flatten(F.collect_list(F.arrays_zip(F.col("slots").alias("a"), F.col("doc_slots").alias("b"))))).alias("values"))
    good = runs.where("size(values) = size(array_distinct(transform(values, v -> v.a)))")
    found = good.groupBy("rid", "item_row").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_windows"), F.max("total").alias("total"),
        F.min(F.expr("forall(values, v -> v.a = v.b)")).alias("exact"))
    found = scratch.store(found.withColumn("coverage", F.col("n_windows") / F.col("total")).where(F.col("coverage") >= coverage), "found")
    if whole:
        # An item's own windows count before those inside a sentence, and these before the item as it stands.
        copies = seen.where("n IS NOT NULL").select("rid", "h", "n", "salt").join(
            runs_of.withColumn("salt", salts), ["h", "n", "salt"]).select("rid", "item_row").distinct()
        found = found.select("rid", F.expr("if(item_row < 0, -1 - item_row, item_row)").alias("item_row"), F.expr(
            "struct(if(item_row < 0, 1, 0) AS path, n_windows, coverage, exact)").alias("own")).unionByName(
            copies.withColumn("own", F.expr(
                "struct(2 AS path, 0L AS n_windows, CAST(1 AS DOUBLE) AS coverage, true AS exact)"))).groupBy("rid", "item_row").agg(
            F.min("own").alias("own")).select("rid", "item_row", "own.n_windows", "own.coverage", "own.exact")
    named = found.join(numbered.drop("text"), "item_row")
    return named.join(docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long")), "rid").select(
        "rid", "doc_id", "item_id", "n_windows", "coverage", "exact")


def clean_of(docs: DataFrame, items: DataFrame, whole: bool = False) -> DataFrame:
    """The documents that hold no benchmark item; ``whole`` as in ``contamination``."""
    rid = fresh(docs, "rid")
    hit = Scratch(docs.sparkSession, "templates").store(contamination(docs, items, whole=whole).select(F.col("rid").alias(rid)).distinct(), "hits")
    return docs.withColumn(rid, F.monotonically_increasing_id()).join(hit, rid, "left_anti").select(*docs.columns)


def op1_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), whole=True).drop("rid")
