"""Personal data in texts (operator 6): patterns propose spans, validators confirm them, context moves the score.

Spans are in code points, end exclusive. The base kinds (email, ip, card, phone) are kept
whatever their score; further kinds (iban, ssn) count when their score reaches ``MIN_SCORE``.

Rows: NULL text is empty; an empty text has no spans; NULL ``doc_id`` stays NULL; equal rows give equal rows; an empty table
gives no rows; scans are linear in the text, however long its runs of letters or digits are. Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import Scratch, keep_alone, read_table, text_chunks

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn")
MIN_SCORE = 0.6
CONTEXT = 40

# The patterns of the base kinds, as the contract of the query states them.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# Further kinds.
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=[\x20]?[A-Z0-9])")
_SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")

# Characters of an account number by country.
IBAN_LENGTHS = dict(part.split(":") for part in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DK:18 DO:28 EE:20 EG:29 ES:24 "
    "FI:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 "
    "LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MR:27 MT:31 MU:30 NL:18 NO:15 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 "
    "SA:24 SC:31 SE:24 SI:19 SK:24 SM:27 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20").split())
# The rest of a number of each length, and of any length for other countries, with single spaces between.
_IBAN_REST = {n: re.compile(rf"(?:\x20?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in range(15, 35)}
_IBAN_OTHER = re.compile(r"(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")

# Score of a span that its validator accepts, and the words that raise it when near.
PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.7, "iban": 0.9, "ssn": 0.4}
CONTEXT_WORDS = {
    "email": ("mail", "e-mail", "email", "contact", "correo"),
    "ip": ("ip", "address", "host", "server", "adresse"),
    "card": ("card", "visa", "mastercard", "credit", "carte", "tarjeta", "karte"),
    "phone": ("phone", "call", "tel", "mobile", "fax", "telefon", "téléphone", "teléfono"),
    "iban": ("iban", "account", "bank", "konto", "compte", "cuenta"),
    "ssn": ("ssn", "social", "security"),
}
AGAINST = ("version", "isbn", "serial", "example")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) << (i & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    s = iban.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def ibans(text: str) -> Iterator[tuple[int, int]]:
    """Account numbers, as long as their country's are, from left to right."""
    start = _IBAN.search(text)
    while start:
        length = IBAN_LENGTHS.get(start.group()[:2])
        rest = (_IBAN_REST[int(length)] if length else _IBAN_OTHER).match(text, start.end())
        end = start.end()
        if rest and mod97(text[start.start():rest.end()]):
            end = rest.end()
            yield start.start(), end
        start = _IBAN.search(text, end)


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Addresses from left to right. Each holds one @, so the search goes from @ to @."""
    last = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            last = domain.end()
            yield start, last
        else:
            last = at + 1
        at = text.find("@", last)


def addresses(text: str) -> Iterator[tuple[int, int]]:
    """Four dotted numbers each; a longer dotted chain is taken in fours."""
    for m in _DOTTED.finditer(text):
        if m.group().count(".") < 3:
            continue
        start, parts = m.start(), m.group().split(".")
        for i in range(0, len(parts) - 3, 4):
            four = parts[i:i + 4]
            end = start + sum(map(len, four)) + 3
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in four):
                yield start, end
            start = end + 1


def digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def proposals(text: str) -> Iterator[tuple[str, int, int]]:
    """Spans whose validator accepts them, by kind and then place."""
    if "@" in text:
        yield from (("email", *s) for s in emails(text))
    yield from (("ip", *s) for s in addresses(text))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := digits(m.group())) <= 19 and luhn(d):
            yield "card", *m.span()
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(digits(m.group())) <= 15:
                yield "phone", *m.span()
    yield from (("iban", *s) for s in ibans(text))
    yield from (("ssn", *m.span()) for m in _SSN.finditer(text)
                if m.group()[:3] not in ("000", "666") and m.group()[0] != "9" and m.group()[4:6] != "00" and m.group()[7:] != "0000")


def scored(text: str) -> list[tuple[str, int, int, float]]:
    """Kept spans with scores in 0 to 1: the prior of the kind, raised or lowered by words within ``CONTEXT`` code points."""
    out = []
    for kind, start, end in proposals(text):
        near = {w.lower() for w in _WORD.findall(text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT])}
        score = PRIOR[kind] + 0.25 * any(w in near for w in CONTEXT_WORDS[kind]) - 0.25 * any(w in near for w in AGAINST)
        if kind in BASE_KINDS or score >= MIN_SCORE:
            out.append((kind, start, end, round(min(1.0, max(0.0, score)), 2)))
    return out


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,score:double>>"


def find_pii(docs: DataFrame) -> DataFrame:
    """The input's columns and ``pii``: the spans of ``text``, by kind and place."""
    Scratch(docs.sparkSession, "pii")

    @F.pandas_udf(SPAN_TYPE)
    def spans(texts: pd.Series) -> pd.Series:
        keep_alone("pii")
        return pd.Series([[{"kind": k, "start": a, "end": b, "score": s} for k, a, b, s in scored(t)]
                          for _, own in text_chunks(texts) for t in own], dtype=object)

    return docs.withColumn("pii", spans("text"))


def redact(docs: DataFrame) -> DataFrame:
    """The input with each span in ``text`` replaced by its kind in brackets; overlapping spans become one, named by the first.

    NULL texts stay NULL; ``n_chars``, if there is such a column, is counted anew. No row goes.
    """
    Scratch(docs.sparkSession, "pii")

    def clean(t: str) -> str:
        out, last = [], 0
        for kind, start, end, _ in sorted(scored(t), key=lambda s: (s[1], -s[2])):
            if start >= last:
                out += [t[last:start], f"[{kind.upper()}]"]
            last = max(last, end)
        return "".join([*out, t[last:]])

    @F.pandas_udf("string")
    def cleaned(texts: pd.Series) -> pd.Series:
        keep_alone("pii")
        return texts.map(lambda t: clean(t) if isinstance(t, str) else None)

    out = docs.withColumn("text", cleaned("text"))
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        order = {k: i for i, k in enumerate(KINDS)}
        for b in batches:
            rows = []
            for doc, spans in zip(b["doc_id"], b["pii"]):
                own = sorted(((s["kind"], s["start"], s["end"]) for s in spans), key=lambda s: (order[s[0]], s[1]))
                joined = [f"{k}:{a}:{e}" for k, a, e in own]
                base = ",".join(j for j, s in zip(joined, own) if s[0] in BASE_KINDS)
                kinds = [s[0] for s in own]
                rows.append((doc, *(kinds.count(k) for k in BASE_KINDS), hashlib.sha256(base.encode()).hexdigest(),
                             ",".join(joined), kinds.count("iban"), max((s["score"] for s in spans), default=0.0)))
            yield pd.DataFrame(rows, columns=["doc_id", *(f"n_{k}" for k in BASE_KINDS), "base_sha256", "spans", "n_iban",
                                              "top_score"]).astype({"doc_id": "Int64"})

    return find_pii(docs).select("doc_id", "pii").mapInPandas(
        digest, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, "
                "n_iban long, top_score double")
