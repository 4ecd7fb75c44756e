"""Quality rules (operator 10): a threshold table compiled into one projection, without user functions.

Words are runs of other than ASCII white space. Rows: NULL text has no words and an empty one neither, so both
fail; NULL ``doc_id`` stays NULL; equal rows give equal rows; an empty table gives no rows; very long texts cost
a sort of their own words. Extra columns are kept, unless they have the name of a result
column, which then wins, or a name that begins with ``_r_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.llm.common import read_table

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = r"[#*$%&|<>]"

# Frequent short words of English, German, French and Spanish.
STOP_WORDS = ("a and are as at be by for from have in is it of on or that the this to was with "
              "auf das dem den der des die ein eine für im ist mit nicht sich und von zu "
              "au avec ce dans du en est et la le les ne par pas pour qui que sur un une "
              "con de del el las los no para por se su y").split()

# Name, measure, least and most. A text passes when each measure lies within its bounds.
THRESHOLDS: tuple[tuple[str, str, float | None, float | None], ...] = (
    ("short_or_long", "n_words", 50, 1_000_000),
    ("word_length", "mean_word_chars", 2.0, 14.0),
    ("symbols", "symbol_ratio", None, 0.05),
    ("exclamations", "exclamation_ratio", None, 0.2),
    ("stop_words", "stop_ratio", 0.02, None),
    ("duplicate_lines", "dup_line_ratio", None, 0.3),
    ("repeated_words", "repeat_ratio", None, 0.5),
)


def _ratio(part: str, whole: str) -> Column:
    return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(F.lit(0.0))


def measures(docs: DataFrame) -> DataFrame:
    """The input with counts and ratios of ``text``.

    A repeated word is one that lies in a run of three words found at least twice in the text. Runs are compared by 64-bit
    hash: sorting (hash, place) brings equal runs together, and the places of those with an equal
    neighbour, sorted again, tell how many words they cover.
    """
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    split = (docs.withColumn("_r_text", F.coalesce(F.col("text"), F.lit("")))
             .withColumn("_r_words", F.expr(rf"filter(split(_r_text, r'{SPACE}+'), x -> x <> '')"))
             .withColumn("_r_lines", F.expr(rf"filter(split(_r_text, '\n'), x -> x rlike r'[^\x20\x09-\x0D]')"))
             .withColumn("n_words", F.size("_r_words").cast("long")))
    counted = (split
               .withColumn("word_chars", F.length(F.array_join("_r_words", "")).cast("long"))
               .withColumn("n_symbols", F.regexp_count("_r_text", F.lit(SYMBOLS)).cast("long"))
               .withColumn("n_exclamations", F.regexp_count("_r_text", F.lit("!")).cast("long"))
               .withColumn("n_stop", F.expr(f"size(filter(_r_words, x -> lower(x) IN ({stop})))").cast("long"))
               .withColumn("n_lines", F.size("_r_lines").cast("long"))
               .withColumn("n_dup_lines", (F.size("_r_lines") - F.size(F.array_distinct("_r_lines"))).cast("long"))
               .withColumn("_r_runs", F.expr(
                   "CASE WHEN n_words < 3 THEN array() ELSE sort_array(transform(sequence(0, size(_r_words) - 3), "
                   "i -> struct(xxhash64(_r_words[i], _r_words[i + 1], _r_words[i + 2]) AS h, i AS i))) END"))
               .withColumn("_r_same", F.expr(
                   "sort_array(transform(filter(sequence(0, size(_r_runs)), j -> j < size(_r_runs) AND ("
                   "(j > 0 AND _r_runs[greatest(j - 1, 0)].h = _r_runs[j].h) OR "
                   "(j < size(_r_runs) - 1 AND _r_runs[least(j + 1, size(_r_runs) - 1)].h = _r_runs[j].h))), j -> _r_runs[j].i))"))
               .withColumn("n_repeat_words", F.expr(
                   "CASE WHEN size(_r_same) = 0 THEN 0L ELSE aggregate(sequence(0, size(_r_same) - 1), 3L, "
                   "(n, k) -> n + CASE WHEN k = 0 THEN 0 ELSE least(3, _r_same[k] - _r_same[greatest(k - 1, 0)]) END) END")))
    return (counted.drop("_r_text", "_r_words", "_r_lines", "_r_runs", "_r_same")
            .withColumn("mean_word_chars", _ratio("word_chars", "n_words"))
            .withColumn("symbol_ratio", _ratio("n_symbols", "word_chars"))
            .withColumn("exclamation_ratio", _ratio("n_exclamations", "n_words"))
            .withColumn("stop_ratio", _ratio("n_stop", "n_words"))
            .withColumn("dup_line_ratio", _ratio("n_dup_lines", "n_lines"))
            .withColumn("repeat_ratio", _ratio("n_repeat_words", "n_words")))


def broken_rules(thresholds=THRESHOLDS) -> Column:
    """Names of the rules that a row of ``measures`` breaks, comma-joined in the table's order."""
    def broken(measure: str, least: float | None, most: float | None) -> Column:
        out = F.lit(False)
        if least is not None:
            out = out | (F.col(measure) < least)
        if most is not None:
            out = out | (F.col(measure) > most)
        return out

    return F.concat_ws(",", *(F.when(broken(m, a, b), F.lit(name)) for name, m, a, b in thresholds))


def judge(docs: DataFrame, thresholds=THRESHOLDS) -> DataFrame:
    """``measures`` with ``base_failed``, ``broken`` (rule names) and ``kept``."""
    return (measures(docs)
            .withColumn("base_failed", F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words"))
            .withColumn("broken", broken_rules(thresholds))
            .withColumn("kept", ~F.col("base_failed") & (F.col("broken") == "")))


def op10_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(read_table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "broken")


def op10_sql() -> str:
    """The same in DuckDB's SQL, by joins and windows over unnested words instead of arrays."""
    stop = ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS)))
    ratio = {"mean_word_chars": "word_chars / n_words", "symbol_ratio": "n_symbols / word_chars",
             "exclamation_ratio": "n_exclamations / n_words", "stop_ratio": "n_stop / n_words",
             "dup_line_ratio": "n_dup_lines / n_lines", "repeat_ratio": "n_repeat_words / n_words"}
    ratios = ",\n".join(f"CASE WHEN {e.split(' / ')[1]} > 0 THEN CAST({e.split(' / ')[0]} AS DOUBLE) / {e.split(' / ')[1]} ELSE 0.0 END AS {n}"
                        for n, e in ratio.items())
    broken = ", ".join(
        "CASE WHEN " + " OR ".join([f"{m} < {a}"] * (a is not None) + [f"{m} > {b}"] * (b is not None)) + f" THEN '{n}' END"
        for n, m, a, b in THRESHOLDS)
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
g AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS run FROM (
      SELECT rid, ws, unnest(generate_series(1, len(ws) - 2)) AS i FROM w)),
m AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, run) AS n FROM g) WHERE n > 1),
r AS (SELECT rid, count(DISTINCT p) AS n_repeat_words FROM (
      SELECT rid, i AS p FROM m UNION ALL SELECT rid, i + 1 FROM m UNION ALL SELECT rid, i + 2 FROM m) GROUP BY rid),
c AS (SELECT doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars,
      length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
      length(t) - length(replace(t, '!', '')) AS n_exclamations,
      len(list_filter(ws, lambda x: lower(x) IN ({stop}))) AS n_stop,
      len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
      coalesce(n_repeat_words, 0) AS n_repeat_words FROM w LEFT JOIN r USING (rid)),
q AS (SELECT *, {ratios} FROM c),
v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed, concat_ws(',', {broken}) AS broken FROM q)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND broken = '' AS kept, broken FROM v"""
