"""Row counts of the stages of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while the job that uses them runs, without a job of its own."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def match_rate(final: int, given: int) -> int:
    return final * 100 // given if given > 0 else 0


def run_summary(flow: DataFrame, segments: DataFrame, matches: DataFrame, final: DataFrame) -> DataFrame:
    """Input, static, candidate and final counts with the match rate in whole percent.

    ``matches`` are candidate pairs of distinct lines whose ``n`` says how many records share the line.
    """
    parts = [("input_count", flow.agg(F.count("*").alias("rows"))), ("static_count", segments.agg(F.count("*").alias("rows"))),
             ("candidate_count", matches.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))),
             ("final_count", final.agg(F.count("*").alias("rows")))]
    stacked = None
    for name, counts in parts:
        row = counts.select(F.lit(name).alias("stage"), "rows")
        stacked = row if stacked is None else stacked.unionAll(row)
    totals = stacked.agg(*[F.max(F.when(F.col("stage") == n, F.col("rows"))).alias(n) for n, _ in parts])
    rate = F.expr("coalesce(final_count * 100 div nullif(input_count, 0), 0)")
    return totals.withColumn("match_rate", rate)
