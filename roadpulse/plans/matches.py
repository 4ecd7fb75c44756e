"""Stored matches of traffic lines: a line goes through the spatial join once for each version of the segments.

Below the table's path lies a folder for each version, named by the content of the segments and the settings of the
join. It has the lines that were looked at (128-bit key and points) and the pairs that were found, both by run. A run writes its pairs first
and its lines last, and pairs count only for lines of the same run, so a run that breaks off is not seen. Of two runs that
looked at the same line at one time the first by name counts.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.operators import matching
from roadpulse.session import cut_lineage
from roadpulse.sources.deliveries import names_in


def segments_version(segments: DataFrame, buffer_deg: float, candidate: str) -> str:
    """A text that differs when any segment, or a setting that changes pairs, does; the order of rows does not matter."""
    keys = [F.xxhash64(F.lit(seed), "segment_id", "azimuth", "geometry").cast("decimal(38,0)") for seed in (1, 2)]
    row = segments.agg(F.count("*").alias("n"), *[F.coalesce(F.sum(k), F.lit(0)).alias(f"s{i}") for i, k in enumerate(keys)])
    return row.select(F.md5(F.concat_ws("|", "n", "s0", "s1", F.lit(repr(buffer_deg)), F.lit(candidate)))).first()[0]


def _table(lines: DataFrame, path: str) -> DataFrame | None:
    spark = lines.sparkSession
    if not any(n.startswith("run=") for n in names_in(spark, path)):
        return None
    return spark.read.option("basePath", path).parquet(path).withColumn("run", F.col("run").cast("string"))


def stored_metrics(lines: DataFrame, segments: DataFrame, path: str, buffer_deg: float = matching.BUFFER_DEGREES,
                   candidate: str = "intersects", **grid) -> DataFrame:
    """``match_metrics`` of ``lines`` (line_key, line), where only lines that the table does not know go through the join."""
    base = f"{path}/version={segments_version(segments, buffer_deg, candidate)}"
    known = _table(lines, f"{base}/lines")
    fresh = lines if known is None else cut_lineage(lines.join(known.select("line_key"), "line_key", "left_anti"))
    if not fresh.isEmpty():
        run = uuid.uuid4().hex
        found = matching.match_metrics(fresh, segments, "line_key", buffer_deg, candidate, **grid)
        found.write.parquet(f"{base}/pairs/run={run}")
        fresh.select("line_key", "line").write.parquet(f"{base}/lines/run={run}")
        known = _table(lines, f"{base}/lines")
    if known is None:
        return matching.match_metrics(lines, segments, "line_key", buffer_deg, candidate, **grid)
    valid = known.join(lines.select("line_key"), "line_key", "left_semi").groupBy("line_key").agg(F.min("run").alias("run"))
    return _table(lines, f"{base}/pairs").join(valid, ["line_key", "run"], "left_semi").drop("run")
