"""The stored-table jobs: roads once in a while, traffic with every snapshot."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions.text import snapshot_key
from roadpulse.model import ROAD_NETWORK, ROAD_SEGMENTS, TRAFFIC_EVENTS, conform
from roadpulse.operators import clean, labels, matching, roads, summary
from roadpulse.plans import matches
from roadpulse.session import cut_lineage
from roadpulse.sources import deliveries, tables
from roadpulse.sources.snapshots import distinct_deliveries, newest_rows, read_snapshots, with_location
from roadpulse.sources.tables import Jdbc


def _store(df: DataFrame, target: str | Jdbc, schema: str, keep_table: bool = True) -> None:
    """Full refresh of a table in either store."""
    if isinstance(target, Jdbc):
        tables.write_jdbc(df, target, "overwrite", keep_table)
    else:
        tables.write_parquet(df, target, schema=schema)


def _by_snapshot(df: DataFrame) -> DataFrame:
    return df.withColumns({"day": F.to_date("timestamp"), "snapshot": snapshot_key(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))})


def clean_traffic(spark: SparkSession, raw_path: str, silver_path: str,
                  min_confidence: float = clean.MIN_CONFIDENCE) -> DataFrame:
    """Raw snapshots to stored clean flow: of each time and place the rows of the newest delivery.

    A delivery is a payload by content. Areas of one time stay beside each other, as their places differ; a payload that comes again
    changes nothing; one that restates a place replaces what was known of it, also where its rows are now filtered out.
    """
    flat = flatten_deliveries(read_snapshots(spark, raw_path, arrival=True))
    return store_flow(cut_lineage(newest_rows(flat)), silver_path, min_confidence)


def flatten_deliveries(given: DataFrame) -> DataFrame:
    """Flat rows of distinct deliveries with the keys of delivery and place."""
    return with_location(clean.flatten_snapshots(distinct_deliveries(given)))


def store_flow(flat: DataFrame, silver_path: str, min_confidence: float = clean.MIN_CONFIDENCE) -> DataFrame:
    """Cleans flat rows and adds them to the stored flow, where they replace what their times and places had; returns the stored flow."""
    key = snapshot_key(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
    rows = clean.clean_flow(flat, min_confidence).withColumn("snapshot", key).drop("arrived")
    return deliveries.write(rows, flat, silver_path)


def process_roads(spark: SparkSession, edges_path: str, network: str | Jdbc, segments: str | Jdbc,
                  chunk_m: float = 100.0, id_scope: str = "osmid") -> dict[str, int]:
    """Raw edges to the stored road network and segments; returns row counts, chunks that shared an id and so were dropped,
    and edges without a usable line.

    Both tables are refreshed whole. The distinct edges feed two writes, so they are kept.
    """
    edges = cut_lineage(roads.with_line(roads.distinct_edges(tables.read_table(spark, edges_path))), ("osmid", "u", "v"))
    net, net_rows = summary.counted(roads.build_road_network(edges), "road_network")
    _store(net, network, ROAD_NETWORK)
    cut = roads.build_road_segments(edges, chunk_m, id_scope)
    if isinstance(segments, Jdbc):
        cut, cut_rows = summary.counted(cut, "road_segments")
        _store(cut, segments, ROAD_SEGMENTS)
        count = cut_rows.get["rows"]
    else:
        # Range partitioning looks at its input once more, which an observed count would add
        # up; the count of the stored files comes from their footers.
        count = tables.write_segments(cut, segments).count()
    report = roads.edge_report(edges, chunk_m).first()
    return {"road_network": net_rows.get["rows"], "road_segments": count, "dropped_chunks": report["chunks"] - count,
            "edges_without_line": report["edges_without_line"]}


def _store_events(final: DataFrame, given: DataFrame, target: str | Jdbc) -> None:
    """Events by snapshot; a snapshot of ``given`` (timestamps) that has none now loses those it had."""
    if isinstance(target, Jdbc):
        tables.write_jdbc(final, target, "append", stamp=True)
        return
    # Only snapshots that match nothing any more are named here, one row each.
    for row in _by_snapshot(given.join(final.select("timestamp").distinct(), "timestamp", "left_anti")).toLocalIterator():
        tables.drop_partition(final.sparkSession, target, {"day": row["day"], "snapshot": row["snapshot"]})
    shaped = _by_snapshot(conform(final, TRAFFIC_EVENTS))
    dealt = shaped.repartition("day", "snapshot", F.pmod(F.xxhash64("street_id"), F.lit(4)))
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day", "snapshot").parquet(target)


def process_traffic(spark: SparkSession, silver_path: str, segments: str | Jdbc, events: str | Jdbc | Sequence[str | Jdbc],
                    snapshot: str | None = None, segment_scan: dict | None = None, max_angle: float = matching.MAX_ANGLE,
                    min_overlap_m: float = matching.MIN_OVERLAP_M, speed_agg: str = "avg", match_table: str | None = None,
                    **grid) -> dict[str, float]:
    """Stored clean flow and segments to stored traffic events, in one target or several; returns counts and overlap lengths.

    Takes one snapshot, or all of the folder at once; either way each snapshot has its own
    events, in its own partition, so a repeated run replaces them. Time ranges thus see the
    history, and the latest state is a query. ``segment_scan`` has the column, bounds and number of partitions of
    a database scan. With ``match_table``, a folder, lines that an earlier run has matched with the same segments
    are not matched again. Warns when no candidate pair is found.
    """
    stored = deliveries.read(spark, silver_path)
    if snapshot is not None:
        stored = stored.filter(F.col("snapshot") == snapshot)
    roads_in = tables.load_segments(spark, segments, **(segment_scan or {}))
    if isinstance(segments, Jdbc):
        # Read by several steps below; one pass over the database.
        roads_in = cut_lineage(roads_in)
    if match_table is None:
        measures, metrics = matching.snapshot_matches(stored, roads_in, **grid)
    else:
        measures, shapes = matching.snapshot_lines(stored)
        metrics = matches.stored_metrics(shapes, roads_in, match_table, **grid)
    metrics = cut_lineage(metrics)
    final = cut_lineage(matching.snapshot_events(measures, matching.apply_rules(metrics, max_angle, min_overlap_m), speed_agg))
    for target in [events] if isinstance(events, (str, Jdbc)) else events:
        _store_events(final, stored.select("timestamp").distinct(), target)
    found = matching.overlap_stats(metrics, F.count("*").alias("candidate_count")).first().asDict()
    if not found["candidate_count"]:
        warnings.warn("no traffic line meets a road segment", stacklevel=2)
    given, count = stored.count(), final.count()
    return {"input_count": given, "static_count": roads_in.count(), "final_count": count,
            "match_rate": summary.match_rate(count, given), **found}


def label_traffic(spark: SparkSession, silver_path: str, label_table: str | Jdbc, events: str | Jdbc | Sequence[str | Jdbc],
                  labelled_path: str | None = None) -> None:
    """The older job: give street names ids, and store the flow keyed by them with its shape as text, in one target or several.

    New labels are appended, so a run that breaks off leaves the known ones. ``labelled_path`` also keeps the labelled flow itself.
    """
    flow = deliveries.read(spark, silver_path).drop("location", "delivery", "snapshot", "day")
    known = tables.read_table(spark, label_table)
    extended = cut_lineage(labels.extend_labels(flow, known))
    fresh = extended.join(known.select("street_name"), "street_name", "left_anti").select("street_id", "street_name")
    if isinstance(label_table, Jdbc):
        tables.write_jdbc(fresh, label_table, "append")
    else:
        fresh.write.mode("append").parquet(label_table)
    levelled = flow.withColumn("congestion_level", matching.congestion_level(F.col("jamFactor")))
    attached = cut_lineage(labels.attach_labels(levelled, extended))
    if labelled_path is not None:
        tables.write_parquet(attached, labelled_path)
    for target in [events] if isinstance(events, (str, Jdbc)) else events:
        if isinstance(target, Jdbc):
            tables.write_jdbc(labels.labelled_events(attached), target, "append")
        else:
            tables.write_parquet(labels.labelled_events(attached), target)
