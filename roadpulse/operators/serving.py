"""Map queries over the stored events: latest state, time range, statistics, GeoJSON."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.functions.traffic import DEFAULT_COLOURS, classes_at_zoom
from roadpulse.operators.rows import one_row_per_key

# Zoom when none is given, and row limits.
DEFAULT_ZOOM = 13
DEFAULT_LIMIT = 200
WINDOW_LIMIT = 500
MAX_LIMIT = 5000

_EVENT_COLUMNS = ["street_id", "timestamp", "congestion_level", "speed", "jamFactor", "confidence",
                  "traversability", "freeFlowSpeed"]
_ROAD_COLUMNS = ["street_name", "highway", "oneway", "geometry"]


def usable_window(bbox: Sequence[float | None] | None) -> tuple[float, float, float, float] | None:
    """The map window in order, or None unless all four values are given."""
    if bbox is None or len(bbox) != 4 or any(v is None for v in bbox):
        return None
    return geo.envelope(*bbox)


def row_limit(requested: int | None, has_window: bool) -> int:
    base = WINDOW_LIMIT if has_window else DEFAULT_LIMIT
    return min(requested if requested and requested > 0 else base, MAX_LIMIT)


def in_window(lines: DataFrame, window: tuple[float, float, float, float], line: str = "geometry") -> DataFrame:
    """Lines that meet the window; stored box columns, where present, let the scan skip files first."""
    xmin, ymin, xmax, ymax = window
    if {"xmin", "ymin", "xmax", "ymax"} <= set(lines.columns):
        lines = lines.filter((F.col("xmin") <= xmax) & (F.col("xmax") >= xmin)
                             & (F.col("ymin") <= ymax) & (F.col("ymax") >= ymin))
    return lines.filter(geo.line_in_window(line, window))


def visible_segments(segments: DataFrame, bbox: Sequence[float | None] | None = None,
                     zoom: float | None = None) -> DataFrame:
    """Segments of the road classes shown at a zoom level, inside the map window if there is one."""
    classes = classes_at_zoom(zoom or DEFAULT_ZOOM)
    shown = segments if classes is None else segments.filter(F.col("highway").isin(classes))
    window = usable_window(bbox)
    return shown if window is None else in_window(shown, window)


def _tie_break(events: DataFrame, keys: Sequence[str]) -> list[Column]:
    if "event_id" in events.columns:
        return [F.col("event_id")]
    return [F.col(c) for c in events.columns if c not in keys]


def latest_per_street(events: DataFrame) -> DataFrame:
    """The newest event of each street; of equal times the greatest event id (or row) counts."""
    return one_row_per_key(events, ["street_id"], [F.col("timestamp"), *_tie_break(events, ["street_id", "timestamp"])], newest=True)


def with_roads(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Inner join of events that are few per street to their segments."""
    roads = segments.select(F.col("segment_id").alias("street_id"), F.col("name").alias("street_name"),
                            "highway", "oneway", "geometry")
    return events.join(roads, "street_id")


def newest_first(rows: DataFrame, limit: int) -> DataFrame:
    tie = [F.desc("event_id")] if "event_id" in rows.columns else []
    return rows.orderBy(F.desc("timestamp"), "street_id", *tie).limit(limit)


def latest_traffic(events: DataFrame, segments: DataFrame, bbox: Sequence[float | None] | None = None,
                   zoom: float | None = None, limit: int | None = None) -> DataFrame:
    """Newest state of each visible street, newest first.

    With a map window, events of other streets are left out first. Events then shrink to one per
    street before they meet the segments, so a street with a third of all events costs one row per
    task. The visible set depends on the street alone, so the order of the steps does not change the result.
    """
    window = usable_window(bbox)
    size = limit or (WINDOW_LIMIT if window else DEFAULT_LIMIT)
    shown = visible_segments(segments, bbox, zoom)
    if window is not None:
        events = events.join(shown.select(F.col("segment_id").alias("street_id")), "street_id", "left_semi")
    rows = with_roads(latest_per_street(events), shown)
    return newest_first(rows, size).select(*_EVENT_COLUMNS, *_ROAD_COLUMNS)


def in_time(events: DataFrame, start, end) -> DataFrame:
    """Events of a closed time range; both ends are needed."""
    if not start or not end:
        raise ValueError("start and end are both needed")
    return events.filter(F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def traffic_range(events: DataFrame, segments: DataFrame, start, end,
                  bbox: Sequence[float | None] | None = None, zoom: float | None = None,
                  limit: int | None = None) -> DataFrame:
    """All events of visible streets in a time range, newest first, up to the row limit.

    Events meet the visible segments first. The limit with its order is then one bounded list per task and a
    merge of those, whatever the limit; a hot street's join is left to Spark to split.
    """
    size = row_limit(limit, usable_window(bbox) is not None)
    rows = with_roads(in_time(events, start, end), visible_segments(segments, bbox, zoom))
    keep = ["event_id"] if "event_id" in events.columns else []
    return newest_first(rows, size).select(*keep, *_EVENT_COLUMNS, *_ROAD_COLUMNS)


def traffic_stats(events: DataFrame) -> DataFrame:
    return events.agg(
        F.count("*").alias("total_events"),
        F.count_distinct("street_id").alias("total_streets"),
        F.max("timestamp").alias("latest_update"),
        F.avg("speed").alias("avg_speed"),
        F.avg("jamFactor").alias("avg_jamfactor"),
    )


def speeds_descending(events: DataFrame) -> DataFrame:
    """Speeds from high to low; ties go by event, so that a common speed spreads over tasks."""
    tie = ["event_id"] if "event_id" in events.columns else ["street_id", "timestamp"]
    return events.select("speed", *tie).orderBy(F.desc("speed"), *tie).select("speed")


def orphan_streets(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Street ids without a segment, with their number of events; counted before the join."""
    known = segments.select(F.col("segment_id").alias("street_id"))
    return events.groupBy("street_id").agg(F.count("*").alias("events")).join(known, "street_id", "left_anti")


def drop_orphans(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Events whose street has a segment; segment ids are distinct, so the join repeats nothing."""
    return events.join(segments.select(F.col("segment_id").alias("street_id")), "street_id", "left_semi").select(*events.columns)


# --- labelled events, the older form of the store ---------------------------------------

def _labelled(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Few events per street with their label and line."""
    named = events.join(labels.select("street_id", "street_name"), "street_id", "left")
    return named.withColumn("geometry", F.expr(geo.from_wkt("wkt_shape")))


def latest_labelled(events: DataFrame, labels: DataFrame, bbox: Sequence[float | None] | None = None) -> DataFrame:
    """Newest state per labelled street out of events that carry their shape as text."""
    shaped = events.filter(F.col("wkt_shape").isNotNull())
    window = usable_window(bbox)
    if window is not None:
        shaped = in_window(shaped.withColumn("_line", F.expr(geo.from_wkt("wkt_shape"))), window, "_line").drop("_line")
    rows = _labelled(latest_per_street(shaped), labels)
    size = WINDOW_LIMIT if window else DEFAULT_LIMIT
    return newest_first(rows, size).select(*_EVENT_COLUMNS, "street_name", "geometry")


def labelled_range(events: DataFrame, labels: DataFrame, start, end) -> DataFrame:
    shaped = in_time(events.filter(F.col("wkt_shape").isNotNull()), start, end)
    # Every event stays in the join with labels, so the newest can be taken before it.
    rows = _labelled(newest_first(shaped, MAX_LIMIT), labels)
    keep = ["event_id"] if "event_id" in events.columns else []
    return newest_first(rows, MAX_LIMIT).select(*keep, *_EVENT_COLUMNS, "street_name", "geometry")


# --- GeoJSON ----------------------------------------------------------------------------

# Property names of a map feature and the columns they come from.
FEATURE_PROPERTIES = {
    "street_id": "street_id",
    "street_name": "street_name",
    "highway": "highway",
    "oneway": "oneway",
    "timestamp": "timestamp",
    "congestion_level": "congestion_level",
    "speed": "speed",
    "jamfactor": "jamFactor",
    "confidence": "confidence",
    "traversability": "traversability",
    "freeflowspeed": "freeFlowSpeed",
}
_JSON_OPTIONS = {"ignoreNullFields": "false", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"}


def _feature(rows: DataFrame) -> Column:
    present = [F.col(c).alias(name) for name, c in FEATURE_PROPERTIES.items() if c in rows.columns]
    return F.struct(F.lit("Feature").alias("type"), F.expr(geo.geojson_struct("geometry")).alias("geometry"),
                    F.struct(*present).alias("properties"))


def geojson_features(rows: DataFrame) -> DataFrame:
    """One GeoJSON feature text per row, for bulk output by ``write.text``."""
    return rows.select(F.to_json(_feature(rows), _JSON_OPTIONS).alias("value"))


def feature_collection(limited: DataFrame, zoom: float | None = None, bbox: Sequence[float | None] | None = None,
                       time_range: tuple[str, str] | None = None, query_limit: int | None = None,
                       colours: dict[str, str] | None = None, limit: int = MAX_LIMIT) -> DataFrame:
    """One FeatureCollection text out of the rows of a map query: the newest ``limit`` of them, ``MAX_LIMIT`` at most."""
    window = usable_window(bbox)
    limited = newest_first(limited, min(limit, MAX_LIMIT))
    # A negative time sorts newest first, as the map queries do.
    order = F.struct((-F.unix_micros("timestamp")).alias("newest"), F.col("street_id"))
    ordered = F.array_sort(F.collect_list(F.struct(order.alias("at"), _feature(limited).alias("f"))))
    collected = limited.agg(ordered.alias("items"))
    metadata = [F.size("items").alias("count"), F.lit(float(zoom or DEFAULT_ZOOM)).alias("zoom"),
                (F.array(*[F.lit(float(v)) for v in window]) if window else F.lit(None).cast("array<double>")).alias("bbox")]
    if time_range is not None:
        metadata.append(F.array(*[F.lit(str(t)) for t in time_range]).alias("time_range"))
        metadata.append(F.lit(query_limit).alias("query_limit"))
    palette = {**DEFAULT_COLOURS, **(colours or {})}
    metadata.append(F.struct(*[F.lit(v).alias(k) for k, v in palette.items()]).alias("color_config"))
    return collected.select(F.to_json(F.struct(
        F.lit("FeatureCollection").alias("type"),
        F.transform("items", lambda i: i["f"]).alias("features"),
        F.struct(*metadata).alias("metadata")), _JSON_OPTIONS).alias("value"))
