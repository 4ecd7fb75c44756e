"""Traffic tables derived by Spark from the given ``events`` and ``part`` tables.

The texts run unchanged on Spark and on DuckDB, so a query and its check start from the
same rows. Coordinates are whole micro-degrees until the last step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo

ROAD_EDGES_RAW = """
SELECT u, v, osmid, name, oneway, highway, maxspeed, lanes, x1, y1,
       CASE WHEN horiz THEN x1 + len_u ELSE x1 END AS x2,
       CASE WHEN horiz THEN y1 ELSE y1 + len_u END AS y2
FROM (
  SELECT p_partkey AS u,
         CASE WHEN p_partkey % 50 = 0 THEN p_partkey ELSE p_partkey + 1 END AS v,
         CAST(CAST((p_partkey - p_partkey % 3) / 3 AS BIGINT) AS STRING) AS osmid,
         p_brand AS name,
         p_size % 2 = 0 AS oneway,
         CASE p_size % 8 WHEN 0 THEN 'motorway' WHEN 1 THEN 'trunk' WHEN 2 THEN 'primary'
              WHEN 3 THEN 'primary_link' WHEN 4 THEN 'secondary' WHEN 5 THEN 'tertiary'
              WHEN 6 THEN 'residential' ELSE 'unclassified' END AS highway,
         CASE p_size % 7 WHEN 0 THEN '50' WHEN 1 THEN '[''40'', ''60'']' WHEN 2 THEN 'nan'
              WHEN 3 THEN '' WHEN 4 THEN '60 mph' WHEN 5 THEN '[''40'', ''x'']' END AS maxspeed,
         CAST(1 + p_size % 4 AS STRING) AS lanes,
         p_partkey % 2 = 0 AS horiz,
         CAST(105800000 + (p_partkey % 40) * 2000 AS BIGINT) AS x1,
         CAST(21000000 + CAST((p_partkey - p_partkey % 40) / 40 AS BIGINT) * 2000 AS BIGINT) AS y1,
         CAST(2000 * (1 + p_size % 3) AS BIGINT) AS len_u
  FROM (SELECT * FROM part UNION ALL SELECT * FROM part WHERE p_partkey % 10 = 0) p
) r
"""

FLOW_RAW = """
SELECT e.event_id AS result_id,
       date_trunc('hour', e.ts) AS source_updated,
       CASE WHEN e.event_id % 97 = 0 THEN NULL ELSE CONCAT('street_', CAST(e.user_id % 20 AS STRING)) END AS street_name,
       CASE WHEN e.event_id % 41 = 0 THEN 0.0E0 ELSE CAST(50 + e.event_id % 200 AS DOUBLE) END AS traverse_length,
       CASE WHEN e.event_id % 37 = 0 THEN NULL WHEN e.event_id % 43 = 0 THEN 0.0E0
            ELSE CAST(1 + e.event_id % 18 AS DOUBLE) END AS speed,
       CASE WHEN e.event_id % 53 = 0 THEN 0.0E0 WHEN e.event_id % 59 = 0 THEN NULL
            ELSE CAST(5 + e.user_id % 15 AS DOUBLE) END AS free_flow,
       CASE WHEN e.event_id % 4 = 0 THEN NULL ELSE CAST(e.event_id % 101 AS DOUBLE) / 10 END AS jam_factor,
       CASE WHEN e.event_id % 61 = 0 THEN NULL ELSE CAST(50 + e.event_id % 51 AS DOUBLE) / 100 END AS confidence,
       CASE e.event_type WHEN 'error' THEN 'closed' WHEN 'view' THEN NULL ELSE 'open' END AS traversability,
       CASE WHEN e.event_id % 7 = 0 THEN r.x2 - 200 ELSE r.x1 + 200 END + CASE WHEN r.horiz THEN 0 ELSE -250 END AS ax,
       CASE WHEN e.event_id % 7 = 0 THEN r.x1 + 200 ELSE r.x2 - 200 END + CASE WHEN r.horiz THEN 0 ELSE 250 END AS bx,
       CASE WHEN e.event_id % 7 = 0 THEN r.y2 - 200 ELSE r.y1 + 200 END + CASE WHEN r.horiz THEN -250 ELSE 0 END AS ay,
       CASE WHEN e.event_id % 7 = 0 THEN r.y1 + 200 ELSE r.y2 - 200 END + CASE WHEN r.horiz THEN 250 ELSE 0 END AS by_
FROM events e
JOIN (SELECT DISTINCT u, x1, y1, x2, y2, y1 = y2 AS horiz FROM road_edges_raw) r ON e.user_id = r.u
"""

TRAFFIC_EVENTS_FX = """
SELECT e.event_id, CONCAT(r.osmid, '_', CAST(f.result_id % 8 AS STRING)) AS street_id, e.ts AS ts,
       f.speed * 3.6E0 AS speed, f.jam_factor, f.confidence, f.traversability, f.free_flow,
       CASE WHEN f.jam_factor >= 7 THEN 'High' WHEN f.jam_factor >= 4 THEN 'Medium' ELSE 'Low' END AS congestion_level
FROM events e JOIN flow_raw f ON f.result_id = e.event_id
JOIN (SELECT DISTINCT u, osmid FROM road_edges_raw) r ON r.u = e.user_id
"""

STREET_LABELS_FX = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY street_name) AS BIGINT) AS street_id, street_name
FROM (SELECT DISTINCT CONCAT('street_', CAST(user_id % 20 AS STRING)) AS street_name FROM events WHERE user_id % 20 < 12) x
"""

# Roads of three pieces: loops, bends, and straight ones that reach into the next.
BENT_ROADS_FX = """
SELECT u, CASE WHEN u % 5 IN (1, 2) THEN CAST(u - u % 5 AS BIGINT) ELSE u END AS way, bx AS x0, b_y AS y0,
       bx + CASE u % 5 WHEN 0 THEN 600 WHEN 1 THEN 500 WHEN 2 THEN 300 ELSE 700 END AS x1,
       b_y + CASE WHEN u % 5 IN (0, 1, 2) THEN 0 ELSE 300 END AS y1,
       bx + CASE u % 5 WHEN 0 THEN 300 WHEN 1 THEN 1500 WHEN 2 THEN 900 ELSE 1400 END AS x2,
       b_y + CASE u % 5 WHEN 0 THEN 500 WHEN 1 THEN 0 WHEN 2 THEN 0 ELSE -200 END AS y2,
       bx + CASE u % 5 WHEN 0 THEN 0 WHEN 1 THEN 2400 WHEN 2 THEN 1500 ELSE 2100 END AS x3,
       b_y + CASE WHEN u % 5 IN (0, 1, 2) THEN 0 ELSE 100 END AS y3
FROM (SELECT DISTINCT u, x1 AS bx, y1 AS b_y FROM road_edges_raw) r
"""

# Traffic lines of two pieces about those roads, one for each road and shift.
BENT_FLOW_FX = """
SELECT DISTINCT r.u * 7 + e.event_id % 7 AS result_id, r.x0 - 100 AS x0, r.y0 - 60 + 10 * (e.event_id % 7) AS y0,
       r.x0 + 800 AS x1, r.y0 + 260 - 10 * (e.event_id % 7) AS y1, r.x0 + 1700 AS x2, r.y0 - 80 AS y2
FROM events e JOIN bent_roads_fx r ON e.user_id = r.u
"""

CTES = {
    "road_edges_raw": ROAD_EDGES_RAW,
    "flow_raw": FLOW_RAW,
    "traffic_events_fx": TRAFFIC_EVENTS_FX,
    "street_labels_fx": STREET_LABELS_FX,
    "bent_roads_fx": BENT_ROADS_FX,
    "bent_flow_fx": BENT_FLOW_FX,
}


def with_ctes(*names: str) -> str:
    """``WITH`` text of the named fixtures, in order of need."""
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in names)


def _run(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    text = with_ctes(*names) + f"\nSELECT * FROM {names[-1]}"
    for table in ("events", "part"):
        text = text.replace(f"FROM {table} ", f"FROM {{{table}}} ")
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("events", "part") if f"{{{t}}}" in text}
    return spark.sql(text, **tables)


def _degrees(*columns: str) -> list[str]:
    return [f"{c} / 1e6D" for c in columns]


def road_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw edges with self-loops and copies, and a line geometry."""
    raw = _run(spark, sf_dir, "road_edges_raw")
    return raw.select("osmid", "u", "v", "name", "oneway", "highway", "maxspeed", "lanes",
                      F.expr(geo.two_point_line(*_degrees("x1", "y1", "x2", "y2"))).alias("geometry"))


def flow_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat uncleaned flow under the feed's column names, with ``result_id`` and a two-point ``line``."""
    raw = _run(spark, sf_dir, "road_edges_raw", "flow_raw")
    return raw.select(
        "result_id", F.col("source_updated").cast("timestamp").alias("timestamp"), "street_name", "traverse_length",
        "speed", F.col("jam_factor").alias("jamFactor"), "confidence", "traversability",
        F.col("free_flow").alias("freeFlowSpeed"),
        F.expr(geo.two_point_line(*_degrees("ax", "ay", "bx", "by_"))).alias("line"))


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested snapshots as the feed gives them: one per hour, each line in two links that share a point."""
    raw = _run(spark, sf_dir, "road_edges_raw", "flow_raw")
    ax, ay, bx, by = _degrees("ax", "ay", "bx", "by_")
    mx, my = "(ax + bx) / 2e6D", "(ay + by_) / 2e6D"

    def link(x1: str, y1: str, x2: str, y2: str) -> str:
        return (f"named_struct('points', array(named_struct('lat', {y1}, 'lng', {x1}), named_struct('lat', {y2}, 'lng', {x2})), "
                "'length', traverse_length / 2, 'functionalClass', '3')")

    links = F.expr(f"array({link(ax, ay, mx, my)}, {link(mx, my, bx, by)})")
    location = F.struct(F.col("street_name").alias("description"), F.col("traverse_length").alias("length"),
                        F.struct(links.alias("links")).alias("shape"))
    flow = F.struct("speed", F.col("speed").alias("speedUncapped"), F.col("free_flow").alias("freeFlow"),
                    F.col("jam_factor").alias("jamFactor"), "confidence", "traversability")
    item = F.struct(location.alias("location"), flow.alias("currentFlow"))
    return (raw.groupBy(F.col("source_updated").cast("timestamp").alias("sourceUpdated"))
            .agg(F.collect_list(item).alias("results")))


def _bent_line(points: int) -> str:
    return "array(" + ", ".join(geo.point(f"x{i} / 1e6D", f"y{i} / 1e6D") for i in range(points)) + ")"


def bent_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of three pieces each; neighbours on one line have one way id."""
    raw = _run(spark, sf_dir, "road_edges_raw", "bent_roads_fx")
    return raw.select(F.col("way").cast("string").alias("osmid"), "u", (F.col("u") + 1).alias("v"), F.lit("bent").alias("name"),
                      F.lit(False).alias("oneway"), F.lit("primary").alias("highway"), F.lit("50").alias("maxspeed"), F.lit("1").alias("lanes"),
                      F.expr(_bent_line(4)).alias("geometry"))


def bent_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole bent edges as segments, named by u."""
    return bent_edges(spark, sf_dir).select(F.col("u").cast("string").alias("segment_id"), "osmid",
                                            F.expr(geo.bearing("geometry")).alias("azimuth"), "geometry")


def bent_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _run(spark, sf_dir, "road_edges_raw", "bent_roads_fx", "bent_flow_fx")
    return raw.select("result_id", F.expr(_bent_line(3)).alias("line"))


def traffic_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored events over many hours; some street ids have no segment."""
    raw = _run(spark, sf_dir, "road_edges_raw", "flow_raw", "traffic_events_fx")
    return raw.select(
        "event_id", "street_id", F.col("ts").cast("timestamp").alias("timestamp"), "speed",
        F.col("jam_factor").alias("jamFactor"), "confidence", "traversability",
        (F.col("free_flow") * 3.6).alias("freeFlowSpeed"), "congestion_level")


def street_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, "street_labels_fx")
