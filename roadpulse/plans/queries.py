"""Named queries over the derived traffic tables, one per operator or job.

Each takes the session and the folder of the given tables and returns a DataFrame. Lengths
are rounded to 4 places, angles to 6 and degrees to 7, so that engines can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.functions import text, traffic
from roadpulse.operators import clean, gold, labels, matching, quality, roads, serving, spatial, style, summary
from roadpulse.plans import fixtures as fx
from roadpulse.session import cut_lineage
from roadpulse.sources.snapshots import distinct_deliveries, land_key, newest_rows, with_location

Query = Callable[[SparkSession, str], DataFrame]

# Map window and time range of the serving queries.
WINDOW = (105.805, 21.002, 105.845, 21.05)
ZOOM = 13
START, END = "2024-01-10 00:00:00", "2024-01-20 12:00:00"

_QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _flow(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_flow(fx.flow_raw(spark, sf))


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    return roads.build_road_segments(fx.road_edges(spark, sf))


def _stored_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments written out once, as the matching jobs find them, since spatial joins read them twice."""
    return cut_lineage(_segments(spark, sf), ("segment_id",))


def _stored_lines(spark: SparkSession, sf: str) -> DataFrame:
    return cut_lineage(fx.flow_raw(spark, sf).select("result_id", "line"), ("result_id",))


def _at(line: str, index: int, axis: str, name: str) -> Column:
    return F.round(F.expr(f"{line}[{index}].{axis}"), 7).alias(name)


def _ends(line: str = "geometry") -> list[Column]:
    return [F.round(F.expr(f"{end(line)}.{axis}"), 7).alias(f"{name}_{axis}")
            for name, end in (("start", geo.start_point), ("end", geo.end_point)) for axis in "xy"]


# --- snapshots and flow -------------------------------------------------------------------

@query
def flow_flatten(spark, sf):
    flat = clean.flatten_snapshots(fx.snapshots(spark, sf))
    return flat.withColumn("links", F.size("links").cast("bigint"))


@query
def clean_flow(spark, sf):
    return _flow(spark, sf).drop("line").withColumn("jamFactor", F.round("jamFactor", 9))


@query
def clean_flow_named(spark, sf):
    flow = clean.clean_flow(fx.flow_raw(spark, sf), min_confidence=0.9, require_name=True)
    return flow.groupBy("street_name").agg(F.count("*").alias("n"), F.round(F.avg("jamFactor"), 6).alias("avg_jam"))


@query
def jam_impute(spark, sf):
    flow = fx.flow_raw(spark, sf).filter(F.col("jamFactor").isNull())
    return flow.select("result_id", F.round(traffic.implied_jam(F.col("speed"), F.col("freeFlowSpeed")), 9).alias("jam"))


@query
def congestion_level(spark, sf):
    flow = fx.flow_raw(spark, sf)
    return flow.select("result_id", "jamFactor", traffic.congestion_level(F.col("jamFactor")).alias("level"),
                       F.round(traffic.kmh(F.col("speed")), 6).alias("speed_kmh"))


@query
def snapshot_key(spark, sf):
    flow = fx.flow_raw(spark, sf)
    return (flow.groupBy("timestamp").agg(F.count("*").alias("results"))
            .select(land_key(F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss")).alias("snapshot"), "results"))


@query
def snapshot_deliveries(spark, sf):
    """Each time delivered in two areas, and all of it twice: areas stay beside each other, repeats count once."""
    sure = "coalesce(r.currentFlow.confidence >= 0.8D, false)"
    east, west = (fx.snapshots(spark, sf).withColumn("results", F.expr(f"filter(results, r -> {test})")).filter("size(results) > 0")
                  for test in (sure, f"not {sure}"))
    areas = east.unionAll(west)
    flow = clean.clean_flow(distinct_deliveries(areas.unionAll(areas)))
    return flow.groupBy("timestamp").agg(F.count("*").alias("n"), F.count_distinct("delivery").alias("deliveries"))


@query
def restated_delivery(spark, sf):
    """Every third hour's surer places come again with another speed, and an older copy of all comes in between: the newest counts."""
    flat = clean.flatten_snapshots(fx.snapshots(spark, sf))
    again = flat.filter("hour(timestamp) % 3 = 0 and confidence >= 0.8").withColumn("speed", F.col("speed") + 1)
    arrivals = [(flat, "first", 1), (again, "again", 3), (flat, "older", 0)]
    come = [df.withColumns({"delivery": F.lit(name), "arrived": F.timestamp_seconds(F.lit(at))}) for df, name, at in arrivals]
    newest = newest_rows(with_location(come[0].unionAll(come[1]).unionAll(come[2])))
    return clean.clean_flow(newest).groupBy("timestamp").agg(
        F.count("*").alias("n"), F.round(F.sum("speed"), 6).alias("speeds"), F.count_if(F.col("delivery") == "again").alias("restated"))


@query
def polyline_wkt(spark, sf):
    lines = matching.with_flow_line(clean.flatten_snapshots(fx.snapshots(spark, sf)))
    return lines.select(F.expr(geo.to_wkt("line")).alias("wkt")).groupBy("wkt").agg(F.count("*").alias("n"))


@query
def polyline_points(spark, sf):
    lines = matching.with_flow_line(clean.flatten_snapshots(fx.snapshots(spark, sf)))
    return (lines.select(F.size("line").cast("bigint").alias("points"), *[_at("line", i, a, f"{a}{i}") for i in range(3) for a in "xy"])
            .groupBy("points", "x0", "y0", "x1", "y1", "x2", "y2").agg(F.count("*").alias("n")))


# --- roads --------------------------------------------------------------------------------

@query
def normalise_edges(spark, sf):
    raw = fx.road_edges(spark, sf)
    listed = raw.withColumn("name", F.array("name", "highway")).withColumn("extra", F.lit(1)).withColumn("osmid", F.array(F.col("u"), F.col("v")))
    return roads.normalise_edges(listed).select("osmid", "u", "v", "name", "oneway", "highway", "maxspeed", "lanes")


@query
def edge_dedup(spark, sf):
    return roads.distinct_edges(fx.road_edges(spark, sf)).select("osmid", "u", "v", "name", "highway", *_ends())


@query
def speed_limit_clean(spark, sf):
    return fx.road_edges(spark, sf).select("u", "v", "maxspeed", text.clean_speed_limit(F.col("maxspeed")).alias("speed_limit"))


@query
def list_text_items(spark, sf):
    items = text.list_text_items(F.col("maxspeed"))
    return fx.road_edges(spark, sf).select("u", "v", F.array_join(items, "|").alias("items"), F.when(items.isNotNull(), F.size(items)).cast("bigint").alias("n"))


@query
def edge_metrics(spark, sf):
    net = roads.build_road_network(fx.road_edges(spark, sf))
    return net.select("u", "v", "osmid", "name", "oneway", "highway", "speed_limit", "lanes",
                      F.round("length", 4).alias("length"), F.round("azimuth", 6).alias("azimuth"))


@query
def segment_plan(spark, sf):
    plan = roads.chunk_plan(roads.distinct_edges(fx.road_edges(spark, sf)))
    return plan.select("osmid", "u", "v", F.col("chunks").cast("bigint").alias("chunks"), F.col("chunk").cast("bigint").alias("chunk"),
                       F.round("begin_at", 9).alias("begin_at"), F.round("end_at", 9).alias("end_at"))


@query
def segment_split(spark, sf):
    return _segments(spark, sf).select(
        "segment_id", "osmid", "u", "v", "name", "oneway", "highway", "speed_limit", "lanes",
        F.round("azimuth", 6).alias("azimuth"), F.round("length", 4).alias("length"), *_ends())


@query
def segment_split_by_edge(spark, sf):
    segments = roads.build_road_segments(fx.road_edges(spark, sf), chunk_m=250.0, id_scope="edge")
    return segments.groupBy("osmid", "u", "v").agg(F.count("*").alias("pieces"), F.round(F.sum("length"), 3).alias("total"))


@query
def geometry_round_trip(spark, sf):
    """Lines through WKB, hex WKB, WKT and GeoJSON and back, and with flipped axes."""
    lines = fx.road_edges(spark, sf).select("u", "geometry")
    coded = lines.select("u", geo.to_wkb("geometry").alias("wkb"), geo.to_hex_wkb("geometry").alias("hex"),
                         F.expr(geo.to_wkt("geometry")).alias("wkt"), F.expr(geo.to_geojson("geometry")).alias("json"),
                         F.expr(geo.flip_coordinates("geometry")).alias("flip"))
    back = coded.select("u", geo.from_wkb("wkb").alias("a"), geo.from_hex_wkb("hex").alias("b"), F.expr(geo.from_wkt("wkt")).alias("c"),
                        F.expr(geo.from_geojson("json")).alias("d"), F.expr(geo.flip_coordinates("flip")).alias("e"), "flip")
    same = F.expr("a = b and a = c and a = d and a = e")
    return back.select("u", *_ends("a"), _at("flip", 0, "x", "flip_x"), same.alias("same"))


# --- matching -----------------------------------------------------------------------------

@query
def spatial_candidates(spark, sf):
    return spatial.intersecting_lines(_stored_lines(spark, sf), _stored_segments(spark, sf),
                                      "result_id", "segment_id", left_line="line")


@query
def match_metrics(spark, sf):
    metrics = matching.match_metrics(_stored_lines(spark, sf), _stored_segments(spark, sf), "result_id")
    return metrics.select("result_id", "segment_id", F.round("angle_diff", 6).alias("angle_diff"),
                          F.round("overlap_length", 4).alias("overlap_length"))


@query
def overlap_stats(spark, sf):
    metrics = matching.match_metrics(_stored_lines(spark, sf), _stored_segments(spark, sf), "result_id")
    stats = matching.overlap_stats(metrics)
    return stats.select(*[F.round(c, 4).alias(c) for c in stats.columns])


def _rounded_events(events: DataFrame) -> DataFrame:
    return events.withColumns({c: F.round(c, 6) for c in ("speed", "freeFlowSpeed", "jamFactor")})


@query
def map_match(spark, sf):
    return _rounded_events(matching.match_traffic(_flow(spark, sf), _stored_segments(spark, sf)))


@query
def map_match_buffer(spark, sf):
    return _rounded_events(matching.match_traffic(_flow(spark, sf), _stored_segments(spark, sf), candidate="buffer",
                                                  speed_agg="min", min_overlap_m=40.0))


@query
def map_match_snapshots(spark, sf):
    return _rounded_events(matching.match_snapshots(_flow(spark, sf), _stored_segments(spark, sf)))


@query
def segment_rollup(spark, sf):
    segments = _stored_segments(spark, sf)
    rolled = matching.roll_up_segments(matching.apply_rules(matching.line_matches(_flow(spark, sf), segments)))
    return matching.with_road(rolled, segments).select(
        "segment_id", F.col("n").alias("records"), "timestamp", "traversability", "traverse_length", "street_name", "oneway",
        F.round("segment_length", 4).alias("segment_length"), F.round("speed", 6).alias("speed"))


@query
def run_summary(spark, sf):
    flow, segments = _flow(spark, sf), _stored_segments(spark, sf)
    matches = cut_lineage(matching.line_matches(flow, segments))
    final = matching.roll_up_segments(matching.apply_rules(matches))
    return summary.run_summary(flow, segments, matches, final)


# --- bent and closed lines ----------------------------------------------------------------

@query
def bent_split(spark, sf):
    segments = roads.build_road_segments(fx.bent_edges(spark, sf), chunk_m=60.0, id_scope="edge")
    return segments.groupBy("u").agg(F.count("*").alias("pieces"), F.round(F.sum("length"), 3).alias("total"))


@query
def bent_candidates(spark, sf):
    return spatial.intersecting_lines(cut_lineage(fx.bent_lines(spark, sf)), cut_lineage(fx.bent_segments(spark, sf)),
                                      "result_id", "segment_id", left_line="line")


def _bent_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return matching.match_metrics(cut_lineage(fx.bent_lines(spark, sf)), cut_lineage(fx.bent_segments(spark, sf)), "result_id")


@query
def bent_metrics(spark, sf):
    return _bent_metrics(spark, sf).select("result_id", "segment_id", F.round("angle_diff", 6).alias("angle_diff"),
                                           F.round("overlap_length", 4).alias("overlap_length"))


@query
def bent_match(spark, sf):
    """Matches per road by the rules; closed roads have some."""
    kept = matching.apply_rules(_bent_metrics(spark, sf), min_overlap_m=20.0)
    return kept.groupBy("segment_id").agg(F.count("*").alias("n"), F.round(F.sum("overlap_length"), 3).alias("metres"))


@query
def bent_same_way(spark, sf):
    """Pairs of roads of one way that share a stretch."""
    pairs = quality.segment_overlaps(cut_lineage(fx.bent_segments(spark, sf)), same_way=True)
    return pairs.filter("kind in ('overlaps', 'other')").select("segment_id_1", "segment_id_2")


# --- labels -------------------------------------------------------------------------------

@query
def new_streets(spark, sf):
    return labels.new_streets(_flow(spark, sf), fx.street_labels(spark, sf))


@query
def extend_labels(spark, sf):
    return labels.extend_labels(_flow(spark, sf), fx.street_labels(spark, sf))


@query
def label_join(spark, sf):
    return labels.attach_labels(_flow(spark, sf), fx.street_labels(spark, sf)).select("result_id", "street_name", "street_id")


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    _, labelled = labels.label_streets(_flow(spark, sf), fx.street_labels(spark, sf))
    return labels.labelled_events(labelled)


@query
def labelled_events(spark, sf):
    events = _labelled(spark, sf)
    return events.groupBy("street_id", "congestion_level", "traversability").agg(
        F.count("*").alias("n"), F.count("wkt_shape").alias("shapes"), F.max("timestamp").alias("latest"),
        F.round(F.sum("speed"), 4).alias("speed"), F.round(F.sum("jamFactor"), 4).alias("jam"))


# --- serving ------------------------------------------------------------------------------

def _shown(rows: DataFrame) -> DataFrame:
    rounded = {c: F.round(c, 6) for c in ("speed", "freeFlowSpeed") if c in rows.columns}
    return rows.withColumns(rounded).select("*", *_ends()).drop("geometry")


@query
def latest_per_street(spark, sf):
    return _rounded_events(serving.latest_per_street(fx.traffic_events(spark, sf)))


@query
def latest_bbox_zoom(spark, sf):
    return _shown(serving.latest_traffic(fx.traffic_events(spark, sf), _segments(spark, sf), WINDOW, ZOOM))


@query
def latest_no_bbox(spark, sf):
    return _shown(serving.latest_traffic(fx.traffic_events(spark, sf), _segments(spark, sf), None, 17))


@query
def range_query(spark, sf):
    return _shown(serving.traffic_range(fx.traffic_events(spark, sf), _segments(spark, sf), START, END, WINDOW, 15, limit=4000))


@query
def range_far_zoom(spark, sf):
    return _shown(serving.traffic_range(fx.traffic_events(spark, sf), _segments(spark, sf), START, END, None, 11))


@query
def segments_in_window(spark, sf):
    return serving.visible_segments(_segments(spark, sf), WINDOW, 16).select("segment_id", "highway")


@query
def traffic_stats(spark, sf):
    stats = serving.traffic_stats(fx.traffic_events(spark, sf))
    return stats.withColumns({c: F.round(c, 6) for c in ("avg_speed", "avg_jamfactor")})


@query
def speeds_descending(spark, sf):
    return serving.speeds_descending(fx.traffic_events(spark, sf)).withColumn("speed", F.round("speed", 6))


@query
def orphans(spark, sf):
    return serving.orphan_streets(fx.traffic_events(spark, sf), _segments(spark, sf))


@query
def events_with_segment(spark, sf):
    return serving.drop_orphans(fx.traffic_events(spark, sf), _segments(spark, sf)).select("event_id", "street_id")


def _shaped_events(spark: SparkSession, sf: str) -> DataFrame:
    """Older events: label id, shape as text; events of unlabelled streets keep a NULL id."""
    labelled = labels.attach_labels(_flow(spark, sf), fx.street_labels(spark, sf))
    levelled = labelled.withColumn("congestion_level", traffic.congestion_level(F.col("jamFactor")))
    return labels.labelled_events(levelled)


@query
def latest_labelled(spark, sf):
    rows = serving.latest_labelled(_shaped_events(spark, sf), fx.street_labels(spark, sf), WINDOW)
    return rows.select("street_id", "street_name", "timestamp")


@query
def labelled_range(spark, sf):
    rows = serving.labelled_range(_shaped_events(spark, sf), fx.street_labels(spark, sf), START, END)
    return rows.groupBy("street_name").agg(F.count("*").alias("n"), F.max("timestamp").alias("latest"))


@query
def geojson_features(spark, sf):
    """The feature texts read back to typed columns."""
    rows = serving.latest_per_street(fx.traffic_events(spark, sf))
    texts = serving.geojson_features(serving.with_roads(rows, _segments(spark, sf)))
    back = texts.select(F.from_json("value", _FEATURE).alias("f"))
    p = "f.properties."
    ends = [F.round(F.expr(f"element_at(f.geometry.coordinates, {at})[{i}]"), 7).alias(f"{name}_{axis}")
            for name, at in (("start", 1), ("end", -1)) for i, axis in enumerate("xy")]
    return back.select("f.type", *[f"{p}{c}" for c in ("street_id", "street_name", "highway", "oneway", "congestion_level", "confidence",
                                                      "traversability")],
                       *[F.round(f"{p}{c}", 6).alias(c) for c in ("speed", "jamfactor", "freeflowspeed")], *ends)


_FEATURE = ("type string, geometry struct<type: string, coordinates: array<array<double>>>, properties struct<street_id: string, "
            "street_name: string, highway: string, oneway: boolean, timestamp: string, congestion_level: string, speed: double, "
            "jamfactor: double, confidence: double, traversability: string, freeflowspeed: double>")


@query
def feature_collection(spark, sf):
    """The collection text read back: its metadata, and its features in order."""
    rows = serving.latest_traffic(fx.traffic_events(spark, sf), _segments(spark, sf), WINDOW, ZOOM)
    feature = "struct<" + _FEATURE.replace("type string, geometry struct", "type: string, geometry: struct").replace(", properties struct", ", properties: struct") + ">"
    schema = (f"type string, features array<{feature}>, metadata struct<count: bigint, zoom: double, bbox: array<double>, "
              "color_config: map<string, string>>")
    back = serving.feature_collection(rows, ZOOM, WINDOW).select(F.from_json("value", schema).alias("c"))
    return back.select("c.type", "c.metadata.count", "c.metadata.zoom", *[F.expr(f"c.metadata.bbox[{i}]").alias(n) for i, n in enumerate(("xmin", "ymin", "xmax", "ymax"))],
                       F.expr("cardinality(c.metadata.color_config)").cast("bigint").alias("colours"),
                       F.expr("array_join(transform(c.features, f -> f.properties.street_id), ',')").alias("streets"))


@query
def feature_properties(spark, sf):
    """The GeoJSON text read back: what a client sees."""
    rows = serving.latest_per_street(fx.traffic_events(spark, sf))
    value = serving.geojson_features(serving.with_roads(rows, _segments(spark, sf)))
    got = {c: F.get_json_object("value", f"$.properties.{c}") for c in ("street_id", "street_name", "highway", "congestion_level", "timestamp")}
    return value.select(*[v.alias(k) for k, v in got.items()], F.get_json_object("value", "$.geometry.type").alias("kind"))


# --- display ------------------------------------------------------------------------------

def _styled(spark: SparkSession, sf: str) -> DataFrame:
    roads_of = serving.with_roads(serving.latest_per_street(fx.traffic_events(spark, sf)), _segments(spark, sf))
    # Levels are hidden for some classes, so that jam factor and speed ratio decide too.
    return roads_of.withColumn("congestion_level", F.when(F.col("highway") != "trunk", F.col("congestion_level")))


@query
def display_class(spark, sf):
    rows = fx.traffic_events(spark, sf)
    level = F.when(F.col("congestion_level") != "Low", F.upper("congestion_level"))
    return rows.select("event_id", traffic.display_class(level, F.col("jamFactor"), F.col("speed"), F.col("freeFlowSpeed")).alias("display"))


@query
def display_by_ratio(spark, sf):
    none = F.lit(None)
    return fx.traffic_events(spark, sf).select("event_id", traffic.display_class(
        none.cast("string"), none.cast("double"), F.col("speed"), F.col("freeFlowSpeed")).alias("display"))


@query
def stroke_width(spark, sf):
    net = roads.build_road_network(fx.road_edges(spark, sf)).select("u", "highway")
    events = fx.flow_raw(spark, sf).select("result_id", traffic.congestion_level(F.col("jamFactor")).alias("level"))
    both = net.join(events, net["u"] == events["result_id"], "left")
    return both.select("u", "highway", "level", traffic.stroke_width(F.col("highway"), F.col("level")).alias("width"))


@query
def style_rows(spark, sf):
    return style.style_rows(_styled(spark, sf)).select("street_id", "display", "colour", "width", "opacity")


@query
def palette(spark, sf):
    config = F.create_map(F.lit("LOW"), F.concat(F.lit("#0000"), F.lpad(F.hex(F.col("u") % 256), 2, "0")),
                          F.lit("severe"), F.lit("bad"), F.lit("default"), F.lit(" 80ABCDEF "))
    rows = fx.road_edges(spark, sf).select("u", traffic.merged_palette(config).alias("p"))
    return rows.select("u", *[traffic.colour_of(F.col("p"), F.lit(n)).alias(f"c_{n}") for n in ("low", "severe", "default", "unknown")])


@query
def hex_colour(spark, sf):
    code = F.when(F.col("u") % 3 == 0, F.hex("u")).otherwise(F.concat(F.lit("#"), F.lpad(F.hex("u"), 6, "0")))
    return fx.road_edges(spark, sf).select("u", code.alias("code"), text.hex_colour(code).alias("colour"))


@query
def multi_line_split(spark, sf):
    """Each pair of same-named roads as one multi line, taken apart again; lone points drop out."""
    coords = "transform(geometry, p -> array(p.x, p.y))"
    multi = fx.road_edges(spark, sf).select("u", F.expr(
        f"to_json(named_struct('type', 'MultiLineString', 'coordinates', array({coords}, slice({coords}, 1, 1), reverse({coords}))))").alias("shape"))
    parts = multi.withColumn("geometry", F.explode(F.expr(geo.geojson_lines("shape"))))
    return parts.select("u", *_ends())


@query
def multi_line_segments(spark, sf):
    """Each road and its way back as a stored multi line, cut into segments that are numbered on from part to part."""
    edges = roads.distinct_edges(fx.road_edges(spark, sf)).withColumn("_back", F.expr("reverse(geometry)"))
    head = F.unhex(F.lit("010500000002000000"))  # a multi line of two parts
    multi = edges.withColumn("geometry", F.concat(head, geo.to_wkb("geometry"), geo.to_wkb("_back"))).drop("_back")
    pieces = roads.build_road_segments(multi, id_scope="edge").withColumn(
        "number", F.substring_index("segment_id", "_", -1).cast("bigint"))
    return pieces.groupBy("osmid", "u", "v").agg(
        F.count("*").alias("pieces"), F.min("number").alias("first"), F.max("number").alias("last"),
        F.count_distinct("segment_id").alias("ids"), F.round(F.sum("length"), 3).alias("total"))


@query
def lenient_flags(spark, sf):
    flow = fx.flow_raw(spark, sf)
    word = F.when(F.col("result_id") % 4 == 0, "TRUE").when(F.col("result_id") % 4 == 1, "t").when(F.col("result_id") % 4 == 2, "1")
    return flow.select("result_id", text.lenient_boolean(word).alias("from_text"), text.lenient_boolean_number(F.col("speed")).alias("from_number"),
                       traffic.border_opacity(text.lenient_boolean_number(F.col("speed"))).alias("opacity"))


@query
def short_time(spark, sf):
    iso = F.when(F.col("event_id") % 5 != 0, F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss")).otherwise("soon")
    return fx.traffic_events(spark, sf).select("event_id", text.short_time(iso).alias("shown"), text.one_decimal(F.col("confidence")).alias("confidence"))


# --- quality ------------------------------------------------------------------------------

@query
def road_overlap_kinds(spark, sf):
    pairs = quality.line_relations(cut_lineage(roads.distinct_edges(fx.road_edges(spark, sf)), ("osmid", "u", "v")), ["osmid", "u", "v"])
    return pairs.select("osmid_1", "u_1", "v_1", "osmid_2", "u_2", "v_2", "kind")


def _road_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return quality.road_overlaps(cut_lineage(roads.build_road_network(fx.road_edges(spark, sf)), ("osmid", "u", "v")))


@query
def overlap_summary(spark, sf):
    return quality.overlap_summary(_road_pairs(spark, sf))


@query
def overlap_pairs(spark, sf):
    return quality.overlap_sample(_road_pairs(spark, sf)).drop("location")


@query
def overlap_locations(spark, sf):
    """The location texts read back: how many points they name, and their box."""
    numbers = "transform(regexp_extract_all(location, '(-?[0-9]+[.][0-9]+(?:E-?[0-9]+)?)', 1), t -> cast(t as double))"
    pairs = _road_pairs(spark, sf).withColumn("n", F.expr(numbers))
    axis = {a: f"filter(n, (t, i) -> i % 2 = {i})" for i, a in enumerate("xy")}
    box = [F.round(F.expr(f"array_{end}({axis[a]})"), 7).alias(f"{a}{end}") for end in ("min", "max") for a in "xy"]
    return pairs.select("osmid_1", "u_1", "v_1", "osmid_2", "u_2", "v_2", "kind", F.expr("cast(size(n) / 2 as bigint)").alias("points"), *box)


@query
def segment_overlap(spark, sf):
    return quality.overlap_summary(quality.segment_overlaps(_stored_segments(spark, sf)))


@query
def segment_overlap_same_way(spark, sf):
    return quality.segment_overlaps(_stored_segments(spark, sf), same_way=True).select("segment_id_1", "segment_id_2", "kind")


@query
def segment_quality(spark, sf):
    report = quality.segment_quality(_segments(spark, sf))
    return report.withColumns({c: F.round(c, 4) for c in ("min_length", "max_length", "avg_length")})


@query
def dq_report(spark, sf):
    report = quality.column_report(fx.flow_raw(spark, sf).drop("line"), {"jamFactor": (0.0, 9.5), "confidence": (0.0, 0.95)})
    return report.withColumn("null_share", F.round("null_share", 9))


@query
def duplicate_edges(spark, sf):
    return quality.duplicate_keys(fx.road_edges(spark, sf), ["osmid", "u", "v"])


@query
def speed_outliers(spark, sf):
    flagged = quality.flag_outliers(fx.traffic_events(spark, sf), "speed")
    return flagged.groupBy("is_outlier").agg(F.count("*").alias("n"))


# --- gold ---------------------------------------------------------------------------------

@query
def road_dim(spark, sf):
    return gold.road_dim(_segments(spark, sf)).drop("road_key")


@query
def location_dim(spark, sf):
    dim = gold.location_dim(_segments(spark, sf))
    return dim.select("segment_id", *[F.round(c, 7).alias(c) for c in ("start_lon", "start_lat", "end_lon", "end_lat")],
                      F.round("length", 4).alias("length"))


@query
def time_dim(spark, sf):
    dim = gold.time_dim(fx.traffic_events(spark, sf))
    return dim.select(*[F.col(c).cast("bigint").alias(c) if c not in ("hour", "day") else F.col(c).cast("timestamp").alias(c) for c in dim.columns])


@query
def congestion_fact(spark, sf):
    """The fact looked up through its dimension keys."""
    events, segments = fx.traffic_events(spark, sf), _segments(spark, sf)
    fact = gold.congestion_fact(events).groupBy("location_key", "time_key", "congestion_level").agg(F.count("*").alias("events"))
    places = gold.location_dim(segments).join(gold.road_dim(segments).select("road_key", "highway"), "road_key")
    return (fact.join(places, "location_key").join(gold.time_dim(events).select("time_key", "hour_of_day"), "time_key")
            .groupBy("highway", F.col("hour_of_day").cast("bigint").alias("hour_of_day"), "congestion_level")
            .agg(F.sum("events").alias("events")))


@query
def hourly_jam(spark, sf):
    jam = gold.hourly_jam(fx.traffic_events(spark, sf), _segments(spark, sf))
    return jam.withColumn("avg_jam", F.round("avg_jam", 6))


def _rounded_windows(rows: DataFrame) -> DataFrame:
    return rows.withColumns({c: F.round(c, 6) for c in ("avg_speed", "avg_jam")})


@query
def tumbling_congestion(spark, sf):
    return _rounded_windows(gold.windowed_congestion(fx.traffic_events(spark, sf), "15 minutes"))


@query
def sliding_congestion(spark, sf):
    return _rounded_windows(gold.windowed_congestion(fx.traffic_events(spark, sf), "1 hour", "30 minutes", keys=("congestion_level",)))


@query
def jam_episodes(spark, sf):
    return gold.jam_episodes(fx.traffic_events(spark, sf), "6 hours")
