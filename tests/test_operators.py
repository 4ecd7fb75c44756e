"""Operators on hand-made rows: cleaning quirks, duplicates, labels, serving rules, reports."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.operators import clean, gold, labels, quality, roads, rows, serving, style
from roadpulse.sources.snapshots import layer_path, read_snapshots

LINE = "array<struct<x:double,y:double>>"
T0 = dt.datetime(2024, 1, 1, 8, 0)


def snapshot(**flow):
    item = {"location": {"description": "A", "length": 100.0, "shape": {"links": [{"points": [{"lat": 21.0, "lng": 105.0}, {"lat": 21.1, "lng": 105.0}], "length": 100.0}]}},
            "currentFlow": {"speed": 5.0, "speedUncapped": 5.0, "freeFlow": 10.0, "jamFactor": 3.0, "confidence": 0.9, "traversability": "open"} | flow}
    return {"sourceUpdated": "2024-01-01T08:00:00Z", "results": [item]}


def test_snapshots_from_json(spark, tmp_path):
    docs = [snapshot(), snapshot(traversability=None), snapshot(jamFactor=None), snapshot(confidence=None), snapshot(speed=0),
            snapshot(freeFlow=None), snapshot(traversability="closed", confidence=0.7), snapshot(speed="fast"), {"sourceUpdated": "2024-01-01T08:00:00Z", "results": []},
            {"sourceUpdated": "2024-01-01T08:00:00Z"}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, docs)))
    raw = read_snapshots(spark, str(tmp_path))
    assert clean.flatten_snapshots(raw).count() == 8
    got = clean.clean_flow(raw).select("traversability", "jamFactor", "confidence", "timestamp").collect()
    assert sorted((r.traversability, r.jamFactor, r.confidence) for r in got) == [("closed", 3.0, 0.7), ("open", 3.0, 0.9), ("open", 3.0, 0.9), ("open", 5.0, 0.9)]
    assert {r.timestamp for r in got} == {T0}


def test_unnamed_rows_stay_unless_asked(spark):
    flow = spark.createDataFrame([(None, 1.0), (" ", 1.0), ("a", 1.0)], "street_name string, speed double").selectExpr(
        "*", "1D as traverse_length", "2D as freeFlowSpeed", "null as jamFactor", "0.9D as confidence", "'open' as traversability")
    flow = flow.withColumn("jamFactor", F.col("jamFactor").cast("double"))
    assert clean.clean_flow(flow).count() == 3 and clean.clean_flow(flow, require_name=True).count() == 1


def edges(spark, data):
    return spark.createDataFrame(data, f"osmid string, u bigint, v bigint, name string, oneway boolean, highway string, maxspeed string, lanes string, geometry {LINE}")


def edge(osmid, u, v, pts, name="n", maxspeed="50"):
    return (osmid, u, v, name, False, "primary", maxspeed, "2", pts)


def test_distinct_edges_do_not_depend_on_order(spark):
    data = [edge("1", 1, 2, [(0.0, 0.0), (0.0, 1.0)], name) for name in "cab"] + [edge("1", 3, 3, [(0.0, 0.0), (0.0, 1.0)])]
    first = roads.distinct_edges(edges(spark, data)).collect()
    assert first == roads.distinct_edges(edges(spark, data[::-1])).collect() and len(first) == 1 and first[0].name == "a"


def test_segments_of_bent_and_empty_lines(spark):
    data = [edge("1", 1, 2, [(105.0, 21.0), (105.001, 21.0), (105.001, 21.002), (105.004, 21.003)]),
            edge("1", 2, 1, [(105.004, 21.003), (105.0, 21.0)]), edge("2", 5, 6, [(105.0, 21.0), (105.0, 21.0)])]
    by_way = roads.build_road_segments(edges(spark, data)).collect()
    assert len({r.segment_id for r in by_way}) == len(by_way)
    assert {(r.u, r.v) for r in by_way if r.segment_id == "1_0"} == {(1, 2)}
    empty = [r for r in by_way if r.osmid == "2"]
    assert [(r.segment_id, r.length, r.azimuth) for r in empty] == [("2_0", 0.0, None)]
    by_edge = roads.build_road_segments(edges(spark, data), id_scope="edge").collect()
    net = {(r.u, r.v): r.length for r in roads.build_road_network(edges(spark, data)).collect()}
    for key in net:
        assert sum(r.length for r in by_edge if (r.u, r.v) == key) == pytest.approx(net[key], rel=1e-9)
    with pytest.raises(ValueError):
        roads.build_road_segments(edges(spark, data), id_scope="other")


def test_edges_with_binary_geometry(spark):
    plain = edges(spark, [edge("1", 1, 2, [(105.0, 21.0), (105.001, 21.0)])])
    binary = plain.withColumn("geometry", geo.to_wkb("geometry"))
    assert roads.build_road_network(binary).collect() == roads.build_road_network(plain).collect()


def test_normalise_edges(spark):
    raw = spark.sql("select array(1, 2) osmid, 1L u, 2L v, array('a', 'b') name, true oneway, 5 unknown, cast(null as array<string>) lanes")
    row = roads.normalise_edges(raw).first()
    assert row.asDict() == {"osmid": "[1, 2]", "u": 1, "v": 2, "name": "['a', 'b']", "oneway": True, "lanes": None}


def test_keyed_join_keeps_all_rows(spark):
    fact = spark.range(1000).selectExpr("id", "if(id % 3 = 0, 'hot', if(id % 3 = 1, null, concat('k', id % 7))) as k")
    dim = spark.sql("select 'hot' k, 1 a union all select 'k1', 2 union all select 'k2', 3")
    for how in ("left", "inner"):
        want = fact.join(dim, "k", how).select("id", "k", "a").collect()
        assert sorted(rows.keyed_join(fact, dim, "k", how=how).select("id", "k", "a").collect(), key=str) == sorted(want, key=str)


def test_numbered_is_consecutive(spark):
    names = spark.range(500).selectExpr("concat('n', lpad(id * 7919 % 500, 4, '0')) as name").repartition(7)
    got = rows.numbered(names, ["name"], "id", start=11).orderBy("id").collect()
    assert [r.id for r in got] == list(range(11, 511)) and [r.name for r in got] == sorted(r.name for r in got)


def test_labels_leave_out_unusable_names(spark):
    flow = spark.sql("select * from values ('b', 1), (null, 2), (' ', 3), ('c', 4), ('a', 5), ('b', 6) as t(street_name, n)")
    known = spark.sql("select 7L street_id, 'a' street_name")
    assert {tuple(r) for r in labels.extend_labels(flow, known).collect()} == {(7, "a"), (8, "b"), (9, "c")}
    empty = known.limit(0)
    assert {tuple(r) for r in labels.extend_labels(flow, empty).collect()} == {(1, "a"), (2, "b"), (3, "c")}


def serving_tables(spark):
    segments = spark.createDataFrame(
        [("s1", "A", "primary", True, [(0.0, 0.0), (1.0, 1.0)]), ("s2", "B", "residential", False, [(0.0, 5.0), (1.0, 5.0)]),
         ("s3", "C", "primary_link", None, [(9.0, 0.0), (9.0, 9.0)])], f"segment_id string, name string, highway string, oneway boolean, geometry {LINE}")
    at = lambda m: T0 + dt.timedelta(minutes=m)
    events = spark.createDataFrame(
        [(1, "s1", at(0), 10.0), (2, "s1", at(5), 11.0), (3, "s1", at(5), 12.0), (4, "s2", at(9), 13.0), (5, "s3", at(1), 14.0), (6, "gone", at(20), 15.0)],
        "event_id bigint, street_id string, timestamp timestamp, speed double").selectExpr(
        "*", "2D as jamFactor", "0.9D as confidence", "'open' as traversability", "20D as freeFlowSpeed", "'Low' as congestion_level")
    return events, segments


def test_latest_traffic_rules(spark):
    events, segments = serving_tables(spark)
    ids = lambda df: [(r.street_id, r.speed) for r in df.collect()]
    assert ids(serving.latest_traffic(events, segments, zoom=16)) == [("s2", 13.0), ("s1", 12.0), ("s3", 14.0)]
    # No zoom and zoom 0 both mean 13; below 12 link roads are hidden.
    assert ids(serving.latest_traffic(events, segments)) == ids(serving.latest_traffic(events, segments, zoom=0)) == [("s1", 12.0), ("s3", 14.0)]
    assert ids(serving.latest_traffic(events, segments, zoom=11)) == [("s1", 12.0)]
    assert ids(serving.latest_traffic(events, segments, bbox=(8.0, 1.0, 10.0, 2.0), zoom=16)) == [("s3", 14.0)]
    assert ids(serving.latest_traffic(events, segments, bbox=(10.0, 2.0, 8.0, 1.0), zoom=16)) == [("s3", 14.0)]
    assert len(ids(serving.latest_traffic(events, segments, bbox=(8.0, None, 10.0, 2.0), zoom=16))) == 3


def test_traffic_range_rules(spark):
    events, segments = serving_tables(spark)
    got = serving.traffic_range(events, segments, "2024-01-01 08:00:00", "2024-01-01 08:05:00", zoom=16).collect()
    assert [r.event_id for r in got] == [3, 2, 5, 1]
    got = serving.traffic_range(events, segments, "2024-01-01 08:00:00", "2024-01-01 08:05:00", zoom=16, limit=2).collect()
    assert [r.event_id for r in got] == [3, 2]
    with pytest.raises(ValueError):
        serving.traffic_range(events, segments, None, "2024-01-01")


@pytest.mark.parametrize("asked, window, wanted", [(None, True, 500), (None, False, 200), (0, False, 200), (-4, True, 500), (50, True, 50), (90000, False, 5000)])
def test_row_limit(asked, window, wanted):
    assert serving.row_limit(asked, window) == wanted


def test_orphans(spark):
    events, segments = serving_tables(spark)
    assert [tuple(r) for r in serving.orphan_streets(events, segments).collect()] == [("gone", 1)]
    kept = serving.drop_orphans(events, segments)
    assert sorted(r.event_id for r in kept.collect()) == [1, 2, 3, 4, 5] and kept.columns == events.columns


def test_feature_collection(spark):
    events, segments = serving_tables(spark)
    latest = serving.latest_traffic(events, segments, zoom=16)
    doc = json.loads(serving.feature_collection(latest, 16, None, ("a", "b"), 500, {"low": "#111111"}).first()[0])
    assert [f["properties"]["street_id"] for f in doc["features"]] == ["s2", "s1", "s3"]
    assert doc["features"][0]["geometry"] == {"type": "LineString", "coordinates": [[0.0, 5.0], [1.0, 5.0]]}
    assert doc["features"][2]["properties"]["oneway"] is None
    assert doc["features"][0]["properties"]["timestamp"] == "2024-01-01T08:09:00.000Z"
    meta = doc["metadata"]
    assert (meta["count"], meta["zoom"], meta["bbox"], meta["time_range"], meta["query_limit"]) == (3, 16.0, None, ["a", "b"], 500)
    assert meta["color_config"]["low"] == "#111111" and meta["color_config"]["high"] == "#E91E63"
    none = json.loads(serving.feature_collection(latest.limit(0)).first()[0])
    assert none["features"] == [] and none["metadata"]["count"] == 0


def test_style_features(spark):
    rows_in = spark.createDataFrame([("LOW", 9.0, "motorway", True, '{"type":"MultiLineString","coordinates":[[[1,2],[3,4]],[[5,6]]]}'), (None, None, None, None, '{"type":"Point","coordinates":[1,2]}')],
                                    "congestion_level string, jamFactor double, highway string, oneway boolean, shape string").selectExpr("*", "1D as speed", "2D as freeFlowSpeed")
    got = style.style_features(rows_in, geojson="shape").collect()
    assert [(r.display, r.colour, r.width, r.opacity, len(r.points)) for r in got] == [("low", 0xFF00BCD4, 4.0, 0.5, 2)]


def relations(spark, lines):
    df = spark.createDataFrame([(i, i, i, pts) for i, pts in enumerate(lines)], f"osmid int, u int, v int, geometry {LINE}")
    return {(r.osmid_1, r.osmid_2): (r.kind, r.location) for r in quality.line_relations(df, ["osmid", "u", "v"]).collect()}


def test_line_relations(spark):
    s = 0.001
    at = lambda *pts: [(105.0 + x * s, 21.0 + y * s) for x, y in pts]
    got = relations(spark, [
        at((0, 0), (4, 0)),                    # 0: flat
        at((4, 0), (6, 0)),                    # 1: goes on from 0
        at((2, -1), (2, 1)),                   # 2: cuts 0
        at((2, 0), (2, 3)),                    # 3: ends on the inside of 0, runs over 2
        at((4, 0), (0, 0)),                    # 4: 0 the other way
        at((1, 0), (3, 0)),                    # 5: inside 0
        at((3, 0), (5, 0)),                    # 6: over the end of 0
        at((10, 0), (11, 0), (11, 1), (10, 0)),  # 7: a ring
        at((10, 0), (9, -1)),                  # 8: starts on the ring
        at((0, 2), (1, 2), (1, -2)),           # 9: bent, cuts 0
        at((20, 20), (21, 20)),                # 10: alone
    ])
    kinds = {k: v[0] for k, v in got.items()}
    assert kinds[0, 1] == "touches" and kinds[0, 2] == "crosses" and kinds[0, 3] == "touches"
    assert kinds[0, 4] == "other" and kinds[0, 5] == "other" and kinds[0, 6] == "overlaps"
    assert kinds[2, 3] == "overlaps" and kinds[1, 6] == "overlaps" and kinds[0, 9] == "crosses"
    # A ring has no ends, but 8 still meets it with its own end only.
    assert kinds[7, 8] == "touches"
    assert not any(10 in k for k in kinds)
    assert got[0, 2][1] == "POINT(105.002 21.0)" and got[0, 6][1].startswith("LINESTRING(105.003")


def test_column_report_and_outliers(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (2, 2.0), (3, 3.0), (4, 2.0), (5, 99.0)], "id bigint, v double")
    report = {r.column_name: r for r in quality.column_report(df, {"v": (0.0, 10.0)}).collect()}
    assert (report["v"].rows, report["v"].nulls, report["v"].out_of_range, report["id"].nulls) == (6, 1, 1, 0)
    assert tuple(quality.duplicate_keys(df, ["id"]).first()) == (1, 1)
    flagged = {r.v: r.is_outlier for r in quality.flag_outliers(df, "v").collect()}
    assert flagged[99.0] is True and flagged[2.0] is False and flagged[None] is None


def test_segment_quality_counts_bad_lines(spark):
    df = spark.createDataFrame([("a", 1.0, None), ("a", 3.0, [(0.0, 0.0), (0.0, 0.0)]), ("b", 2.0, [(0.0, 0.0), (1.0, 0.0)])], f"segment_id string, length double, geometry {LINE}")
    assert tuple(quality.segment_quality(df).first()) == (3, 2, 1, 1, 1.0, 3.0, 2.0)


def test_dimension_keys_are_stable(spark):
    events, _ = serving_tables(spark)
    a, b = (gold.congestion_fact(e).select("location_key", "time_key").distinct().collect() for e in (events, events.repartition(3)))
    assert sorted(a) == sorted(b)


def test_layer_path():
    assert layer_path("s3a://raw-bucket/raw/2024_draw/raw_feed.json", "processed") == "s3a://raw-bucket/processed/2024_draw/raw_feed.parquet"
    with pytest.raises(ValueError):
        layer_path("s3a://bucket/other/a.json", "processed")
