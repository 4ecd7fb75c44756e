"""Hand-made rows for scalar and geometry expressions."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.functions import text, traffic

LINE = "array<struct<x:double,y:double>>"


def one(spark, value, ddl, column):
    return spark.createDataFrame([(value,)], f"v {ddl}").select(column.alias("r")).first()["r"]


def line_of(spark, points, expression):
    df = spark.createDataFrame([(points,)], f"v {LINE}")
    return df.select(F.expr(expression).alias("r")).first()["r"]


@pytest.mark.parametrize("given, wanted", [
    ("50", 50.0), ("['40', '60']", 40.0), ("[60, 40]", 40.0), ("nan", None), ("", None), (None, None), ("60 mph", None),
    ("['40', 'x']", None), ("50d", None), ("[]", None), ("['nan', '40']", None), ("1e2", 100.0), (" 30 ", 30.0), ('["70"]', 70.0)])
def test_clean_speed_limit(spark, given, wanted):
    assert one(spark, given, "string", text.clean_speed_limit(F.col("v"))) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("#00BCD4", 0xFF00BCD4), ("00bcd4", 0xFF00BCD4), (" #80FF0000 ", 0x80FF0000), ("12#3456", 0xFF123456),
    ("#12345", None), ("zzzzzz", None), (None, None)])
def test_hex_colour(spark, given, wanted):
    assert one(spark, given, "string", text.hex_colour(F.col("v"))) == wanted


@pytest.mark.parametrize("given, wanted", [("2024-01-01T05:07:00", "5:07"), ("noon", "noon"), (None, None)])
def test_short_time(spark, given, wanted):
    assert one(spark, given, "string", text.short_time(F.col("v"))) == wanted


@pytest.mark.parametrize("given, wanted", [(0.25, "0.3"), (0.85, "0.8"), (0.75, "0.8"), (None, "0.0"), (1234.56, "1234.6"), (-0.25, "-0.3"), (12.0, "12.0")])
def test_one_decimal(spark, given, wanted):
    assert one(spark, given, "double", text.one_decimal(F.col("v"))) == wanted


@pytest.mark.parametrize("given, wanted", [("TRUE", True), ("t", True), ("1", True), ("yes", False), (None, False)])
def test_lenient_boolean(spark, given, wanted):
    assert one(spark, given, "string", text.lenient_boolean(F.col("v"))) is wanted
    assert one(spark, True, "boolean", text.lenient_boolean(F.col("v"))) is True


def test_snapshot_key(spark):
    assert one(spark, "2024-01-01 05:07:09", "string", text.snapshot_key(F.col("v"))) == "2024-01-01_05-07-09"
    assert one(spark, None, "string", text.snapshot_key(F.col("v"))) == "unknown_time"


def test_implied_jam(spark):
    rows = spark.createDataFrame([(5.0, 10.0), (20.0, 10.0), (-5.0, 10.0), (5.0, 0.0), (None, 10.0)], "s double, f double")
    got = [r[0] for r in rows.select(traffic.implied_jam(F.col("s"), F.col("f"))).collect()]
    assert got == [5.0, 0.0, 10.0, None, None]


def test_congestion_level_of_null_is_low(spark):
    rows = spark.createDataFrame([(7.0,), (6.9,), (4.0,), (3.9,), (None,)], "j double")
    assert [r[0] for r in rows.select(traffic.congestion_level(F.col("j"))).collect()] == ["High", "Medium", "Medium", "Low", "Low"]


def test_display_class_order(spark):
    rows = [("HIGH", 0.0, 1.0, 1.0, "high"), ("odd", 0.5, 1.0, 1.0, "low"), (None, 1.0, None, None, "medium"), (None, 2.5, None, None, "high"),
            (None, 3.0, None, None, "severe"), (None, None, 8.0, 10.0, "low"), (None, None, 7.0, 10.0, "medium"), (None, None, 3.0, 10.0, "high"),
            (None, None, 2.0, 10.0, "severe"), (None, None, 2.0, 0.0, "default"), (None, None, None, 5.0, "default")]
    df = spark.createDataFrame(rows, "l string, j double, s double, f double, want string")
    got = df.select("want", traffic.display_class(F.col("l"), F.col("j"), F.col("s"), F.col("f")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_stroke_width(spark):
    rows = [("motorway", "Severe", 5.0), ("primary", "medium", 4.0), ("living_street", None, 2.0), (None, "High", 3.5), ("track", "Low", 2.5)]
    df = spark.createDataFrame(rows, "h string, l string, want double")
    got = df.select("want", traffic.stroke_width(F.col("h"), F.col("l")).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_palette_last_equal_name_counts(spark):
    df = spark.sql("select map('Low', '#000001', 'LOW', '#000002', 'high', 'bad') c union all select null")
    p = [r[0] for r in df.select(traffic.merged_palette(F.col("c"))).collect()]
    assert p[0]["low"] == 0xFF000002 and p[0]["high"] == 0xFFE91E63 and p[1]["low"] == 0xFF00BCD4


def test_palette_is_worked_out_once(spark):
    df = spark.sql("select map('Low', '#000001') c").select(traffic.merged_palette(F.col("c")).alias("p"))
    plan = df._jdf.queryExecution().analyzed().toString()
    assert plan.lower().count("map_entries(") == 1


@pytest.mark.parametrize("zoom, count", [(11.9, 3), (12, 7), (13.9, 7), (14, 9), (16, None)])
def test_zoom_tiers(zoom, count):
    classes = traffic.classes_at_zoom(zoom)
    assert (classes and len(classes)) == count


# --- geometry ---------------------------------------------------------------------------

def vincenty(x1, y1, x2, y2):
    """Geodesic length by the iterative inverse formula."""
    a, f = 6378137.0, 1 / 298.257223563
    b = (1 - f) * a
    u1, u2 = (math.atan((1 - f) * math.tan(math.radians(y))) for y in (y1, y2))
    lon = lam = math.radians(x2 - x1)
    for _ in range(200):
        s = math.hypot(math.cos(u2) * math.sin(lam), math.cos(u1) * math.sin(u2) - math.sin(u1) * math.cos(u2) * math.cos(lam))
        if s == 0:
            return 0.0
        c = math.sin(u1) * math.sin(u2) + math.cos(u1) * math.cos(u2) * math.cos(lam)
        sigma = math.atan2(s, c)
        alpha = math.cos(u1) * math.cos(u2) * math.sin(lam) / s
        k = 1 - alpha**2
        m = c - 2 * math.sin(u1) * math.sin(u2) / k if k else 0.0
        cc = f / 16 * k * (4 + f * (4 - 3 * k))
        lam = lon + (1 - cc) * f * alpha * (sigma + cc * s * (m + cc * c * (2 * m * m - 1)))
    uu = k * (a * a - b * b) / b**2
    aa = 1 + uu / 16384 * (4096 + uu * (-768 + uu * (320 - 175 * uu)))
    bb = uu / 1024 * (256 + uu * (-128 + uu * (74 - 47 * uu)))
    d = bb * s * (m + bb / 4 * (c * (2 * m * m - 1) - bb / 6 * m * (4 * s * s - 3) * (4 * m * m - 3)))
    return b * aa * (sigma - d)


@pytest.mark.parametrize("ends", [(105.8, 21.0, 105.801, 21.0), (105.8, 21.0, 105.8, 21.001), (105.8, 21.0, 105.83, 21.04), (-70.0, -45.0, -70.01, -45.02), (10.0, 60.0, 10.0, 60.0)])
def test_metres_against_geodesic(spark, ends):
    got = line_of(spark, [ends[:2], ends[2:]], geo.line_metres("v"))
    assert got == pytest.approx(vincenty(*ends), rel=1e-7, abs=1e-9)


@pytest.mark.parametrize("dx, dy, wanted", [(0, 1, 0.0), (1, 0, 90.0), (0, -1, 180.0), (-1, 0, 270.0), (1, 1, 45.0), (0, 0, None)])
def test_azimuth(spark, dx, dy, wanted):
    assert line_of(spark, [(5.0, 5.0), (5.0 + dx, 5.0 + dy)], geo.azimuth("v")) == wanted


def test_links_to_line(spark):
    p = lambda x, y: {"lat": y, "lng": x}
    link = lambda pts: {"points": pts, "length": 1.0, "functionalClass": "3"}
    rows = [([link([p(1.0, 2.0), p(3.0, 4.0)]), link([p(3.0, 4.0), p(5.0, 6.0)])],), ([link(None), link([p(1.0, 2.0), p(3.0, 4.0)])],),
            ([link([p(1.0, 2.0)])],), ([],), (None,), ([link([p(1.0, 1.0), p(2.0, 2.0)]), link([p(9.0, 9.0), p(8.0, 8.0)]), link([])],)]
    ddl = "links array<struct<points: array<struct<lat: double, lng: double>>, length: double, functionalClass: string>>"
    got = [r[0] for r in spark.createDataFrame(rows, ddl).select(F.expr(geo.to_wkt(f"({geo.links_to_line('links')})"))).collect()]
    assert got == ["LINESTRING(1.0 2.0, 3.0 4.0, 5.0 6.0)", "LINESTRING(1.0 2.0, 3.0 4.0)", None, None, None, "LINESTRING(1.0 1.0, 2.0 2.0, 8.0 8.0)"]


@pytest.mark.parametrize("given, size", [("LINESTRING(1 2, 3 4)", 2), ("linestring (1 2,3 4,5 6)", 3), ("LINESTRING(1 2)", None), ("POINT(1 2)", None), ("LINESTRING(1 2, x 4)", None), (None, None)])
def test_from_wkt(spark, given, size):
    got = one(spark, given, "string", F.expr(geo.from_wkt("v")))
    assert (None if got is None else len(got)) == size


def test_wkb_with_more_values(spark):
    """Z and M values are left out, a multi line of one part is that part."""
    import struct

    def line(code, *rows, order="<"):
        flat = [v for r in rows for v in r]
        return (b"\x01" if order == "<" else b"\x00") + struct.pack(f"{order}II{len(flat)}d", code, len(rows), *flat)

    two = line(2, (1, 2), (3, 4))
    values = [line(0x80000002, (1, 2, 9), (3, 4, 9)), line(1002, (1, 2, 9), (3, 4, 9)), line(3002, (1, 2, 9, 8), (3, 4, 9, 8), order=">"), two, None,
              struct.pack("<BII", 1, 5, 1) + two, struct.pack("<BII", 1, 5, 2) + two + two, two[:-1], b"\x01\x02"]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v binary").coalesce(1)
    got = {r[0]: r[1] and [tuple(p) for p in r[1]] for r in rows.select("i", geo.from_wkb("v")).collect()}
    assert [got[i] for i in range(len(values))] == [[(1, 2), (3, 4)]] * 4 + [None, [(1, 2), (3, 4)], None, None, None]


def test_wkb_parts(spark):
    """All parts of two points or more, in their own byte orders; a broken part spoils the whole."""
    def line(order, code, *rows):
        flat = [v for r in rows for v in r]
        return (b"\x01" if order == "<" else b"\x00") + struct.pack(f"{order}II{len(flat)}d", code, len(rows), *flat)

    one, other = line("<", 2, (1, 2), (3, 4)), line(">", 0x80000002, (5, 6, 9), (7, 8, 9), (9, 9, 9))
    dot, point = line("<", 2, (1, 2)), b"\x01" + struct.pack("<I2d", 1, 1.0, 2.0)
    values = [one, struct.pack("<BII", 1, 5, 2) + one + other, struct.pack(">BII", 0, 5, 3) + other + dot + one,
              struct.pack("<BIII", 1, 5 | 0x20000000, 4326, 1) + one, struct.pack("<BII", 1, 5, 1) + dot,
              struct.pack("<BII", 1, 5, 2) + one + other[:-1], struct.pack("<BII", 1, 5, 1) + one + one, struct.pack("<BII", 1, 5, 0), point, dot, b"\x01", None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v binary").coalesce(1)
    got = {r[0]: r[1] and [[tuple(p) for p in l] for l in r[1]] for r in rows.select("i", geo.lines_from_wkb("v")).collect()}
    a, b = [(1, 2), (3, 4)], [(5, 6), (7, 8), (9, 9)]
    assert [got[i] for i in range(len(values))] == [[a], [a, b], [b, a], [a]] + [None] * 8


def test_wkb_forms(spark):
    pts = [1.0, 2.0, 3.0, 4.0]
    little = b"\x01" + struct.pack("<II4d", 2, 2, *pts)
    big = b"\x00" + struct.pack(">II4d", 2, 2, *pts)
    with_srid = b"\x01" + struct.pack("<III4d", 2 | 0x20000000, 4326, 2, *pts)
    point = b"\x01" + struct.pack("<I2d", 1, 1.0, 2.0)
    rows = spark.createDataFrame([(little,), (big,), (with_srid,), (point,), (little[:-3],), (None,)], "v binary")
    got = [r[0] and [tuple(p) for p in r[0]] for r in rows.select(geo.from_wkb("v")).collect()]
    assert got == [[(1.0, 2.0), (3.0, 4.0)]] * 3 + [None] * 3


def test_geojson_lines(spark):
    shapes = ['{"type":"LineString","coordinates":[[1,2],[3,4]]}', '{"type":"MultiLineString","coordinates":[[[1,2],[3,4]],[[5,6]],[[1,2],[9],[3,4]]]}',
              '{"type":"Point","coordinates":[1,2]}', None]
    df = spark.createDataFrame([(s,) for s in shapes], "v string")
    assert [len(r[0]) for r in df.select(F.expr(geo.geojson_lines("v"))).collect()] == [1, 2, 0, 0]


def test_validity(spark):
    lines = [[(1.0, 2.0), (3.0, 4.0)], [(1.0, 2.0), (1.0, 2.0)], [(1.0, 2.0)], [(1.0, 2.0), (181.0, 4.0)], [(1.0, 2.0), (float("nan"), 4.0)], None]
    df = spark.createDataFrame([(l,) for l in lines], f"v {LINE}")
    assert [r[0] for r in df.select(F.expr(geo.is_valid_line("v"))).collect()] == [True, False, False, False, False, None]


@pytest.mark.parametrize("pts, wanted", [([(0.0, 0.0), (10.0, 10.0)], True), ([(0.0, 3.0), (3.0, 0.0)], False), ([(0.0, 4.0), (4.0, 0.0)], True),
                                         ([(5.0, 0.0), (5.0, 9.0)], False), ([(2.5, 2.5), (2.6, 2.6)], True), ([(0.0, 0.0), (9.0, 0.0), (3.0, 9.0)], False), ([(0.0, 0.0), (9.0, 0.0), (2.5, 2.5)], True)])
def test_line_in_window(spark, pts, wanted):
    assert line_of(spark, pts, geo.line_in_window("v", (2.0, 2.0, 3.0, 3.0))) is wanted


def test_substrings_add_up(spark):
    pts = [(0.0, 0.0), (3.0, 4.0), (3.0, 4.0), (3.0, 10.0), (-5.0, 10.0)]
    df = spark.createDataFrame([(pts,)], f"v {LINE}").withColumn("run", F.expr(geo.running_length("v")))
    parts = df.selectExpr("*", "explode(sequence(0, 6)) as k").selectExpr("k", "run", geo.line_substring("v", "run", "k / 7D", "if(k = 6, 1D, (k + 1) / 7D)") + " as part")
    rows = parts.orderBy("k").collect()
    planar = lambda l: sum(math.dist(a, b) for a, b in zip(l, l[1:]))
    assert sum(planar([tuple(p) for p in r.part]) for r in rows) == pytest.approx(19.0)
    assert all(tuple(a.part[-1]) == tuple(b.part[0]) for a, b in zip(rows, rows[1:]))
    assert tuple(rows[0].part[0]) == pts[0] and tuple(rows[-1].part[-1]) == pts[-1]
