"""Grid join and matching against brute force, with and without hot cells."""

import math
import random

import pytest
from pyspark.sql import functions as F

from roadpulse.operators import clean, matching, roads, spatial
from roadpulse.plans import fixtures as fx

LINE = "array<struct<x:double,y:double>>"
RADIUS = 0.00015


def random_lines(count, first, step, seed):
    rng, out = random.Random(seed), []
    for i in range(count):
        x, y = 105.8 + rng.random() * 0.02, 21 + rng.random() * 0.02
        pts = [(x, y)]
        for _ in range(rng.randint(1, 4)):
            x, y = x + rng.uniform(-1, 1) * step, y + rng.uniform(-1, 1) * step
            pts.append((x, y))
        out.append((first + i, pts))
    return out


LEFT, RIGHT = random_lines(80, 0, 0.004, 1), random_lines(120, 1000, 0.001, 2)
# A third of all left lines run through one place.
LEFT += [(500 + i, [(105.81 + i * 1e-6, 21.0099), (105.8101 + i * 1e-6, 21.0101)]) for i in range(40)]
RIGHT += [(2000, [(105.8095, 21.01), (105.8105, 21.01)]), (2001, [(105.81, 21.0095), (105.8101, 21.0105)])]


def side(a, b, c):
    return (b[0] - a[0]) * (c[1] - a[1]) - (b[1] - a[1]) * (c[0] - a[0])


def cross(p, q):
    return any(side(*u, v[0]) * side(*u, v[1]) <= 0 and side(*v, u[0]) * side(*v, u[1]) <= 0 for u in zip(p, p[1:]) for v in zip(q, q[1:]))


def near(x, y, line):
    best = math.inf
    for (ax, ay), (bx, by) in zip(line, line[1:]):
        ex, ey = bx - ax, by - ay
        ee = ex * ex + ey * ey
        t = max(0.0, min(1.0, ((x - ax) * ex + (y - ay) * ey) / ee)) if ee else 0.0
        best = min(best, math.hypot(x - ax - t * ex, y - ay - t * ey))
    return best


def metres_at(x1, y1, x2, y2):
    m = math.radians((y1 + y2) / 2)
    w = 1 - 0.0066943799901413165 * math.sin(m) ** 2
    return math.hypot(math.radians(y2 - y1) * 6378137 * (1 - 0.0066943799901413165) / w**1.5, math.radians(x2 - x1) * math.cos(m) * 6378137 / math.sqrt(w))


@pytest.fixture(scope="module")
def tables(spark):
    return (spark.createDataFrame(LEFT, f"i bigint, line {LINE}").cache(), spark.createDataFrame(RIGHT, f"j bigint, geometry {LINE}").cache())


@pytest.mark.parametrize("cell_rows,cell_pairs", [(10_000, 4096), (10, 4096), (1, 4096), (10_000, 1), (3, 1)])
def test_grid_join_equals_brute_force(tables, cell_rows, cell_pairs):
    wanted = {(i, j) for i, p in LEFT for j, q in RIGHT if cross(p, q)}
    got = [tuple(r) for r in spatial.intersecting_lines(
        *tables, "i", "j", left_line="line", cell_rows=cell_rows, cell_pairs=cell_pairs).collect()]
    assert len(got) == len(set(got)) and set(got) == wanted


@pytest.mark.parametrize("cell", [0.0005, 0.05])
def test_grid_size_does_not_matter(tables, cell):
    wanted = {(i, j) for i, p in LEFT for j, q in RIGHT if cross(p, q)}
    assert {tuple(r) for r in spatial.intersecting_lines(*tables, "i", "j", left_line="line", cell=cell).collect()} == wanted


def cells_of(left, right, grow=0.0, **sizes):
    sides = [spatial._Side(spatial.line_pieces(df, ["i"], "line"), p, ["i"], g, 0.002) for df, p, g in ((left, "l_", grow), (right, "r_", 0.0))]
    return spatial.meeting_cells(*sides, **sizes)


def test_one_place_spreads_over_blocks(spark):
    """All lines in one cell, and none to be told from another by place: blocks stay small, and each two rows meet in one block."""
    place = [(i, [(105.811 + i * 1e-9, 21.0101), (105.8111 + i * 1e-9, 21.0103)]) for i in range(300)]
    lines = spark.createDataFrame(place, f"i bigint, line {LINE}")
    left, right, keys = cells_of(lines, lines, cell_rows=20)
    assert {"sl", "sr"} < set(keys)
    largest = max(r["count"] for df in (left, right) for r in df.groupBy(*keys).count().collect())
    assert largest < 60 and left.select(*keys).distinct().count() >= 225
    pairs = left.join(right, keys).groupBy("l_i", "r_i").count()
    assert pairs.count() == 300 * 300 and pairs.agg(F.max("count")).first()[0] == 1


@pytest.mark.parametrize("grow", [0.0, RADIUS])
def test_dense_cell_costs_few_pairs(spark, grow):
    """Thousands of short lines in one cell of 0.002 degrees: the pairs that meet in smaller cells are few times the near ones."""
    rng = random.Random(8)

    def short(count):
        rows = []
        for i in range(count):
            x, y, turn = 105.8101 + rng.random() * 0.0018, 21.0101 + rng.random() * 0.0018, rng.random() * 6.3
            rows.append((i, [(x, y), (x + 0.00006 * math.cos(turn), y + 0.00006 * math.sin(turn))]))
        return spark.createDataFrame(rows, f"i bigint, line {LINE}").repartition(4)

    left, right = short(2_500), short(2_500)
    a, b, keys = cells_of(left, right, grow)
    met = a.join(b, keys).count()
    near = spatial.near_pieces(*(spatial.line_pieces(df, ["i"], "line") for df in (left, right)), ["i"], ["i"], grow=grow)
    clipped = spatial.capsule_interval(spatial.with_sides(near), grow or 1e-12)
    true = clipped.filter("lo is not null" if grow else "meets").count()
    assert true > 1_000 and met <= 20 * true and met < 2_500 * 2_500 / 8


def test_no_pair_of_pieces_comes_twice(spark, tables):
    left, right = (spatial.line_pieces(df, [i], c) for df, i, c in zip(tables, "ij", ("line", "geometry")))
    for sizes in ({}, {"cell_pairs": 2}, {"cell_pairs": 2, "cell_rows": 3}, {"cell": 0.0005}):
        near = spatial.near_pieces(left, right, ["i"], ["j"], grow=RADIUS, **sizes)
        assert near.groupBy("l_i", "l_part", "r_j", "r_part").count().filter("count > 1").isEmpty()


def test_stacked_lines_are_not_split(spark):
    """Lines on top of each other over many cells: smaller cells would only repeat the pairs."""
    rows = [(i, [(105.8101, 21.011 + i * 1e-8), (105.8119, 21.011 + i * 1e-8)]) for i in range(100)]
    lines = spark.createDataFrame(rows, f"i bigint, line {LINE}")
    left, right, keys = cells_of(lines, lines)
    assert left.join(right, keys).count() == 100 * 100


def test_touching_and_parallel_pieces_meet(spark):
    """Shared ends, ends on the inside, common stretches, points, and borders of cells."""
    base = (105.812, 21.012)  # a corner of cells
    ends = [(dx * 0.001, dy * 0.001) for dx in (-2, -1, 0, 1, 2) for dy in (-2, 0, 1)]
    lines = [(n, [(base[0] + a[0], base[1] + a[1]), (base[0] + b[0], base[1] + b[1])])
             for n, (a, b) in enumerate((a, b) for a in ends for b in ends if (a[0] * 7 + b[1] * 11 + a[1]) * 1e3 % 3 < 1.6)]
    df = spark.createDataFrame(lines, f"i bigint, line {LINE}")
    met = {(r[0], r[1]) for r in spatial.intersecting_lines(
        df, df.select(F.col("i").alias("j"), F.col("line").alias("geometry")), "i", "j", left_line="line", cell_pairs=50).collect()}
    whole = df.alias("a").join(df.alias("b"), F.lit(True)).selectExpr(
        "a.i", "b.i as j", *[f"{t}.line[{k}].{c} as {p}_{c}{k + 1}" for t, p in (("a", "l"), ("b", "r")) for k in (0, 1) for c in "xy"])
    assert met == {(r.i, r.j) for r in spatial.with_sides(whole).filter("meets").collect()} and len(lines) > 60


def test_closed_roads_match(spark):
    """A loop has azimuth 0, so the angle rule can pass."""
    loop = [(105.81, 21.01), (105.8102, 21.01), (105.8102, 21.0102), (105.81, 21.0102), (105.81, 21.01)]
    segments = spark.createDataFrame([("s", loop)], f"segment_id string, geometry {LINE}").selectExpr(
        "segment_id", f"{spatial.geo.bearing('geometry')} as azimuth", "geometry")
    lines = spark.createDataFrame([(1, [(105.8099, 21.00995), (105.8103, 21.0103)])], f"i bigint, line {LINE}")
    kept = matching.apply_rules(matching.match_metrics(lines, segments, "i")).collect()
    assert [r.segment_id for r in kept] == ["s"] and kept[0].overlap_length > 20


@pytest.mark.parametrize("cell_rows,cell_pairs", [(10_000, 4096), (5, 1)])
def test_overlap_length_against_sampling(spark, tables, cell_rows, cell_pairs):
    segments = tables[1].selectExpr("cast(j as string) as segment_id", "0D as azimuth", "geometry")
    got = {(r.i, int(r.segment_id)): r.overlap_length for r in matching.match_metrics(
        tables[0], segments, "i", RADIUS * 4, candidate="buffer", cell_rows=cell_rows, cell_pairs=cell_pairs).collect()}
    rng, steps, checked = random.Random(3), 400, 0
    lines, segs = dict(LEFT), dict(RIGHT)
    for key in rng.sample(sorted(got), 60):
        total = 0.0
        for (x1, y1), (x2, y2) in zip(segs[key[1]], segs[key[1]][1:]):
            inside = sum(near(x1 + (k + 0.5) / steps * (x2 - x1), y1 + (k + 0.5) / steps * (y2 - y1), lines[key[0]]) <= RADIUS * 4 for k in range(steps))
            total += inside / steps * metres_at(x1, y1, x2, y2)
        assert got[key] == pytest.approx(total, abs=3.0)
        checked += total > 0
    assert checked > 30


def segment(spark, rows):
    return spark.createDataFrame(rows, f"segment_id string, azimuth double, geometry {LINE}")


def test_rules_on_short_and_turned_segments(spark):
    line = [(105.0, 21.0), (105.002, 21.0)]
    flow = spark.createDataFrame([(1, line)], f"i bigint, line {LINE}")
    segments = segment(spark, [
        ("short", 0.0, [(105.001, 20.99999), (105.001, 21.00001)]),      # about 2 m, crosses
        ("crossing", 0.0, [(105.001, 20.999), (105.001, 21.001)]),       # right angle: 90 passes
        ("back", 270.0, [(105.002, 21.0), (105.0, 21.0)]),               # the other way
        ("beside", 90.0, [(105.0, 21.0001), (105.002, 21.0001)]),        # inside the buffer only
        ("corner", 45.0, [(105.002, 21.0), (105.003, 21.001)]),          # touches the end
    ])
    got = {r.segment_id: r for r in matching.match_metrics(flow, segments, "i").collect()}
    assert set(got) == {"short", "crossing", "back", "corner"}
    assert got["short"].overlap_length == pytest.approx(2.2, abs=0.1) and got["back"].angle_diff == 180.0
    assert {r.segment_id for r in matching.apply_rules(matching.match_metrics(flow, segments, "i")).collect()} == {"crossing", "corner"}
    buffered = matching.apply_rules(matching.match_metrics(flow, segments, "i", candidate="buffer"))
    assert {r.segment_id for r in buffered.collect()} == {"crossing", "corner", "beside"}


def test_overlaps_of_many_pieces_count_once(spark):
    bent = [(105.0, 21.0), (105.001, 21.00005), (105.0, 21.0001), (105.001, 21.00005)]
    flow = spark.createDataFrame([(1, bent)], f"i bigint, line {LINE}")
    segments = segment(spark, [("s", 90.0, [(105.0, 21.00005), (105.0005, 21.00005), (105.0005, 21.00005), (105.001, 21.00005)])])
    row = matching.match_metrics(flow, segments, "i").first()
    assert row.overlap_length == pytest.approx(metres_at(105.0, 21.00005, 105.001, 21.00005), rel=1e-9)


def test_rollup_per_line_equals_rollup_per_record(spark, sf):
    """Rolling up equal lines first must not change any result."""
    flow = clean.clean_flow(fx.flow_raw(spark, sf)).cache()
    segments = roads.build_road_segments(fx.road_edges(spark, sf)).cache()
    pairs = matching.apply_rules(matching.match_metrics(flow.select("result_id", "line"), segments, "result_id"))
    plain = pairs.join(flow, "result_id").groupBy("segment_id").agg(
        F.avg("speed").alias("speed"), F.min("speed").alias("slowest"), F.max("jamFactor").alias("jam"), F.min_by("traversability", "result_id").alias("t"))
    wanted = {r.segment_id: (pytest.approx(r.speed * 3.6), r.jam, r.t) for r in plain.collect()}
    got = matching.match_traffic(flow, segments, cell_rows=20)
    assert {r.street_id: (r.speed, r.jamFactor, r.traversability) for r in got.collect()} == wanted
    slow = matching.match_traffic(flow, segments, speed_agg="min")
    assert {r.street_id: r.speed for r in slow.collect()} == {r.segment_id: pytest.approx(r.slowest * 3.6) for r in plain.collect()}


def test_snapshots_are_matched_one_by_one(spark, sf):
    flow = clean.clean_flow(fx.flow_raw(spark, sf)).cache()
    segments = roads.build_road_segments(fx.road_edges(spark, sf)).cache()
    hours = [r[0] for r in flow.groupBy("timestamp").count().orderBy(F.desc("count"), "timestamp").limit(2).collect()]
    every = matching.match_snapshots(flow, segments)
    for hour in hours:
        alone = matching.match_traffic(flow.filter(F.col("timestamp") == hour), segments)
        assert sorted(map(str, every.filter(F.col("timestamp") == hour).collect())) == sorted(map(str, alone.collect()))


def test_rollup_without_result_id_is_repeatable(spark, sf):
    flow = clean.clean_flow(fx.flow_raw(spark, sf)).drop("result_id")
    one, two = (sorted(map(str, matching.roll_up_lines(f).select("n", "first").collect())) for f in (flow, flow.repartition(5)))
    assert one == two


def test_plan_stays_small(spark, sf):
    """Rules on top of the clip must not make the optimiser repeat the clip."""
    flow = fx.flow_raw(spark, sf).select("result_id", "line")
    found = matching.apply_rules(matching.match_metrics(flow, roads.build_road_segments(fx.road_edges(spark, sf)), "result_id"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 120_000 and "CartesianProduct" not in plan
    physical = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in physical and "Cartesian" not in physical


def test_ranges_need_no_window(spark, sf):
    """The newest rows come from one bounded list per task, at any limit."""
    from roadpulse.operators import serving

    events, segments = fx.traffic_events(spark, sf), roads.build_road_segments(fx.road_edges(spark, sf))
    for limit in (10, 4000):
        found = serving.traffic_range(events, segments, "2024-01-10 00:00:00", "2024-01-20 12:00:00", None, 17, limit=limit)
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "TakeOrderedAndProject" in plan and "Window" not in plan


def test_segment_files_split_a_dense_tile(spark, sf, tmp_path):
    from roadpulse.sources import tables as stored

    segments = roads.build_road_segments(fx.road_edges(spark, sf), id_scope="edge")
    near = segments.selectExpr("segment_id", "geometry").limit(400)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        stored.write_segments(near, str(tmp_path / "s"))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    files = spark.read.parquet(str(tmp_path / "s")).selectExpr("_metadata.file_name as f").groupBy("f").count().collect()
    assert len(files) >= 3


def test_pairs_run_as_compiled_code(spark, tables):
    """The JVM compiles methods of up to 8,000 bytes only; what Spark makes of the steps of a pair stays below."""
    segments = tables[1].selectExpr("string(j) as segment_id", "0D as azimuth", "geometry")
    metrics = matching.match_metrics(tables[0], segments, "i")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        made = metrics.select("*")._jdf.queryExecution().debug().codegenToSeq()
        largest = max(made.apply(i)._3().maxMethodCodeSize() for i in range(made.size()))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert 0 < largest < 8000


def test_pieces_without_a_coordinate_are_left_out(spark):
    rows = [(1, [(105.81, 21.01), (105.811, 21.011)]), (2, [(105.81, 21.01), (None, 21.011)])]
    lines = spark.createDataFrame(rows, f"i bigint, line {LINE}")
    found = spatial.intersecting_lines(lines, lines.withColumnsRenamed({"i": "j"}), "i", "j", left_line="line", right_line="line")
    assert [tuple(r) for r in found.collect()] == [(1, 1)]
