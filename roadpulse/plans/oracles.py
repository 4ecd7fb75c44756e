"""Plain SQL that DuckDB runs on the given tables, one per query that SQL can express.

The texts work on end points and brute-force joins, not on the library's grid, arrays or
line pieces, so that the two sides share no more than the formulas of the geometry.
"""

from __future__ import annotations

from roadpulse.functions.traffic import DEFAULT_COLOURS
from roadpulse.plans.fixtures import CTES
from roadpulse.plans.queries import END, START, WINDOW

_A, _E2 = "6378137.0", "0.0066943799901413165"


def _metres(x1: str, y1: str, x2: str, y2: str) -> str:
    mid = f"radians((({y1}) + ({y2})) / 2)"
    w = f"(1 - {_E2}::DOUBLE * sin({mid}) * sin({mid}))"
    return (f"sqrt(pow(radians(({y2}) - ({y1})) * {_A}::DOUBLE * (1 - {_E2}::DOUBLE) / ({w} * sqrt({w})), 2) + "
            f"pow(radians(({x2}) - ({x1})) * cos({mid}) * {_A}::DOUBLE / sqrt({w}), 2))")


def _azimuth(x1: str, y1: str, x2: str, y2: str) -> str:
    turn = f"degrees(atan2(({x2}) - ({x1}), ({y2}) - ({y1})))"
    return f"CASE WHEN {turn} < 0 THEN {turn} + 360 ELSE {turn} END"


def _side(ax: str, ay: str, bx: str, by: str, cx: str, cy: str) -> str:
    return f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def _meets(a: str, b: str) -> str:
    """Two straight lines share a point; both have sx, sy, ex, ey."""
    p, q = [f"{a}.{c}" for c in ("sx", "sy", "ex", "ey")], [f"{b}.{c}" for c in ("sx", "sy", "ex", "ey")]
    box = " AND ".join(f"least({p[i]}, {p[i + 2]}) <= greatest({q[i]}, {q[i + 2]}) AND greatest({p[i]}, {p[i + 2]}) >= least({q[i]}, {q[i + 2]})"
                       for i in (0, 1))
    return (f"{box} AND {_side(*p, *q[:2])} * {_side(*p, *q[2:])} <= 0 AND {_side(*q, *p[:2])} * {_side(*q, *p[2:])} <= 0")


_ITEMS = "list_filter(list_transform(string_split(regexp_replace(maxspeed, '[\\[\\]''\"]', '', 'g'), ','), lambda s: trim(s)), lambda s: s <> '')"
_SPEED = f"""CASE WHEN maxspeed IS NULL OR maxspeed IN ('', 'nan') THEN NULL
 WHEN contains(maxspeed, '[') THEN CASE WHEN len(list_filter({_ITEMS}, lambda s: TRY_CAST(s AS DOUBLE) IS NULL)) = 0
      THEN list_min(list_transform({_ITEMS}, lambda s: TRY_CAST(s AS DOUBLE))) END
 ELSE TRY_CAST(maxspeed AS DOUBLE) END"""

_EDGES = f"""SELECT DISTINCT osmid, u, v, name, oneway, highway, maxspeed, lanes, {_SPEED} AS speed_limit,
 x1 / 1e6::DOUBLE AS sx, y1 / 1e6::DOUBLE AS sy, x2 / 1e6::DOUBLE AS ex, y2 / 1e6::DOUBLE AS ey,
 x1, y1, x2, y2 FROM road_edges_raw WHERE u <> v"""

_PLAN = f"""SELECT *, m AS line_m, CAST(greatest(ceil(m / 100), 1) AS BIGINT) AS chunks
FROM (SELECT *, {_metres('sx', 'sy', 'ex', 'ey')} AS m FROM edges) t"""

_FRACTIONS = """SELECT *, chunk * 100 / line_m AS begin_at,
 CASE WHEN chunk = chunks - 1 THEN 1.0::DOUBLE ELSE (chunk + 1) * 100 / line_m END AS end_at
FROM (SELECT *, unnest(range(chunks)) AS chunk FROM plan) t"""

_SEGS = f"""SELECT *, {_metres('sx', 'sy', 'ex', 'ey')} AS length, {_azimuth('sx', 'sy', 'ex', 'ey')} AS azimuth FROM (
 SELECT osmid || '_' || CAST(chunk AS VARCHAR) AS segment_id, osmid, u, v, name, oneway, highway, speed_limit, lanes,
  sx + begin_at * (ex - sx) AS sx, sy + begin_at * (ey - sy) AS sy,
  CASE WHEN end_at = 1 THEN ex ELSE sx + end_at * (ex - sx) END AS ex, CASE WHEN end_at = 1 THEN ey ELSE sy + end_at * (ey - sy) END AS ey
 FROM fractions QUALIFY row_number() OVER (PARTITION BY osmid, chunk ORDER BY u, v) = 1) t"""

_CLEAN = """SELECT result_id, CAST(source_updated AS TIMESTAMP) AS timestamp, street_name, traverse_length, speed, free_flow AS freeFlowSpeed,
 coalesce(jam_factor, greatest(0.0, least(10.0, 10 * (1 - speed / free_flow)))) AS jamFactor, confidence,
 coalesce(traversability, 'open') AS traversability, ax, ay, bx, by_
FROM flow_raw WHERE speed > 0 AND traverse_length > 0 AND free_flow > 0 AND confidence >= 0.7"""

_LINES = """SELECT result_id, ax / 1e6::DOUBLE AS sx, ay / 1e6::DOUBLE AS sy, bx / 1e6::DOUBLE AS ex, by_ / 1e6::DOUBLE AS ey FROM {rows}"""

_R = "0.00015::DOUBLE"

# Pairs whose boxes meet once the line is grown by the buffer, with the vectors of the clip:
# p from line start to segment start, d along the segment, e along the line.
_NEAR = f"""SELECT l.result_id, s.segment_id, ({_meets('l', 's')}) AS meets, s.sx, s.sy, s.ex, s.ey,
 {_azimuth('l.sx', 'l.sy', 'l.ex', 'l.ey')} AS line_angle, s.azimuth AS seg_angle,
 s.sx - l.sx AS px, s.sy - l.sy AS py, s.ex - s.sx AS dx, s.ey - s.sy AS dy, l.ex - l.sx AS vx, l.ey - l.sy AS vy
FROM lines l JOIN segs s ON least(l.sx, l.ex) - {_R} <= greatest(s.sx, s.ex) AND greatest(l.sx, l.ex) + {_R} >= least(s.sx, s.ex)
 AND least(l.sy, l.ey) - {_R} <= greatest(s.sy, s.ey) AND greatest(l.sy, l.ey) + {_R} >= least(s.sy, s.ey)"""

_CLIP1 = f"""SELECT *, (vx*vx + vy*vy) AS vv, (dx*dx + dy*dy) AS dd, (px*vx + py*vy) AS pv, (dx*vx + dy*vy) AS dv,
 (px*dx + py*dy) AS pd, (px*px + py*py) AS pp, (vx*py - vy*px) AS hp, (vx*dy - vy*dx) AS hd FROM near"""
_CLIP2 = f"""SELECT *, pd*pd - dd*(pp - {_R}*{_R}) AS q1, (pd-dv)*(pd-dv) - dd*(pp - 2*pv + vv - {_R}*{_R}) AS q2, {_R}*sqrt(vv) AS h FROM clip1"""
_CLIP3 = """SELECT *,
 CASE WHEN hd = 0 THEN CASE WHEN abs(hp) <= h THEN 0 END ELSE least((-h-hp)/hd, (h-hp)/hd) END AS w0,
 CASE WHEN hd = 0 THEN CASE WHEN abs(hp) <= h THEN 1 END ELSE greatest((-h-hp)/hd, (h-hp)/hd) END AS w1,
 CASE WHEN dv = 0 THEN CASE WHEN pv BETWEEN 0 AND vv THEN 0 END ELSE least(-pv/dv, (vv-pv)/dv) END AS g0,
 CASE WHEN dv = 0 THEN CASE WHEN pv BETWEEN 0 AND vv THEN 1 END ELSE greatest(-pv/dv, (vv-pv)/dv) END AS g1,
 CASE WHEN q1 >= 0 THEN (-pd - sqrt(CASE WHEN q1 >= 0 THEN q1 END))/dd END AS n0, CASE WHEN q1 >= 0 THEN (-pd + sqrt(CASE WHEN q1 >= 0 THEN q1 END))/dd END AS n1,
 CASE WHEN q2 >= 0 THEN (dv-pd - sqrt(CASE WHEN q2 >= 0 THEN q2 END))/dd END AS f0, CASE WHEN q2 >= 0 THEN (dv-pd + sqrt(CASE WHEN q2 >= 0 THEN q2 END))/dd END AS f1
FROM clip2"""
_CLIP4 = """SELECT *,
 least(CASE WHEN w0 IS NOT NULL AND g0 IS NOT NULL AND greatest(w0,g0,0) <= least(w1,g1,1) THEN greatest(w0,g0,0) END,
       CASE WHEN n0 IS NOT NULL AND greatest(n0,0) <= least(n1,1) THEN greatest(n0,0) END,
       CASE WHEN f0 IS NOT NULL AND greatest(f0,0) <= least(f1,1) THEN greatest(f0,0) END) AS lo,
 greatest(CASE WHEN w0 IS NOT NULL AND g0 IS NOT NULL AND greatest(w0,g0,0) <= least(w1,g1,1) THEN least(w1,g1,1) END,
       CASE WHEN n0 IS NOT NULL AND greatest(n0,0) <= least(n1,1) THEN least(n1,1) END,
       CASE WHEN f0 IS NOT NULL AND greatest(f0,0) <= least(f1,1) THEN least(f1,1) END) AS hi FROM clip3"""
_METRICS = f"""SELECT result_id, segment_id, meets, lo, least(abs(line_angle - seg_angle), 360 - abs(line_angle - seg_angle)) AS angle_diff,
 coalesce({_metres('sx + lo*dx', 'sy + lo*dy', 'sx + hi*dx', 'sy + hi*dy')}, 0) AS overlap_length FROM clip4"""

_EVENTS = """SELECT event_id, street_id, CAST(ts AS TIMESTAMP) AS timestamp, speed, jam_factor AS "jamFactor", confidence, traversability,
 free_flow * 3.6::DOUBLE AS "freeFlowSpeed", congestion_level FROM traffic_events_fx"""

_LATEST = "SELECT * FROM ev QUALIFY row_number() OVER (PARTITION BY street_id ORDER BY timestamp DESC, event_id DESC) = 1"

_XMIN, _YMIN, _XMAX, _YMAX = (f"{v}::DOUBLE" for v in WINDOW)
_CORNERS = ", ".join(_side("s.sx", "s.sy", "s.ex", "s.ey", x, y) for x in (_XMIN, _XMAX) for y in (_YMIN, _YMAX))
_IN_WINDOW = (f"least(s.sx, s.ex) <= {_XMAX} AND greatest(s.sx, s.ex) >= {_XMIN} AND least(s.sy, s.ey) <= {_YMAX} "
              f"AND greatest(s.sy, s.ey) >= {_YMIN} AND least({_CORNERS}) <= 0 AND greatest({_CORNERS}) >= 0")

# Roads as whole micro-degrees: how two straight axis lines relate can be told exactly.
_CONTACT = """SELECT *, d_ab = 0 AND o1 = 0 AND o2 = 0 AS flat,
 CASE WHEN dda = 0 THEN NULL ELSE greatest(0, least(t1, t2)) END AS lo, CASE WHEN dda = 0 THEN NULL ELSE least(dda, greatest(t1, t2)) END AS hi,
 greatest(0, least(u1, u2)) AS rlo, least(ddb, greatest(u1, u2)) AS rhi
FROM (SELECT *, (ax2-ax1)*(by2-by1) - (ay2-ay1)*(bx2-bx1) AS d_ab,
  (ax2-ax1)*(by1-ay1) - (ay2-ay1)*(bx1-ax1) AS o1, (ax2-ax1)*(by2-ay1) - (ay2-ay1)*(bx2-ax1) AS o2,
  (bx2-bx1)*(ay1-by1) - (by2-by1)*(ax1-bx1) AS o3, (bx2-bx1)*(ay2-by1) - (by2-by1)*(ax2-bx1) AS o4,
  (ax2-ax1)*(ax2-ax1) + (ay2-ay1)*(ay2-ay1) AS dda, (bx2-bx1)*(bx2-bx1) + (by2-by1)*(by2-by1) AS ddb,
  (bx1-ax1)*(ax2-ax1) + (by1-ay1)*(ay2-ay1) AS t1, (bx2-ax1)*(ax2-ax1) + (by2-ay1)*(ay2-ay1) AS t2,
  (ax1-bx1)*(bx2-bx1) + (ay1-by1)*(by2-by1) AS u1, (ax2-bx1)*(bx2-bx1) + (ay2-by1)*(by2-by1) AS u2 FROM {pairs}) t
WHERE least(ax1,ax2) <= greatest(bx1,bx2) AND greatest(ax1,ax2) >= least(bx1,bx2) AND least(ay1,ay2) <= greatest(by1,by2)
 AND greatest(ay1,ay2) >= least(by1,by2) AND sign(o1) * sign(o2) <= 0 AND sign(o3) * sign(o4) <= 0"""

_KIND = """CASE WHEN flat AND hi > lo THEN CASE WHEN (lo = 0 AND hi = dda) OR (rlo = 0 AND rhi = ddb) THEN 'other' ELSE 'overlaps' END
 WHEN flat THEN 'touches' WHEN o1 = 0 OR o2 = 0 OR o3 = 0 OR o4 = 0 THEN 'touches' ELSE 'crosses' END AS kind"""

_ROAD_PAIRS = """SELECT a.osmid AS osmid_1, a.u AS u_1, a.v AS v_1, a.name AS name_1, b.osmid AS osmid_2, b.u AS u_2, b.v AS v_2, b.name AS name_2,
 a.x1 AS ax1, a.y1 AS ay1, a.x2 AS ax2, a.y2 AS ay2, b.x1 AS bx1, b.y1 AS by1, b.x2 AS bx2, b.y2 AS by2
FROM edges a JOIN edges b ON a.x1 <= b.x2 AND a.x2 >= b.x1 AND a.y1 <= b.y2 AND a.y2 >= b.y1 AND (a.osmid, a.u, a.v) < (b.osmid, b.u, b.v)"""

_SEG_PAIRS = """SELECT a.segment_id AS segment_id_1, b.segment_id AS segment_id_2, a.osmid AS osmid_1, b.osmid AS osmid_2,
 a.sx AS ax1, a.sy AS ay1, a.ex AS ax2, a.ey AS ay2, b.sx AS bx1, b.sy AS by1, b.ex AS bx2, b.ey AS by2
FROM segs a JOIN segs b ON a.sx <= b.ex AND a.ex >= b.sx AND a.sy <= b.ey AND a.ey >= b.sy AND a.segment_id < b.segment_id"""

# Bent lines piece by piece; a closed line has angle 0, as atan2(0, 0).
_BENT_SEGS = " UNION ALL ".join(
    f"SELECT CAST(u AS VARCHAR) AS segment_id, way, {i} AS part, x{i} / 1e6::DOUBLE AS sx, y{i} / 1e6::DOUBLE AS sy, x{i + 1} / 1e6::DOUBLE AS ex, "
    f"y{i + 1} / 1e6::DOUBLE AS ey, {_azimuth('x0', 'y0', 'x3', 'y3')} AS azimuth, x{i} AS ix1, y{i} AS iy1, x{i + 1} AS ix2, y{i + 1} AS iy2 FROM bent_roads_fx" for i in range(3))
_BENT_LINES = " UNION ALL ".join(
    f"SELECT result_id, x{i} / 1e6::DOUBLE AS sx, y{i} / 1e6::DOUBLE AS sy, x{i + 1} / 1e6::DOUBLE AS ex, y{i + 1} / 1e6::DOUBLE AS ey, "
    f"{_azimuth('x0', 'y0', 'x2', 'y2')} AS angle FROM bent_flow_fx" for i in range(2))
_BENT_NEAR = (_NEAR.replace(f"{_azimuth('l.sx', 'l.sy', 'l.ex', 'l.ey')} AS line_angle", "l.angle AS line_angle, s.part")
              .replace("FROM lines l JOIN segs s", "FROM bent_l l JOIN bent_s s"))
# Stretches of one road piece in order; each adds what reaches past the furthest end so far.
_BENT_RUNS = """SELECT *, greatest(lo, coalesce(max(hi) OVER (PARTITION BY result_id, segment_id, part ORDER BY lo, hi
 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS since FROM bent_clip4 WHERE lo IS NOT NULL"""
_BENT_METRICS = f"""SELECT m.result_id, m.segment_id, m.angle_diff, coalesce(r.metres, 0) AS overlap_length FROM
 (SELECT result_id, segment_id, any_value(least(abs(line_angle - seg_angle), 360 - abs(line_angle - seg_angle))) AS angle_diff
  FROM bent_clip4 GROUP BY result_id, segment_id HAVING bool_or(meets)) m LEFT JOIN
 (SELECT result_id, segment_id, sum(CASE WHEN hi > since THEN {_metres('sx + since*dx', 'sy + since*dy', 'sx + hi*dx', 'sy + hi*dy')} ELSE 0 END) AS metres
  FROM bent_runs GROUP BY result_id, segment_id) r ON m.result_id = r.result_id AND m.segment_id = r.segment_id"""

_PARTS = {
    **CTES,
    "edges": _EDGES, "plan": _PLAN, "fractions": _FRACTIONS, "segs": _SEGS,
    "clean": _CLEAN, "lines": _LINES.format(rows="flow_raw"), "clean_lines": _LINES.format(rows="clean"),
    "near": _NEAR, "clip1": _CLIP1, "clip2": _CLIP2, "clip3": _CLIP3, "clip4": _CLIP4, "metrics": _METRICS,
    "bent_s": _BENT_SEGS, "bent_l": _BENT_LINES, "bent_near": _BENT_NEAR, "bent_clip1": _CLIP1.replace("FROM near", "FROM bent_near"),
    "bent_clip2": _CLIP2.replace("FROM clip1", "FROM bent_clip1"), "bent_clip3": _CLIP3.replace("FROM clip2", "FROM bent_clip2"),
    "bent_clip4": _CLIP4.replace("FROM clip3", "FROM bent_clip3"), "bent_runs": _BENT_RUNS, "bent_metrics": _BENT_METRICS,
    "ev": _EVENTS, "latest": _LATEST,
    "road_pairs": _ROAD_PAIRS, "road_contacts": _CONTACT.format(pairs="road_pairs"), "road_kinds": f"SELECT *, {_KIND} FROM road_contacts",
    "seg_pairs": _SEG_PAIRS, "seg_contacts": _CONTACT.format(pairs="seg_pairs"), "seg_kinds": f"SELECT *, {_KIND} FROM seg_contacts",
}
_NEEDS = {
    "flow_raw": ["road_edges_raw"], "traffic_events_fx": ["flow_raw", "road_edges_raw"], "edges": ["road_edges_raw"], "plan": ["edges"],
    "fractions": ["plan"], "segs": ["fractions"], "clean": ["flow_raw"], "lines": ["flow_raw"], "clean_lines": ["clean"],
    "bent_roads_fx": ["road_edges_raw"], "bent_flow_fx": ["bent_roads_fx"], "bent_s": ["bent_roads_fx"], "bent_l": ["bent_flow_fx"],
    "bent_near": ["bent_l", "bent_s"], "bent_clip1": ["bent_near"], "bent_clip2": ["bent_clip1"], "bent_clip3": ["bent_clip2"],
    "bent_clip4": ["bent_clip3"], "bent_runs": ["bent_clip4"], "bent_metrics": ["bent_runs"],
    "near": ["lines", "segs"], "clip1": ["near"], "clip2": ["clip1"], "clip3": ["clip2"], "clip4": ["clip3"], "metrics": ["clip4"],
    "ev": ["traffic_events_fx"], "latest": ["ev"], "road_pairs": ["edges"], "road_contacts": ["road_pairs"], "road_kinds": ["road_contacts"],
    "seg_pairs": ["segs"], "seg_contacts": ["seg_pairs"], "seg_kinds": ["seg_contacts"],
}


def _order(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name not in seen:
            _order(_NEEDS.get(name, []), seen)
            seen.append(name)
    return seen


def _sql(uses: str, body: str, clean_only: bool = False) -> str:
    names = _order(uses.split(), [])
    parts = dict(_PARTS)
    if clean_only:
        # The same matching on cleaned flow only.
        names = _order(["clean"], []) + [n for n in names if n not in ("flow_raw", "road_edges_raw")]
        parts["lines"] = _PARTS["clean_lines"]
    return "WITH " + ",\n".join(f"{n} AS ({parts[n].strip()})" for n in names) + "\n" + body.strip()


_ENDS = "round(sx, 7) AS start_x, round(sy, 7) AS start_y, round(ex, 7) AS end_x, round(ey, 7) AS end_y"
_EVENT_COLUMNS = """street_id, timestamp, congestion_level, round(speed, 6) AS speed, "jamFactor", confidence, traversability, round("freeFlowSpeed", 6) AS "freeFlowSpeed" """
_ROAD = f"s.name AS street_name, s.highway, s.oneway, {_ENDS}"
_TIER_13 = "'motorway','trunk','trunk_link','primary','primary_link','secondary','secondary_link'"
_TIER_15 = _TIER_13 + ",'tertiary','tertiary_link'"
_TIER_11 = "'motorway','trunk','primary'"
_RANGE = f"timestamp BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'"
_LEVEL = "CASE WHEN {j} >= 7 THEN 'High' WHEN {j} >= 4 THEN 'Medium' ELSE 'Low' END"
_LABELLED = "clean LEFT JOIN street_labels_fx l USING (street_name)"
_RATIO = """CASE WHEN "freeFlowSpeed" > 0 AND speed IS NOT NULL THEN CASE WHEN speed / nullif("freeFlowSpeed", 0) > 0.7 THEN 'low'
 WHEN speed / nullif("freeFlowSpeed", 0) > 0.4 THEN 'medium' WHEN speed / nullif("freeFlowSpeed", 0) > 0.2 THEN 'high' ELSE 'severe' END ELSE 'default' END"""


def _display(level: str) -> str:
    return (f"CASE WHEN {level} IS NOT NULL THEN lower({level}) WHEN \"jamFactor\" < 1 THEN 'low' WHEN \"jamFactor\" < 2 THEN 'medium' "
            f"WHEN \"jamFactor\" < 3 THEN 'high' WHEN \"jamFactor\" IS NOT NULL THEN 'severe' ELSE {_RATIO} END")


def _width(level: str) -> str:
    return (f"CASE highway WHEN 'motorway' THEN 4.0 WHEN 'trunk' THEN 4.0 WHEN 'primary' THEN 3.5 WHEN 'secondary' THEN 3.0 "
            f"WHEN 'residential' THEN 2.0 WHEN 'unclassified' THEN 2.0 ELSE 2.5 END::DOUBLE + "
            f"CASE {level} WHEN 'High' THEN 1.0 WHEN 'Medium' THEN 0.5 ELSE 0.0 END::DOUBLE")


_MATCHED_EVENTS = f"""SELECT segment_id AS street_id, max(timestamp) AS timestamp, round({{speed}}(speed) * 3.6::DOUBLE, 6) AS speed,
 round(max("jamFactor"), 6) AS "jamFactor", max(confidence) AS confidence, arg_min(traversability, result_id) AS traversability,
 round(arg_min("freeFlowSpeed", result_id) * 3.6::DOUBLE, 6) AS "freeFlowSpeed", {_LEVEL.format(j='max("jamFactor")')} AS congestion_level
FROM metrics JOIN clean USING (result_id) WHERE {{rule}} GROUP BY segment_id"""


def all_oracles() -> dict[str, str]:
    flow_columns = 'street_name, traverse_length, speed, "jamFactor", confidence, traversability, "freeFlowSpeed"'
    columns = ["result_id", "timestamp", "street_name", "traverse_length", "speed", "jamFactor", "confidence", "traversability", "freeFlowSpeed"]
    source = {"timestamp": "source_updated", "jamFactor": "jam_factor", "freeFlowSpeed": "free_flow"}
    bad = {"jamFactor": "jam_factor NOT BETWEEN 0 AND 9.5", "confidence": "confidence NOT BETWEEN 0 AND 0.95"}
    report = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS \"rows\", count(*) FILTER (WHERE {source.get(c, c)} IS NULL) AS nulls, "
        f"round(count(*) FILTER (WHERE {source.get(c, c)} IS NULL) / count(*)::DOUBLE, 9) AS null_share, "
        f"count(*) FILTER (WHERE {bad.get(c, 'false')}) AS out_of_range FROM flow_raw" for c in columns)
    mid = "(ax + bx) / 2e6::DOUBLE", "(ay + by_) / 2e6::DOUBLE"
    xy = [("ax / 1e6::DOUBLE", "ay / 1e6::DOUBLE"), mid, ("bx / 1e6::DOUBLE", "by_ / 1e6::DOUBLE")]
    wkt = " || ', ' || ".join(f"CAST({x} AS VARCHAR) || ' ' || CAST({y} AS VARCHAR)" for x, y in xy)
    points = ", ".join(f"round({v}, 7) AS {a}{i}" for i, p in enumerate(xy) for a, v in zip("xy", p))
    styled = "CASE WHEN highway <> 'trunk' THEN congestion_level END"
    window_sql = f'round(avg(speed), 6) AS avg_speed, round(avg("jamFactor"), 6) AS avg_jam, max("jamFactor") AS max_jam'
    return {
        "flow_flatten": _sql("flow_raw", f"""SELECT source_updated::TIMESTAMP AS timestamp, street_name, traverse_length, 2::BIGINT AS links, speed,
            jam_factor AS "jamFactor", confidence, traversability, free_flow AS "freeFlowSpeed" FROM flow_raw"""),
        "clean_flow": _sql("clean", f'SELECT result_id, timestamp, {flow_columns.replace(chr(34) + "jamFactor" + chr(34), "round(jamFactor, 9) AS " + chr(34) + "jamFactor" + chr(34))} FROM clean'),
        "clean_flow_named": _sql("clean", "SELECT street_name, count(*) AS n, round(avg(jamFactor), 6) AS avg_jam FROM clean WHERE confidence >= 0.9 AND trim(street_name) <> '' GROUP BY street_name"),
        "jam_impute": _sql("flow_raw", "SELECT result_id, CASE WHEN speed / nullif(free_flow, 0) IS NOT NULL THEN round(greatest(0.0, least(10.0, 10 * (1 - speed / nullif(free_flow, 0)))), 9) END AS jam FROM flow_raw WHERE jam_factor IS NULL"),
        "congestion_level": _sql("flow_raw", f"SELECT result_id, jam_factor AS \"jamFactor\", {_LEVEL.format(j='jam_factor')} AS level, round(speed * 3.6::DOUBLE, 6) AS speed_kmh FROM flow_raw"),
        "snapshot_key": _sql("flow_raw", "SELECT replace(replace(strftime(source_updated, '%Y-%m-%d %H:%M:%S'), ' ', '_'), ':', '-') AS snapshot, count(*) AS results FROM flow_raw GROUP BY source_updated"),
        "polyline_wkt": _sql("flow_raw", f"SELECT 'LINESTRING(' || {wkt} || ')' AS wkt, count(*) AS n FROM flow_raw GROUP BY 1"),
        "polyline_points": _sql("flow_raw", f"SELECT 3::BIGINT AS points, {points}, count(*) AS n FROM flow_raw GROUP BY ALL"),
        "normalise_edges": _sql("road_edges_raw", """SELECT '[' || u || ', ' || u_v.v || ']' AS osmid, u, u_v.v AS v, '[''' || name || ''', ''' || highway || ''']' AS name,
            oneway, highway, maxspeed, lanes FROM road_edges_raw u_v"""),
        "edge_dedup": _sql("edges", f"SELECT osmid, u, v, name, highway, {_ENDS} FROM edges"),
        "speed_limit_clean": _sql("road_edges_raw", f"SELECT u, v, maxspeed, {_SPEED} AS speed_limit FROM road_edges_raw"),
        "list_text_items": _sql("road_edges_raw", f"""SELECT u, v, CASE WHEN contains(maxspeed, '[') THEN array_to_string({_ITEMS}, '|') WHEN maxspeed NOT IN ('', 'nan') THEN maxspeed END AS items,
            CASE WHEN contains(maxspeed, '[') THEN len({_ITEMS}) WHEN maxspeed NOT IN ('', 'nan') THEN 1 WHEN true THEN {{missing}} END::BIGINT AS n FROM road_edges_raw""".replace("{missing}", "NULL")),
        "edge_metrics": _sql("edges", f"""SELECT u, v, osmid, name, oneway, highway, speed_limit, lanes, round({_metres('sx', 'sy', 'ex', 'ey')}, 4) AS length,
            round({_azimuth('sx', 'sy', 'ex', 'ey')}, 6) AS azimuth FROM edges"""),
        "segment_plan": _sql("fractions", "SELECT osmid, u, v, chunks, chunk, round(begin_at, 9) AS begin_at, round(end_at, 9) AS end_at FROM fractions"),
        "segment_split": _sql("segs", f"SELECT segment_id, osmid, u, v, name, oneway, highway, speed_limit, lanes, round(azimuth, 6) AS azimuth, round(length, 4) AS length, {_ENDS} FROM segs"),
        "multi_line_segments": _sql("plan", "SELECT osmid, u, v, 2 * n AS pieces, 0::BIGINT AS first, 2 * n - 1 AS last, 2 * n AS ids, round(2 * line_m, 3) AS total FROM (SELECT *, CAST(greatest(ceil(line_m / 100), 1) AS BIGINT) AS n FROM plan)"),
        "segment_split_by_edge": _sql("plan", "SELECT osmid, u, v, CAST(greatest(ceil(line_m / 250), 1) AS BIGINT) AS pieces, round(line_m, 3) AS total FROM plan"),
        "geometry_round_trip": _sql("road_edges_raw", """SELECT u, round(x1 / 1e6::DOUBLE, 7) AS start_x, round(y1 / 1e6::DOUBLE, 7) AS start_y, round(x2 / 1e6::DOUBLE, 7) AS end_x,
            round(y2 / 1e6::DOUBLE, 7) AS end_y, round(y1 / 1e6::DOUBLE, 7) AS flip_x, true AS same FROM road_edges_raw"""),
        "spatial_candidates": _sql("lines segs", f"SELECT l.result_id, s.segment_id FROM lines l JOIN segs s ON {_meets('l', 's')}"),
        "match_metrics": _sql("metrics", "SELECT result_id, segment_id, round(angle_diff, 6) AS angle_diff, round(overlap_length, 4) AS overlap_length FROM metrics WHERE meets"),
        "overlap_stats": _sql("metrics", "SELECT round(min(overlap_length), 4) AS min_overlap_length, round(max(overlap_length), 4) AS max_overlap_length, round(avg(overlap_length), 4) AS avg_overlap_length FROM metrics WHERE meets"),
        "map_match": _sql("metrics", _MATCHED_EVENTS.format(speed="avg", rule="meets AND angle_diff <= 90 AND overlap_length > 5"), clean_only=True),
        "map_match_buffer": _sql("metrics", _MATCHED_EVENTS.format(speed="min", rule="lo IS NOT NULL AND angle_diff <= 90 AND overlap_length > 40"), clean_only=True),
        "map_match_snapshots": _sql("metrics", _MATCHED_EVENTS.format(speed="avg", rule="meets AND angle_diff <= 90 AND overlap_length > 5") + ", timestamp", clean_only=True),
        "segment_rollup": _sql("metrics", """SELECT m.segment_id, count(*) AS records, max(timestamp) AS timestamp, arg_min(traversability, result_id) AS traversability,
            arg_min(traverse_length, result_id) AS traverse_length, any_value(s.name) AS street_name, any_value(s.oneway) AS oneway,
            round(any_value(s.length), 4) AS segment_length, round(avg(speed), 6) AS speed
            FROM metrics m JOIN clean USING (result_id) JOIN segs s ON s.segment_id = m.segment_id
            WHERE meets AND angle_diff <= 90 AND overlap_length > 5 GROUP BY m.segment_id""", clean_only=True),
        "run_summary": _sql("metrics", """SELECT i AS input_count, st AS static_count, c AS candidate_count, f AS final_count, coalesce(f * 100 // nullif(i, 0), 0) AS match_rate FROM (SELECT
            (SELECT count(*) FROM clean) AS i, (SELECT count(*) FROM segs) AS st, count(*) FILTER (WHERE meets) AS c,
            count(DISTINCT CASE WHEN meets AND angle_diff <= 90 AND overlap_length > 5 THEN segment_id END) AS f FROM metrics) t""", clean_only=True),
        "bent_split": _sql("bent_s", f"SELECT CAST(segment_id AS BIGINT) AS u, CAST(greatest(ceil(sum(m) / 60), 1) AS BIGINT) AS pieces, round(sum(m), 3) AS total FROM (SELECT segment_id, {_metres('sx', 'sy', 'ex', 'ey')} AS m FROM bent_s) t GROUP BY segment_id"),
        "bent_candidates": _sql("bent_l bent_s", f"SELECT DISTINCT l.result_id, s.segment_id FROM bent_l l JOIN bent_s s ON {_meets('l', 's')}"),
        "bent_metrics": _sql("bent_metrics", "SELECT result_id, segment_id, round(angle_diff, 6) AS angle_diff, round(overlap_length, 4) AS overlap_length FROM bent_metrics"),
        "bent_match": _sql("bent_metrics", "SELECT segment_id, count(*) AS n, round(sum(overlap_length), 3) AS metres FROM bent_metrics WHERE angle_diff <= 90 AND overlap_length > 20 GROUP BY segment_id"),
        "bent_same_way": _sql("bent_s", """SELECT DISTINCT a.segment_id AS segment_id_1, b.segment_id AS segment_id_2 FROM bent_s a JOIN bent_s b ON a.way = b.way AND a.segment_id < b.segment_id
            AND a.iy1 = a.iy2 AND b.iy1 = b.iy2 AND a.iy1 = b.iy1 AND least(a.ix2, b.ix2) > greatest(a.ix1, b.ix1)"""),
        "snapshot_deliveries": _sql("clean", "SELECT timestamp, count(*) AS n, count(DISTINCT confidence >= 0.8) AS deliveries FROM clean GROUP BY timestamp"),
        "restated_delivery": _sql("flow_raw", """SELECT timestamp, count(*) AS n, round(sum(speed), 6) AS speeds, count_if(came = 2) AS restated FROM (
            SELECT source_updated AS timestamp, speed, traverse_length, free_flow, confidence, 1 AS came FROM flow_raw f WHERE NOT EXISTS (SELECT 1 FROM flow_raw r
              WHERE hour(r.source_updated) % 3 = 0 AND r.confidence >= 0.8 AND r.source_updated = f.source_updated AND r.street_name IS NOT DISTINCT FROM f.street_name
              AND (r.ax, r.ay, r.bx, r.by_) = (f.ax, f.ay, f.bx, f.by_))
            UNION ALL SELECT source_updated, speed + 1, traverse_length, free_flow, confidence, 2 FROM flow_raw WHERE hour(source_updated) % 3 = 0 AND confidence >= 0.8) t
            WHERE speed > 0 AND traverse_length > 0 AND free_flow > 0 AND confidence >= 0.7 GROUP BY timestamp"""),
        "geojson_features": _sql("latest segs", f"""SELECT 'Feature' AS type, street_id, s.name AS street_name, s.highway, s.oneway, congestion_level, confidence, traversability,
            round(speed, 6) AS speed, round("jamFactor", 6) AS jamfactor, round("freeFlowSpeed", 6) AS freeflowspeed, {_ENDS} FROM latest e JOIN segs s ON e.street_id = s.segment_id"""),
        "feature_collection": _sql("latest segs", f"""SELECT 'FeatureCollection' AS type, count(*) AS count, 13.0::DOUBLE AS zoom, {_XMIN} AS xmin, {_YMIN} AS ymin, {_XMAX} AS xmax, {_YMAX} AS ymax,
            {len(DEFAULT_COLOURS)}::BIGINT AS colours, string_agg(street_id, ',' ORDER BY timestamp DESC, street_id) AS streets FROM (SELECT street_id, timestamp FROM latest e JOIN segs s ON e.street_id = s.segment_id
            WHERE highway IN ({_TIER_13}) AND {_IN_WINDOW} ORDER BY timestamp DESC, street_id LIMIT 500) t"""),
        "overlap_locations": _sql("road_kinds", """SELECT osmid_1, u_1, v_1, osmid_2, u_2, v_2, kind, points, round(least(px, qx) / 1e6::DOUBLE, 7) AS xmin, round(least(py, qy) / 1e6::DOUBLE, 7) AS ymin,
            round(greatest(px, qx) / 1e6::DOUBLE, 7) AS xmax, round(greatest(py, qy) / 1e6::DOUBLE, 7) AS ymax FROM (SELECT *, CASE WHEN kind = 'crosses' THEN 1 ELSE 2 END::BIGINT AS points,
             CASE WHEN kind = 'crosses' THEN CASE WHEN ax1 = ax2 THEN ax1 ELSE bx1 END ELSE ax1 + lo / dda::DOUBLE * (ax2 - ax1) END AS px,
             CASE WHEN kind = 'crosses' THEN CASE WHEN ay1 = ay2 THEN ay1 ELSE by1 END ELSE ay1 + lo / dda::DOUBLE * (ay2 - ay1) END AS py,
             CASE WHEN kind = 'crosses' THEN CASE WHEN ax1 = ax2 THEN ax1 ELSE bx1 END ELSE ax1 + hi / dda::DOUBLE * (ax2 - ax1) END AS qx,
             CASE WHEN kind = 'crosses' THEN CASE WHEN ay1 = ay2 THEN ay1 ELSE by1 END ELSE ay1 + hi / dda::DOUBLE * (ay2 - ay1) END AS qy
             FROM road_kinds WHERE kind <> 'touches') t"""),
        "speed_outliers": _sql("ev", """SELECT speed NOT BETWEEN q0 - 1.5 * (q1 - q0) AND q1 + 1.5 * (q1 - q0) AS is_outlier, count(*) AS n FROM ev, (SELECT
             min(CASE WHEN upto >= 0.25 * total THEN speed END) AS q0, min(CASE WHEN upto >= 0.75 * total THEN speed END) AS q1 FROM
             (SELECT speed, sum(n) OVER (ORDER BY speed) AS upto, sum(n) OVER () AS total FROM (SELECT speed, count(*) AS n FROM ev WHERE speed IS NOT NULL GROUP BY speed) a) b) c GROUP BY 1"""),
        "new_streets": _sql("clean street_labels_fx", "SELECT DISTINCT street_name FROM clean WHERE trim(street_name) <> '' AND street_name NOT IN (SELECT street_name FROM street_labels_fx)"),
        "extend_labels": _sql("clean street_labels_fx", """SELECT street_id, street_name FROM street_labels_fx UNION ALL
            SELECT (SELECT max(street_id) FROM street_labels_fx) + row_number() OVER (ORDER BY street_name), street_name FROM
            (SELECT DISTINCT street_name FROM clean WHERE trim(street_name) <> '' AND street_name NOT IN (SELECT street_name FROM street_labels_fx)) t"""),
        "label_join": _sql("clean street_labels_fx", f"SELECT result_id, street_name, street_id FROM {_LABELLED}"),
        "labelled_events": _sql("clean street_labels_fx", f"""SELECT street_id, {_LEVEL.format(j='jamFactor')} AS congestion_level, traversability, count(*) AS n, count(*) AS shapes, max(timestamp) AS latest,
            round(sum(speed), 4) AS speed, round(sum(jamFactor), 4) AS jam FROM clean LEFT JOIN (SELECT street_id, street_name FROM street_labels_fx UNION ALL
            SELECT (SELECT max(street_id) FROM street_labels_fx) + row_number() OVER (ORDER BY street_name), street_name FROM
            (SELECT DISTINCT street_name FROM clean WHERE trim(street_name) <> '' AND street_name NOT IN (SELECT street_name FROM street_labels_fx)) t) l USING (street_name) GROUP BY 1, 2, 3"""),
        "latest_per_street": _sql("latest", 'SELECT event_id, street_id, timestamp, round(speed, 6) AS speed, round("jamFactor", 6) AS "jamFactor", confidence, traversability, round("freeFlowSpeed", 6) AS "freeFlowSpeed", congestion_level FROM latest'),
        "latest_bbox_zoom": _sql("latest segs", f"SELECT {_EVENT_COLUMNS}, {_ROAD} FROM latest e JOIN segs s ON e.street_id = s.segment_id WHERE highway IN ({_TIER_13}) AND {_IN_WINDOW} ORDER BY timestamp DESC, street_id LIMIT 500"),
        "latest_no_bbox": _sql("latest segs", f"SELECT {_EVENT_COLUMNS}, {_ROAD} FROM latest e JOIN segs s ON e.street_id = s.segment_id ORDER BY timestamp DESC, street_id LIMIT 200"),
        "range_query": _sql("ev segs", f"SELECT event_id, {_EVENT_COLUMNS}, {_ROAD} FROM ev e JOIN segs s ON e.street_id = s.segment_id WHERE {_RANGE} AND highway IN ({_TIER_15}) AND {_IN_WINDOW} ORDER BY timestamp DESC, street_id, event_id DESC LIMIT 4000"),
        "range_far_zoom": _sql("ev segs", f"SELECT event_id, {_EVENT_COLUMNS}, {_ROAD} FROM ev e JOIN segs s ON e.street_id = s.segment_id WHERE {_RANGE} AND highway IN ({_TIER_11}) ORDER BY timestamp DESC, street_id, event_id DESC LIMIT 200"),
        "segments_in_window": _sql("segs", f"SELECT segment_id, highway FROM segs s WHERE {_IN_WINDOW}"),
        "traffic_stats": _sql("ev", 'SELECT count(*) AS total_events, count(DISTINCT street_id) AS total_streets, max(timestamp) AS latest_update, round(avg(speed), 6) AS avg_speed, round(avg("jamFactor"), 6) AS avg_jamfactor FROM ev'),
        "speeds_descending": _sql("ev", "SELECT round(speed, 6) AS speed FROM ev ORDER BY 1 DESC"),
        "orphans": _sql("ev segs", "SELECT street_id, count(*) AS events FROM ev WHERE street_id NOT IN (SELECT segment_id FROM segs) GROUP BY street_id"),
        "events_with_segment": _sql("ev segs", "SELECT event_id, street_id FROM ev WHERE street_id IN (SELECT segment_id FROM segs)"),
        "latest_labelled": _sql("clean street_labels_fx", f"""SELECT street_id, any_value(l.street_name) AS street_name, max(timestamp) AS timestamp
            FROM (SELECT *, ax / 1e6::DOUBLE AS sx, ay / 1e6::DOUBLE AS sy, bx / 1e6::DOUBLE AS ex, by_ / 1e6::DOUBLE AS ey FROM clean) s
            LEFT JOIN street_labels_fx l USING (street_name) WHERE {_IN_WINDOW} GROUP BY street_id"""),
        "labelled_range": _sql("clean street_labels_fx", f"""SELECT street_name, count(*) AS n, max(timestamp) AS latest FROM (SELECT l.street_name, timestamp FROM clean LEFT JOIN street_labels_fx l USING (street_name)
            WHERE {_RANGE} ORDER BY timestamp DESC, street_id LIMIT 5000) t GROUP BY street_name"""),
        "feature_properties": _sql("latest segs", """SELECT street_id, s.name AS street_name, s.highway, congestion_level,
            strftime(timestamp, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp, 'LineString' AS kind FROM latest e JOIN segs s ON e.street_id = s.segment_id"""),
        "display_class": _sql("ev", f"SELECT event_id, {_display('lvl')} AS display FROM (SELECT *, CASE WHEN congestion_level <> 'Low' THEN congestion_level END AS lvl FROM ev) t"),
        "display_by_ratio": _sql("ev", f"SELECT event_id, {_RATIO} AS display FROM ev"),
        "stroke_width": _sql("edges flow_raw", f"SELECT u, highway, level, {_width('level')} AS width FROM edges LEFT JOIN (SELECT result_id, {_LEVEL.format(j='jam_factor')} AS level FROM flow_raw) f ON u = result_id"),
        "style_rows": _sql("latest segs", f"""SELECT street_id, display, CASE display WHEN 'low' THEN 4278238420 WHEN 'medium' THEN 4294940672 WHEN 'high' THEN 4293467747 WHEN 'severe' THEN 4288423856 ELSE 4280391411 END::BIGINT AS colour,
            {_width('lvl')} AS width, CASE WHEN oneway THEN 0.5 ELSE 0.3 END::DOUBLE AS opacity
            FROM (SELECT *, {_display('lvl')} AS display FROM (SELECT e.*, s.highway, s.oneway, {styled} AS lvl FROM latest e JOIN segs s ON e.street_id = s.segment_id) a) b"""),
        "palette": _sql("road_edges_raw", "SELECT u, (4278190080 + u % 256)::BIGINT AS c_low, 4288423856::BIGINT AS c_severe, 2158743023::BIGINT AS c_default, 2158743023::BIGINT AS c_unknown FROM road_edges_raw"),
        "hex_colour": _sql("road_edges_raw", "SELECT u, CASE WHEN u % 3 = 0 THEN to_hex(u) ELSE '#' || lpad(to_hex(u), 6, '0') END AS code, CASE WHEN u % 3 <> 0 THEN 4278190080 + u END::BIGINT AS colour FROM road_edges_raw"),
        "multi_line_split": _sql("road_edges_raw", """SELECT u, round(x1 / 1e6::DOUBLE, 7) AS start_x, round(y1 / 1e6::DOUBLE, 7) AS start_y, round(x2 / 1e6::DOUBLE, 7) AS end_x, round(y2 / 1e6::DOUBLE, 7) AS end_y FROM road_edges_raw
            UNION ALL SELECT u, round(x2 / 1e6::DOUBLE, 7), round(y2 / 1e6::DOUBLE, 7), round(x1 / 1e6::DOUBLE, 7), round(y1 / 1e6::DOUBLE, 7) FROM road_edges_raw"""),
        "lenient_flags": _sql("flow_raw", "SELECT result_id, result_id % 4 <> 3 AS from_text, coalesce(speed <> 0, false) AS from_number, CASE WHEN coalesce(speed <> 0, false) THEN 0.5 ELSE 0.3 END::DOUBLE AS opacity FROM flow_raw"),
        "short_time": _sql("ev", "SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN CAST(hour(timestamp) AS VARCHAR) || strftime(timestamp, ':%M') ELSE 'soon' END AS shown, printf('%.1f', coalesce(confidence, 0)) AS confidence FROM ev"),
        "road_overlap_kinds": _sql("road_kinds", "SELECT osmid_1, u_1, v_1, osmid_2, u_2, v_2, kind FROM road_kinds"),
        "overlap_summary": _sql("road_kinds", "SELECT count(*) AS total, count(*) FILTER (WHERE kind = 'crosses') AS crossing, count(*) FILTER (WHERE kind = 'overlaps') AS overlapping FROM road_kinds WHERE kind <> 'touches'"),
        "overlap_pairs": _sql("road_kinds", "SELECT osmid_1, u_1, v_1, name_1, osmid_2, u_2, v_2, name_2, kind FROM road_kinds WHERE kind <> 'touches' ORDER BY osmid_1, u_1, v_1, osmid_2, u_2, v_2 LIMIT 20"),
        "segment_overlap": _sql("seg_kinds", "SELECT count(*) AS total, count(*) FILTER (WHERE kind = 'crosses') AS crossing, count(*) FILTER (WHERE kind = 'overlaps') AS overlapping FROM seg_kinds WHERE kind <> 'touches'"),
        "segment_overlap_same_way": _sql("seg_kinds", "SELECT segment_id_1, segment_id_2, kind FROM seg_kinds WHERE kind <> 'touches' AND osmid_1 = osmid_2"),
        "segment_quality": _sql("segs", "SELECT count(*) AS total_segments, count(DISTINCT segment_id) AS distinct_ids, 0::BIGINT AS null_geometry, 0::BIGINT AS invalid_geometry, round(min(length), 4) AS min_length, round(max(length), 4) AS max_length, round(avg(length), 4) AS avg_length FROM segs"),
        "dq_report": _sql("flow_raw", report),
        "duplicate_edges": _sql("road_edges_raw", "SELECT count(*) FILTER (WHERE n > 1) AS repeated_keys, sum(n - 1)::BIGINT AS extra_rows FROM (SELECT count(*) AS n FROM road_edges_raw GROUP BY osmid, u, v) t"),
        "road_dim": _sql("segs", "SELECT DISTINCT osmid, u, v, name, highway, oneway, speed_limit, lanes FROM segs"),
        "location_dim": _sql("segs", "SELECT segment_id, round(sx, 7) AS start_lon, round(sy, 7) AS start_lat, round(ex, 7) AS end_lon, round(ey, 7) AS end_lat, round(length, 4) AS length FROM segs"),
        "time_dim": _sql("ev", """SELECT DISTINCT CAST(strftime(h, '%Y%m%d%H') AS BIGINT) AS time_key, h AS hour, date_trunc('day', h)::TIMESTAMP AS day, year(h)::BIGINT AS year, month(h)::BIGINT AS month,
            day(h)::BIGINT AS day_of_month, hour(h)::BIGINT AS hour_of_day, isodow(h)::BIGINT AS day_of_week FROM (SELECT date_trunc('hour', timestamp)::TIMESTAMP AS h FROM ev) t"""),
        "congestion_fact": _sql("ev segs", "SELECT highway, hour(timestamp)::BIGINT AS hour_of_day, congestion_level, count(*) AS events FROM ev JOIN segs s ON street_id = segment_id GROUP BY 1, 2, 3"),
        "hourly_jam": _sql("ev segs", 'SELECT date_trunc(\'hour\', timestamp)::TIMESTAMP AS hour, highway, count(*) AS events, round(avg("jamFactor"), 6) AS avg_jam, max("jamFactor") AS max_jam FROM ev JOIN segs s ON street_id = segment_id GROUP BY 1, 2'),
        "tumbling_congestion": _sql("ev", f"SELECT time_bucket(INTERVAL '15 minutes', timestamp) AS window_start, time_bucket(INTERVAL '15 minutes', timestamp) + INTERVAL '15 minutes' AS window_end, street_id, count(*) AS events, {window_sql} FROM ev GROUP BY 1, 2, 3"),
        "sliding_congestion": _sql("ev", f"""SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, congestion_level, count(*) AS events, {window_sql} FROM
            (SELECT *, time_bucket(INTERVAL '30 minutes', timestamp) - to_minutes(30 * unnest([0, 1])) AS window_start FROM ev) t GROUP BY 1, 2, 3"""),
        "jam_episodes": _sql("ev", """SELECT min(timestamp) AS episode_start, max(timestamp) + INTERVAL '6 hours' AS episode_end, street_id, count(*) AS events, max("jamFactor") AS max_jam FROM
            (SELECT *, sum(fresh) OVER (PARTITION BY street_id ORDER BY timestamp, event_id) AS run FROM
            (SELECT *, CASE WHEN timestamp < lag(timestamp) OVER (PARTITION BY street_id ORDER BY timestamp, event_id) + INTERVAL '6 hours' THEN 0 ELSE 1 END AS fresh FROM ev WHERE "jamFactor" >= 7) a) b
            GROUP BY street_id, run"""),
    }
