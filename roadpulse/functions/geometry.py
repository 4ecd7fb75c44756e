"""Line geometry as SQL expressions.

A line is ``array<struct<x,y>>`` in lon/lat degrees. Functions take column names or other
expression text and give expression text, for ``F.expr``, ``selectExpr`` or ``spark.sql``;
so they nest freely, and a long formula reaches the JVM in one call. All of it runs inside
the JVM except the WKB codec, which needs IEEE doubles out of bytes and so uses an Arrow
batch UDF.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WGS84 semi-major axis in metres and first eccentricity squared.
WGS84_A = 6378137.0
WGS84_E2 = 0.0066943799901413165

LINE_TYPE = "array<struct<x: double, y: double>>"


def point(x: str, y: str) -> str:
    return f"named_struct('x', cast({x} as double), 'y', cast({y} as double))"


def two_point_line(x1: str, y1: str, x2: str, y2: str) -> str:
    return f"array({point(x1, y1)}, {point(x2, y2)})"


def links_to_line(links: str) -> str:
    """Join the links of one feed location into a line.

    Each link after the first with points repeats the last point, so its first is left out.
    NULL points count as none; fewer than two points in all give NULL.
    """
    pts = "coalesce(link.points, cast(array() as array<struct<lat: double, lng: double>>))"
    joined = f"""aggregate({links}, cast(array() as {LINE_TYPE}), (acc, link) -> concat(acc, transform(
        slice({pts}, if(size(acc) > 0, 2, 1), greatest(size({pts}), 1)),
        pt -> named_struct('x', pt.lng, 'y', pt.lat))), acc -> if(size(acc) >= 2, acc, null))"""
    return joined


def start_point(line: str) -> str:
    return f"try_element_at({line}, 1)"


def end_point(line: str) -> str:
    return f"try_element_at({line}, -1)"


def azimuth(line: str) -> str:
    """Degrees clockwise from north between the end points, planar; NULL when they coincide."""
    a, b = start_point(line), end_point(line)
    dx, dy = f"({b}.x - {a}.x)", f"({b}.y - {a}.y)"
    turn = f"degrees(atan2({dx}, {dy}))"
    return f"case when {dx} = 0 and {dy} = 0 then null when {turn} < 0 then {turn} + 360 else {turn} end"


def bearing(line: str) -> str:
    """The azimuth, and 0 for closed lines of three points or more, so that the angle rule can pass them."""
    return f"coalesce({azimuth(line)}, if(size({line}) > 2, 0D, null))"


def angle_difference(a: str, b: str) -> str:
    return f"least(abs({a} - {b}), 360 - abs({a} - {b}))"


def metres(x1: str, y1: str, x2: str, y2: str) -> str:
    """Length of one straight piece on the spheroid, by the radii at its middle latitude."""
    mid = f"radians((({y1}) + ({y2})) / 2)"
    w = f"(1 - {WGS84_E2}D * sin({mid}) * sin({mid}))"
    north = f"(radians(({y2}) - ({y1})) * {WGS84_A * (1 - WGS84_E2)!r}D / ({w} * sqrt({w})))"
    east = f"(radians(({x2}) - ({x1})) * cos({mid}) * {WGS84_A}D / sqrt({w}))"
    return f"hypot({north}, {east})"


def pieces(line: str) -> str:
    """Straight pieces of a line in order: ``array<struct<x1,y1,x2,y2>>``."""
    last = f"greatest(size({line}) - 1, 0)"
    return (f"zip_with(slice({line}, 1, {last}), slice({line}, 2, {last}), "
            "(p, q) -> named_struct('x1', p.x, 'y1', p.y, 'x2', q.x, 'y2', q.y))")


def line_metres(line: str) -> str:
    return f"aggregate({pieces(line)}, 0D, (acc, p) -> acc + {metres('p.x1', 'p.y1', 'p.x2', 'p.y2')})"


def bounds(line: str) -> str:
    xs, ys = f"transform({line}, p -> p.x)", f"transform({line}, p -> p.y)"
    return (f"named_struct('xmin', array_min({xs}), 'ymin', array_min({ys}), "
            f"'xmax', array_max({xs}), 'ymax', array_max({ys}))")


def running_length(line: str) -> str:
    """Planar distance from the start to every point, first entry 0."""
    return (f"aggregate({pieces(line)}, array(0D), (acc, p) -> "
            "array_append(acc, element_at(acc, -1) + hypot(p.x2 - p.x1, p.y2 - p.y1)))")


def _point_at(line: str, run: str, dist: str) -> str:
    """The point ``dist`` along the line: on the first piece whose end is at least that far."""
    at = f"greatest(int(array_position(transform({run}, c -> c >= {dist}), true)), 1)"
    # Bound to names by a one-entry transform, so the search runs once.
    share = "(s.d - s.lo) / nullif(s.hi - s.lo, 0)"
    found = (f"transform(array({at}), i -> named_struct('d', {dist}, 'p', {line}[greatest(i - 2, 0)], 'q', {line}[i - 1], "
             f"'lo', {run}[greatest(i - 2, 0)], 'hi', {run}[i - 1]))")
    placed = (f"if(s.d < s.hi and s.hi > s.lo, named_struct('x', s.p.x + {share} * (s.q.x - s.p.x), "
              f"'y', s.p.y + {share} * (s.q.y - s.p.y)), s.q)")
    return f"transform({found}, s -> {placed})"


def line_substring(line: str, run: str, begin: str, end: str) -> str:
    """The part between two fractions of the planar length; ``run`` holds ``running_length(line)``."""
    total = f"element_at({run}, -1)"
    lo, hi = f"({begin} * {total})", f"least({end} * {total}, {total})"
    middle = (f"transform(filter(zip_with({line}, {run}, (p, c) -> named_struct('p', p, 'c', c)), "
              f"n -> n.c > {lo} and n.c < {hi}), n -> n.p)")
    return f"concat({_point_at(line, run, lo)}, {middle}, {_point_at(line, run, hi)})"


def flip_coordinates(line: str) -> str:
    return f"transform({line}, p -> named_struct('x', p.y, 'y', p.x))"


def is_valid_line(line: str) -> str:
    """At least two different points, all finite and inside lon/lat range; NULL stays NULL."""
    return (f"(forall({line}, p -> coalesce(abs(p.x) <= 180 and abs(p.y) <= 90, false)) "
            f"and size(array_distinct({line})) >= 2)")


def envelope(x1: float, y1: float, x2: float, y2: float) -> tuple[float, float, float, float]:
    """A map window with its corners put in order."""
    return min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)


def side(ax: str, ay: str, bx: str, by: str, cx: str, cy: str) -> str:
    """Twice the signed area of a, b, c: positive when c lies left of a to b."""
    return f"(({bx} - {ax}) * ({cy} - {ay}) - ({by} - {ay}) * ({cx} - {ax}))"


def line_in_window(line: str, window: tuple[float, float, float, float]) -> str:
    """Whether a line meets a closed rectangle, without dividing.

    For some piece the boxes must overlap and the rectangle's corners must not all lie
    strictly on one side of it.
    """
    xmin, ymin, xmax, ymax = (f"{float(v)!r}D" for v in window)
    sides = ", ".join(side("p.x1", "p.y1", "p.x2", "p.y2", cx, cy) for cx in (xmin, xmax) for cy in (ymin, ymax))
    return (f"exists({pieces(line)}, p -> least(p.x1, p.x2) <= {xmax} and greatest(p.x1, p.x2) >= {xmin} "
            f"and least(p.y1, p.y2) <= {ymax} and greatest(p.y1, p.y2) >= {ymin} "
            f"and least({sides}) <= 0 and greatest({sides}) >= 0)")


# --- text and binary forms -------------------------------------------------------------

def to_wkt(line: str) -> str:
    body = f"array_join(transform({line}, p -> concat_ws(' ', p.x, p.y)), ', ')"
    return f"if(size({line}) >= 2, concat('LINESTRING(', {body}, ')'), null)"


def from_wkt(text: str) -> str:
    """Parse ``LINESTRING(x y, ...)``; any other text, bad number or lone point gives NULL."""
    body = rf"regexp_extract({text}, r'(?i)^\s*LINESTRING\s*\(([^()]*)\)\s*$', 1)"
    pairs = rf"transform(split({body}, ','), t -> split(trim(t), r'\s+'))"
    line = f"transform({pairs}, a -> named_struct('x', try_cast(get(a, 0) as double), 'y', try_cast(get(a, 1) as double)))"
    return (f"aggregate(array({line}), cast(null as {LINE_TYPE}), (acc, l) -> "
            "if(size(l) >= 2 and forall(l, p -> p.x is not null and p.y is not null), l, acc))")


def to_geojson(line: str) -> str:
    """A GeoJSON LineString text; NULL stays NULL."""
    return f"if({line} is null, null, to_json({geojson_struct(line)}))"


def geojson_struct(line: str) -> str:
    return (f"if({line} is null, null, named_struct('type', 'LineString', "
            f"'coordinates', transform({line}, p -> array(p.x, p.y))))")


def geojson_lines(text: str) -> str:
    """All drawable lines of a GeoJSON geometry text: ``array<line>``.

    Multi lines give one entry per part; points with fewer than two numbers are left out,
    then lines of fewer than two points; other geometry types give an empty array.
    """
    kind, coords = f"get_json_object({text}, '$.type')", f"get_json_object({text}, '$.coordinates')"
    parts = (f"case {kind} when 'LineString' then array(from_json({coords}, 'array<array<double>>')) "
             f"when 'MultiLineString' then from_json({coords}, 'array<array<array<double>>>') "
             "else cast(array() as array<array<array<double>>>) end")
    lines = f"transform({parts}, part -> transform(filter(part, c -> size(c) >= 2), c -> named_struct('x', c[0], 'y', c[1])))"
    return f"filter({lines}, l -> size(l) >= 2)"


def from_geojson(text: str) -> str:
    return f"try_element_at({geojson_lines(text)}, 1)"


# WKB geometry codes, the flags of an SRID and of Z and M values, and the thousands that ISO adds for those.
_WKB_LINE, _WKB_MULTI_LINE = 2, 5
_WKB_SRID_FLAG, _WKB_Z_FLAG, _WKB_M_FLAG = 0x20000000, 0x80000000, 0x40000000
_ISO_EXTRA = {0: 0, 1: 1, 2: 1, 3: 2}
_PLAIN_HEAD = b"\x01\x02\x00\x00\x00"


def _decode_wkb(data: bytes | None) -> np.ndarray | None:
    """x and y in turn of a line, or of a multi line of one part; Z and M values are left out, anything else is None."""
    if data is None or len(data) < 9 or data[0] > 1:
        return None
    order = "<" if data[0] == 1 else ">"
    code = int(np.frombuffer(data, order + "u4", 1, 1)[0])
    head = 9 if code & _WKB_SRID_FLAG else 5
    extra = bool(code & _WKB_Z_FLAG) + bool(code & _WKB_M_FLAG)
    iso, kind = divmod(code & 0x0FFFFFFF, 1000)
    if iso not in _ISO_EXTRA or len(data) < head + 4:
        return None
    count = int(np.frombuffer(data, order + "u4", 1, head)[0])
    if kind == _WKB_MULTI_LINE:
        return _decode_wkb(data[head + 4:]) if count == 1 else None
    width = 2 + extra + _ISO_EXTRA[iso]
    if kind != _WKB_LINE or len(data) != head + 4 + 8 * width * count:
        return None
    return np.frombuffer(data, order + "f8", width * count, head + 4).astype("f8").reshape(count, width)[:, :2].ravel()


def _decode_batch(data: pd.Series) -> list[np.ndarray | None]:
    """Lines of a batch. Plain little-endian ones, the usual kind, are joined and read as one array."""
    values = data.tolist()
    plain = [i for i, v in enumerate(values) if v is not None and v[:5] == _PLAIN_HEAD and len(v) % 16 == 9
             and int.from_bytes(v[5:9], "little") * 16 == len(v) - 9]
    known = set(plain)
    out: list[np.ndarray | None] = [None if i in known else _decode_wkb(v) for i, v in enumerate(values)]
    if plain:
        coords = np.frombuffer(b"".join([values[i][9:] for i in plain]), "<f8")
        ends = np.cumsum([len(values[i]) // 8 - 1 for i in plain])
        for i, own in zip(plain, np.split(coords, ends[:-1])):
            out[i] = own
    return out


def _decode_parts(data: bytes | None) -> list[np.ndarray] | None:
    """All parts of a line or a multi line that have two points or more; None if there is none, or any byte is not as it should be."""
    single = _decode_wkb(data)
    if single is not None or data is None or len(data) < 9 or data[0] > 1:
        return None if single is None or len(single) < 4 else [single]
    order = "<" if data[0] == 1 else ">"
    code = int(np.frombuffer(data, order + "u4", 1, 1)[0])
    at = 9 if code & _WKB_SRID_FLAG else 5
    if (code & 0x0FFFFFFF) % 1000 != _WKB_MULTI_LINE or len(data) < at + 4:
        return None
    count, at, found = int(np.frombuffer(data, order + "u4", 1, at)[0]), at + 4, []
    for _ in range(count):
        if len(data) < at + 9 or data[at] > 1:
            return None
        inner = "<" if data[at] == 1 else ">"
        kind, points = (int(v) for v in np.frombuffer(data, inner + "u4", 2, at + 1))
        width = 2 + bool(kind & _WKB_Z_FLAG) + bool(kind & _WKB_M_FLAG) + _ISO_EXTRA.get((kind & 0x0FFFFFFF) // 1000, 0)
        end = at + 9 + 8 * width * points
        part = _decode_wkb(data[at:end])
        if part is None:
            return None
        found.append(part)
        at = end
    return [part for part in found if len(part) >= 4] or None if at == len(data) else None


def _encode_wkb(values: np.ndarray | None) -> bytes | None:
    if values is None:
        return None
    coords = np.asarray(values, "<f8")
    head = np.array([_WKB_LINE, len(coords) // 2], "<u4")
    return b"\x01" + head.tobytes() + coords.tobytes()


_COORDS = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType())), T.StructField("y", T.ArrayType(T.DoubleType()))])


@F.pandas_udf(_COORDS)
def _wkb_coords(data: pd.Series) -> pd.DataFrame:
    flat = _decode_batch(data)
    return pd.DataFrame({"x": pd.Series([None if v is None else v[0::2] for v in flat], dtype=object),
                         "y": pd.Series([None if v is None else v[1::2] for v in flat], dtype=object)})


_PARTS = T.StructType([T.StructField(c, T.ArrayType(T.ArrayType(T.DoubleType()))) for c in ("x", "y")])


@F.pandas_udf(_PARTS)
def _wkb_parts(data: pd.Series) -> pd.DataFrame:
    parts = [_decode_parts(v) for v in data.tolist()]
    return pd.DataFrame({c: pd.Series([None if v is None else [p[i::2] for p in v] for v in parts], dtype=object) for i, c in enumerate("xy")})


@F.pandas_udf(T.BinaryType())
def _wkb_bytes(flat: pd.Series) -> pd.Series:
    return flat.map(_encode_wkb, na_action="ignore")


def from_wkb(data: Column | str) -> Column:
    """Decode a WKB or EWKB line, without Z and M; other geometry types, multi lines of several parts and broken bytes give NULL."""
    coords = _wkb_coords(F.col(data) if isinstance(data, str) else data)
    return F.arrays_zip(coords["x"], coords["y"]).cast(LINE_TYPE)


def lines_from_wkb(data: Column | str) -> Column:
    """All parts of two points or more of a WKB or EWKB line or multi line, in order: ``array<line>``; anything else gives NULL."""
    parts = _wkb_parts(F.col(data) if isinstance(data, str) else data)
    return F.zip_with(parts["x"], parts["y"], lambda x, y: F.arrays_zip(x, y)).cast(f"array<{LINE_TYPE}>")


def to_wkb(line: str) -> Column:
    return _wkb_bytes(F.expr(f"flatten(transform({line}, p -> array(p.x, p.y)))"))


def from_hex_wkb(text: Column | str) -> Column:
    return from_wkb(F.unhex(text))


def to_hex_wkb(line: str) -> Column:
    return F.hex(to_wkb(line))
