"""Quality reports: how roads meet, segment checks, column checks and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from roadpulse.functions import geometry as geo
from roadpulse.operators.spatial import line_pieces, near_pieces, with_sides
from roadpulse.session import cut_lineage

_EDGE_IDS = ["osmid", "u", "v"]
# Fractions of a piece within this of 0 and 1 count as its ends.
_END = "1e-12D"


def _contacts(met):
    """How two pieces that meet do so: common stretch on either, or one point and where it lies."""
    ldx, ldy, rdx, rdy = "(l_x2 - l_x1)", "(l_y2 - l_y1)", "(r_x2 - r_x1)", "(r_y2 - r_y1)"

    def along(side: str, dx: str, dy: str, x: str, y: str) -> str:
        return f"(({x} - {side}_x1) * {dx} + ({y} - {side}_y1) * {dy}) / nullif({dx} * {dx} + {dy} * {dy}, 0)"

    flat = met.selectExpr(
        "*", "s_r1 = 0 and s_r2 = 0 as collinear",
        f"{along('l', ldx, ldy, 'r_x1', 'r_y1')} as t1", f"{along('l', ldx, ldy, 'r_x2', 'r_y2')} as t2",
        f"{along('r', rdx, rdy, 'l_x1', 'l_y1')} as u1", f"{along('r', rdx, rdy, 'l_x2', 'l_y2')} as u2")
    flat = flat.selectExpr(
        "*", "if(collinear, greatest(least(t1, t2), 0D), null) as l_lo", "if(collinear, least(greatest(t1, t2), 1D), null) as l_hi",
        "if(collinear, greatest(least(u1, u2), 0D), null) as r_lo", "if(collinear, least(greatest(u1, u2), 1D), null) as r_hi")
    flat = flat.selectExpr("*", "collinear and l_hi > l_lo as shared")

    def at(side: str, end: int) -> str:
        param = f"{side}_lo = {end - 1} and {side}_hi = {end - 1}"
        return f"if(collinear, {param}, s_{side}{end} = 0)"

    def boundary(side: str) -> str:
        first, last = f"{at(side, 1)} and {side}_part = 0", f"{at(side, 2)} and {side}_part = {side}_parts - 1"
        return f"not {side}_closed and (({first}) or ({last}))"

    share = "s_l1 / nullif(s_l1 - s_l2, 0)"
    spot = (f"case when {at('l', 1)} then named_struct('x', l_x1, 'y', l_y1) when {at('l', 2)} then named_struct('x', l_x2, 'y', l_y2) "
            f"when s_r1 = 0 then named_struct('x', r_x1, 'y', r_y1) when s_r2 = 0 then named_struct('x', r_x2, 'y', r_y2) "
            f"else named_struct('x', l_x1 + {share} * {ldx}, 'y', l_y1 + {share} * {ldy}) end")
    return flat.selectExpr(
        "*", f"not shared and not ({boundary('l')}) and not ({boundary('r')}) as inner",
        f"if(shared, null, {spot}) as spot")


def _covered_parts(stretches: str) -> str:
    """How many pieces are covered from end to end by ``array<struct<part, lo, hi>>``."""
    start = f"if(s.lo <= {_END}, s.hi, -1D)"
    grow = f"if(acc.end >= 0 and s.lo <= acc.end + {_END}, greatest(acc.end, s.hi), -1D)"
    before = "if(acc.part = s.part, acc.end, 0D)"
    step = (f"transform(array(if(acc.part = s.part, {grow}, {start})), e -> named_struct('part', s.part, 'end', e, "
            f"'full', acc.full + if(e >= 1 - {_END} and {before} < 1 - {_END}, 1, 0)))[0]")
    return (f"aggregate(array_sort({stretches}), named_struct('part', -1, 'end', 0D, 'full', 0), "
            f"(acc, s) -> {step}, acc -> acc.full)")


def _location(spots: str, stretches: str) -> str:
    """Text of the common points and stretches."""
    def text(p: str) -> str:
        return f"concat_ws(' ', {p}.x, {p}.y)"

    points = f"transform(array_sort({spots}), p -> {text('p')})"
    lines = f"transform(array_sort({stretches}), s -> concat({text('s.a')}, ', ', {text('s.b')}))"
    some_points = f"if(size({spots}) = 1, concat('POINT(', {points}[0], ')'), concat('MULTIPOINT((', array_join({points}, '), ('), '))'))"
    some_lines = (f"if(size({stretches}) = 1, concat('LINESTRING(', {lines}[0], ')'), "
                  f"concat('MULTILINESTRING((', array_join({lines}, '), ('), '))'))")
    return (f"case when size({stretches}) = 0 then {some_points} when size({spots}) = 0 then {some_lines} "
            f"else concat('GEOMETRYCOLLECTION(', {some_points}, ', ', {some_lines}, ')') end")


def line_relations(lines: DataFrame, ids: list[str], keep: list[str] | None = None, same: list[str] | None = None,
                   line: str = "geometry", **grid) -> DataFrame:
    """Every pair of lines that share a point, once, with how they relate and where.

    ``kind`` is ``touches`` when only end points are involved, ``crosses`` when inner parts
    share single points, ``overlaps`` when they share a stretch and neither covers the other,
    else ``other``. Pairs are ordered by id; ``same`` names columns that must be equal.
    Columns: ids and kept columns with suffix ``_1`` and ``_2``, ``kind``, ``location``.
    """
    keep = [c for c in [*(keep or []), *(same or [])] if c not in ids]
    pieces = line_pieces(lines, ids, line, keep)
    once = "struct({}) < struct({})".format(", ".join("l_" + c for c in ids), ", ".join("r_" + c for c in ids))
    extra = " and ".join([once, *[f"l_{c} = r_{c}" for c in same or []]])
    met = with_sides(near_pieces(pieces, pieces, ids, ids, extra=extra, **grid)).filter("meets")
    stretch = "named_struct('part', {0}_part, 'lo', {0}_lo, 'hi', {0}_hi)"
    place = ("named_struct('a', named_struct('x', l_x1 + l_lo * (l_x2 - l_x1), 'y', l_y1 + l_lo * (l_y2 - l_y1)), "
             "'b', named_struct('x', l_x1 + l_hi * (l_x2 - l_x1), 'y', l_y1 + l_hi * (l_y2 - l_y1)))")
    keys = [F.col(f"{s}_{c}").alias(f"{c}_{n}") for n, s in ((1, "l"), (2, "r")) for c in ids]
    # The sets of one pair are no longer than the two lines have pieces.
    pairs = _contacts(met).groupBy(*keys).agg(
        *[F.any_value(f"{s}_{c}").alias(f"{c}_{n}") for n, s in ((1, "l"), (2, "r")) for c in keep],
        F.any_value("l_parts").alias("l_parts"), F.any_value("r_parts").alias("r_parts"),
        F.bool_or("shared").alias("shared"), F.bool_or("inner").alias("inner"),
        F.expr(f"collect_set(if(shared, {stretch.format('l')}, null))").alias("l_common"),
        F.expr(f"collect_set(if(shared, {stretch.format('r')}, null))").alias("r_common"),
        F.expr(f"collect_set(if(shared, {place}, null))").alias("places"),
        F.collect_set("spot").alias("spots"),
    )
    covered = f"{_covered_parts('l_common')} = l_parts or {_covered_parts('r_common')} = r_parts"
    kind = f"case when shared then if({covered}, 'other', 'overlaps') when inner then 'crosses' else 'touches' end as kind"
    names = [f"{c}_{n}" for n in (1, 2) for c in [*ids, *keep]]
    return pairs.selectExpr(*names, kind, f"{_location('spots', 'places')} as location")


def road_overlaps(network: DataFrame, **grid) -> DataFrame:
    """Pairs of roads that share more than end points."""
    return line_relations(network, _EDGE_IDS, ["name"], **grid).filter("kind <> 'touches'")


def segment_overlaps(segments: DataFrame, same_way: bool = False, **grid) -> DataFrame:
    """Pairs of segments that share more than end points; with ``same_way`` only of one way."""
    return line_relations(segments, ["segment_id"], same=["osmid"] if same_way else None, **grid).filter("kind <> 'touches'")


def overlap_summary(pairs: DataFrame) -> DataFrame:
    return pairs.agg(F.count("*").alias("total"), F.count_if(F.col("kind") == "crosses").alias("crossing"),
                     F.count_if(F.col("kind") == "overlaps").alias("overlapping"))


def overlap_sample(pairs: DataFrame, limit: int = 20) -> DataFrame:
    """The first pairs by id, with names and where they meet."""
    keys = [f"{c}_{n}" for n in (1, 2) for c in _EDGE_IDS]
    return pairs.orderBy(*keys).limit(limit)


def segment_quality(segments: DataFrame) -> DataFrame:
    valid = F.expr(geo.is_valid_line("geometry"))
    return segments.agg(
        F.count("*").alias("total_segments"),
        F.count_distinct("segment_id").alias("distinct_ids"),
        F.count_if(F.col("geometry").isNull()).alias("null_geometry"),
        F.count_if(~valid).alias("invalid_geometry"),
        F.min("length").alias("min_length"), F.max("length").alias("max_length"), F.avg("length").alias("avg_length"),
    )


def column_report(df: DataFrame, ranges: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """Per column: rows, NULLs, NULL share, and values outside a given range. One pass over the data."""
    ranges = ranges or {}
    counts = [F.count("*").alias("n")]
    for i, c in enumerate(df.columns):
        counts.append(F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}"))
        bad = ~F.col(f"`{c}`").between(*ranges[c]) if c in ranges else F.lit(False)
        counts.append(F.count_if(bad).alias(f"bad_{i}"))
    rows = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col("n").alias("rows"), F.col(f"null_{i}").alias("nulls"),
                              F.try_divide(F.col(f"null_{i}"), F.col("n")).alias("null_share"),
                              F.col(f"bad_{i}").alias("out_of_range")) for i, c in enumerate(df.columns)])
    return df.agg(*counts).select(F.inline(rows))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Number of keys that occur more than once, and of rows beyond the first of each."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return sizes.agg(F.count_if(F.col("n") > 1).alias("repeated_keys"), F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_rows"))


def exact_quantiles(df: DataFrame, column: str, shares: list[float]) -> DataFrame:
    """One row with ``q0``, ``q1``, ...: the least value that at least that share of the non-NULL values do not exceed.

    Values are counted, the counts range-sorted and summed up within each task and then over the tasks.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    kept = cut_lineage(counts.repartitionByRange("value").withColumn("_part", F.spark_partition_id()))
    # One row for each task.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = kept.groupBy("_part").agg(F.sum("n").alias("_n"))
    offsets = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(
        Window.partitionBy(F.lit(1))).alias("_all"))
    within = Window.partitionBy("_part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = kept.join(F.broadcast(offsets), "_part").withColumn("_upto", F.col("_before") + F.sum("n").over(within))
    return placed.agg(*[F.min(F.when(F.col("_upto") >= s * F.col("_all"), F.col("value"))).alias(f"q{i}") for i, s in enumerate(shares)])


def flag_outliers(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Add ``is_outlier``: outside the fences about the exact quartiles; NULL where there are none."""
    quartiles = exact_quantiles(df, column, [0.25, 0.75])
    low = quartiles.selectExpr(f"q0 - {reach!r}D * (q1 - q0)").scalar()
    high = quartiles.selectExpr(f"q1 + {reach!r}D * (q1 - q0)").scalar()
    return df.withColumn("is_outlier", ~F.col(column).between(low, high))
