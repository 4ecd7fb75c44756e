"""Map matching: traffic lines to road segments, and the rollup per segment.

The feed repeats the same lines in every snapshot, so flow is first rolled up per distinct
line. That is the only pass over the flow history; the spatial work then runs on distinct
lines, and a hot line or hot segment costs no more than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.functions.traffic import congestion_level, kmh
from roadpulse.operators.spatial import capsule_interval, covered_metres, line_pieces, near_pieces, with_sides
from roadpulse.session import cut_lineage, spread

# Buffer in degrees, greatest angle in degrees, least overlap in metres.
BUFFER_DEGREES = 0.00015
MAX_ANGLE = 90.0
MIN_OVERLAP_M = 5.0


def line_key(line: str = "line") -> Column:
    """A 128-bit text key of a line's points."""
    return F.concat(F.hex(F.xxhash64(line)), F.hex(F.xxhash64(F.lit(1), line)))


def with_flow_line(flow: DataFrame) -> DataFrame:
    """Add ``line`` from the feed's links unless the flow already carries one."""
    return flow if "line" in flow.columns else flow.withColumn("line", F.expr(geo.links_to_line("links")))


def _first_order(flow: DataFrame) -> Column:
    """What decides which row's attributes a rollup keeps: the result id, else the row's own values."""
    if "result_id" in flow.columns:
        return F.coalesce(F.expr("try_cast(result_id AS BIGINT)"), F.xxhash64("result_id"))
    return F.xxhash64("timestamp", "speed", "jamFactor", "confidence", "freeFlowSpeed", "traversability", "traverse_length")


def roll_up_lines(flow: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Partial measures per distinct traffic line, and per value of ``by``.

    The first aggregate has only fixed-width buffers (traversability is in the key), so it
    stays a hash aggregate with map-side combine over the whole history.
    """
    rows = with_flow_line(flow).withColumn("pick", _first_order(flow))
    by_state = rows.groupBy("line", *by, "traversability").agg(
        F.count("*").alias("n"),
        F.sum("speed").alias("speed_sum"), F.count("speed").alias("speed_n"), F.min("speed").alias("speed_min"),
        F.max("jamFactor").alias("jam"), F.max("confidence").alias("confidence"), F.max("timestamp").alias("latest"),
        F.min("pick").alias("pick"),
        F.min_by("freeFlowSpeed", "pick").alias("freeFlowSpeed"),
        F.min_by("traverse_length", "pick").alias("traverse_length"),
        F.max(F.size("line")).alias("points"),
    )
    # Rows without a line go here, by an aggregate: a test of the line itself would be moved
    # below and build every line twice.
    return by_state.filter("points >= 2").groupBy("line", *by).agg(*_combined("n"), _first_attributes())


def _combined(*counts: str) -> list[Column]:
    """Aggregates that merge partial measures."""
    return [
        *[F.sum(c).alias(c) for c in counts],
        F.sum("speed_sum").alias("speed_sum"), F.sum("speed_n").alias("speed_n"), F.min("speed_min").alias("speed_min"),
        F.max("jam").alias("jam"), F.max("confidence").alias("confidence"), F.max("latest").alias("latest"),
    ]


def _first_attributes() -> Column:
    return F.min(F.struct("pick", "freeFlowSpeed", "traversability", "traverse_length")).alias("first")


def match_metrics(lines: DataFrame, segments: DataFrame, line_id: str, buffer_deg: float = BUFFER_DEGREES,
                  candidate: str = "intersects", keep: list[str] | None = None, **grid) -> DataFrame:
    """Candidate pairs of traffic lines and segments with angle difference and overlap length.

    ``lines`` has ``line_id``, ``line`` and the ``keep`` columns, which pass through. A pair
    is a candidate when the bare line meets the segment (or, with ``candidate="buffer"``,
    when its buffer does); the overlap is the part of the segment inside the buffer.
    """
    if candidate not in ("intersects", "buffer"):
        raise ValueError("candidate is 'intersects' or 'buffer'")
    keep = keep or []
    angled = lines.withColumn("angle", F.expr(geo.bearing("line")))
    roads = segments.select("segment_id", F.col("azimuth").alias("angle"), "geometry")
    near = near_pieces(
        line_pieces(angled, [line_id], "line", ["angle", *keep]),
        line_pieces(roads, ["segment_id"], "geometry", ["angle"]),
        [line_id], ["segment_id"], grow=buffer_deg, **grid)
    clipped = capsule_interval(with_sides(near), buffer_deg)
    stretch = "named_struct('part', r_part, 'lo', lo, 'hi', hi, 'x1', r_x1, 'y1', r_y1, 'x2', r_x2, 'y2', r_y2)"
    found = "bool_or(meets)" if candidate == "intersects" else "count(lo) > 0"
    # The list of one pair grows with the pieces of its two lines only; repeats from shared
    # cells do no harm to the length.
    pairs = clipped.groupBy(F.col("l_" + line_id).alias(line_id), F.col("r_segment_id").alias("segment_id")).agg(
        F.any_value("l_angle").alias("line_angle"), F.any_value("r_angle").alias("segment_angle"),
        *[F.any_value("l_" + c).alias(c) for c in keep],
        F.expr(f"collect_list(if(lo is null, null, {stretch}))").alias("stretches"),
        F.expr(found).alias("found"),
    )
    return pairs.filter("found").select(
        line_id, "segment_id", *keep,
        F.expr(geo.angle_difference("line_angle", "segment_angle")).alias("angle_diff"),
        F.expr(covered_metres("stretches")).alias("overlap_length"),
    )


def apply_rules(metrics: DataFrame, max_angle: float = MAX_ANGLE, min_overlap_m: float = MIN_OVERLAP_M) -> DataFrame:
    return metrics.filter((F.col("angle_diff") <= max_angle) & (F.col("overlap_length") > min_overlap_m))


def overlap_stats(metrics: DataFrame, *more: Column) -> DataFrame:
    return metrics.agg(
        *more,
        F.min("overlap_length").alias("min_overlap_length"),
        F.max("overlap_length").alias("max_overlap_length"),
        F.avg("overlap_length").alias("avg_overlap_length"),
    )


_MEASURES = ["n", "speed_sum", "speed_n", "speed_min", "jam", "confidence", "latest", "first"]


def line_matches(flow: DataFrame, segments: DataFrame, buffer_deg: float = BUFFER_DEGREES,
                 candidate: str = "intersects", **grid) -> DataFrame:
    """Candidate pairs of distinct lines and segments with the partial measures of each line.

    The rolled-up lines are written out once, since several steps read them. Only keys and lines go
    through the spatial join; the measures meet the matches by key.
    """
    shapes = cut_lineage(spread(roll_up_lines(flow).withColumn("line_key", line_key()), "line_key"))
    found = match_metrics(shapes.select("line_key", "line"), segments, "line_key", buffer_deg, candidate, **grid)
    return found.join(shapes.drop("line"), "line_key")


def roll_up_segments(matches: DataFrame, speed_agg: str = "avg", by: tuple[str, ...] = ()) -> DataFrame:
    """Measures per segment (and ``by``) out of the matched lines' partial measures; speed still in m/s."""
    if speed_agg not in ("avg", "min"):
        raise ValueError("speed_agg is 'avg' or 'min'")
    merged = matches.groupBy("segment_id", *by).agg(*_combined("n"), F.min("first").alias("first"))
    speed = F.col("speed_min") if speed_agg == "min" else F.try_divide(F.col("speed_sum"), F.col("speed_n"))
    return merged.select(
        "segment_id", "n", speed.alias("speed"), F.col("jam").alias("jamFactor"), "confidence", F.col("latest").alias("timestamp"),
        "first.freeFlowSpeed", "first.traversability", "first.traverse_length",
    )


def event_rows(rolled: DataFrame) -> DataFrame:
    """The stored fact: text id, speeds in km/h and the congestion level."""
    return rolled.select(
        F.col("segment_id").cast("string").alias("street_id"),
        "timestamp",
        kmh(F.col("speed")).alias("speed"),
        "jamFactor", "confidence", "traversability",
        kmh(F.col("freeFlowSpeed")).alias("freeFlowSpeed"),
        congestion_level(F.col("jamFactor")).alias("congestion_level"),
    )


def match_traffic(flow: DataFrame, segments: DataFrame, buffer_deg: float = BUFFER_DEGREES,
                  max_angle: float = MAX_ANGLE, min_overlap_m: float = MIN_OVERLAP_M,
                  speed_agg: str = "avg", candidate: str = "intersects", **grid) -> DataFrame:
    """Clean flow and road segments to one traffic event per matched segment."""
    matches = apply_rules(line_matches(flow, segments, buffer_deg, candidate, **grid), max_angle, min_overlap_m)
    return event_rows(roll_up_segments(matches, speed_agg))


def match_snapshots(flow: DataFrame, segments: DataFrame, buffer_deg: float = BUFFER_DEGREES,
                    max_angle: float = MAX_ANGLE, min_overlap_m: float = MIN_OVERLAP_M,
                    speed_agg: str = "avg", candidate: str = "intersects", **grid) -> DataFrame:
    """One traffic event per snapshot time and matched segment: matching every snapshot for itself.

    The history is rolled up per line and snapshot and stored; each distinct line of that is matched
    once, and what it matched is joined back to its rows by the line's key.
    """
    measures, metrics = snapshot_matches(flow, segments, buffer_deg, candidate, **grid)
    return snapshot_events(measures, apply_rules(metrics, max_angle, min_overlap_m), speed_agg)


def snapshot_lines(flow: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Measures per line and snapshot, and the distinct lines with their keys, both stored."""
    # The only pass over the history; a line has one row per time here, so its key is not hot.
    measures = cut_lineage(roll_up_lines(flow, by=("timestamp",)).withColumn("line_key", line_key()))
    lines = measures.groupBy("line_key").agg(F.any_value("line").alias("line"))
    return measures, cut_lineage(spread(lines, "line_key"))


def snapshot_matches(flow: DataFrame, segments: DataFrame, buffer_deg: float = BUFFER_DEGREES,
                     candidate: str = "intersects", **grid) -> tuple[DataFrame, DataFrame]:
    """Measures per line and snapshot, and the candidate pairs of distinct lines and segments."""
    measures, shapes = snapshot_lines(flow)
    return measures, match_metrics(shapes, segments, "line_key", buffer_deg, candidate, **grid)


def snapshot_events(measures: DataFrame, matches: DataFrame, speed_agg: str = "avg") -> DataFrame:
    joined = measures.drop("line").join(matches.select("line_key", "segment_id"), "line_key")
    return event_rows(roll_up_segments(joined, speed_agg, by=("timestamp",)))


def with_road(rolled: DataFrame, segments: DataFrame) -> DataFrame:
    """Add the road's name, length and one-way flag to a rollup; both sides have one row per segment."""
    road = segments.select("segment_id", F.col("name").alias("street_name"), F.col("length").alias("segment_length"), "oneway")
    return rolled.join(road, "segment_id")
