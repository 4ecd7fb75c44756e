"""Road edges to the measured road network and its short segments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions import geometry as geo
from roadpulse.functions.text import clean_speed_limit, segment_id
from roadpulse.operators.rows import drop_copies, one_row_per_key

# Columns kept of a downloaded edge table.
EDGE_COLUMNS = ["osmid", "u", "v", "name", "oneway", "highway", "length", "maxspeed", "lanes", "geometry"]


def _as_text(field: T.StructField) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, T.ArrayType):
        quote = "'" if isinstance(field.dataType.elementType, T.StringType) else ""
        body = F.array_join(F.transform(value, lambda v: F.concat(F.lit(quote), v.cast("string"), F.lit(quote))), ", ")
        return F.when(value.isNotNull(), F.concat(F.lit("["), body, F.lit("]"))).alias(field.name)
    if isinstance(field.dataType, (T.StructType, T.MapType)):
        return F.to_json(value).alias(field.name)
    return value


def normalise_edges(edges: DataFrame) -> DataFrame:
    """Keep the known columns that exist, and turn lists and structs other than the geometry into text."""
    fields = {f.name: f for f in edges.schema.fields}
    return edges.select(*[F.col(c) if c == "geometry" else _as_text(fields[c]) for c in EDGE_COLUMNS if c in fields])


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Edges without self-loops, one per (osmid, u, v), or for each of its parts where ``with_line`` has told them apart."""
    part = ["part"] if "part" in edges.columns else []
    return drop_copies(edges.filter(F.col("u") != F.col("v")), ["osmid", "u", "v", *part])


def with_line(edges: DataFrame) -> DataFrame:
    """Decode a WKB geometry column, one row for each part of a multi line; a line column stays as it is.

    ``part`` numbers the parts of an edge from 0, ``earlier`` has the metres of those before it. An edge without a
    usable line stays as one row with a NULL geometry. Copies of an edge must be left out before.
    """
    if not isinstance(edges.schema["geometry"].dataType, T.BinaryType):
        return edges
    lines = edges.withColumn("_lines", geo.lines_from_wkb("geometry")).withColumn(
        "_metres", F.expr(f"transform(_lines, l -> {geo.line_metres('l')})"))
    rest = [c for c in edges.columns if c != "geometry"]
    return lines.select(*rest, "_metres", F.posexplode_outer("_lines").alias("_place", "geometry")).select(
        *rest, F.coalesce("_place", F.lit(0)).alias("part"),
        F.expr("coalesce(slice(_metres, 1, _place), cast(array() as array<double>))").alias("earlier"), "geometry")


def build_road_network(edges: DataFrame) -> DataFrame:
    """The edge table with spheroidal length, azimuth and a numeric speed limit; a row for each part of a multi line."""
    return with_line(distinct_edges(edges)).select(
        "u", "v", "osmid", "name", "oneway", "highway",
        clean_speed_limit(F.col("maxspeed")).alias("speed_limit"),
        "lanes",
        F.expr(geo.line_metres("geometry")).alias("length"),
        F.expr(geo.bearing("geometry")).alias("azimuth"),
        "geometry",
    )


def chunk_plan(edges: DataFrame, chunk_m: float = 100.0) -> DataFrame:
    """One row per chunk of every line: number of chunks, chunk index, start and end fraction.

    Fractions come from metres; a line of no length is one chunk from 0 to 1.
    """
    measured = edges.withColumn("line_m", F.expr(geo.line_metres("geometry")))
    count = F.greatest(F.ceil(F.col("line_m") / float(chunk_m)), F.lit(1)).cast("int")
    counted = measured.withColumn("chunks", count)
    rows = counted.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    start = F.try_divide(F.col("chunk") * float(chunk_m), F.col("line_m"))
    end = F.try_divide((F.col("chunk") + 1) * float(chunk_m), F.col("line_m"))
    return rows.withColumns({
        "begin_at": F.coalesce(start, F.lit(0.0)),
        "end_at": F.when(F.col("chunk") == F.col("chunks") - 1, 1.0).otherwise(F.least(end, F.lit(1.0))),
    })


def edge_report(edges: DataFrame, chunk_m: float = 100.0) -> DataFrame:
    """One row about distinct edges: chunks they are cut into, and edges without a usable line."""
    chunks = F.greatest(F.ceil(F.expr(geo.line_metres("geometry")) / float(chunk_m)), F.lit(1))
    return edges.agg(F.coalesce(F.sum(chunks), F.lit(0)).cast("bigint").alias("chunks"),
                     F.count_if(F.col("geometry").isNull()).alias("edges_without_line"))


def build_road_segments(edges: DataFrame, chunk_m: float = 100.0, id_scope: str = "osmid") -> DataFrame:
    """Roads cut into pieces of about ``chunk_m`` metres, one row per segment id.

    ``id_scope="osmid"`` numbers chunks per way id, so edges of one way share ids and the
    lowest (u, v) keeps each; ``"edge"`` numbers them per edge and keeps every piece. Chunks of a multi line
    are numbered on from part to part; none spans two parts.
    """
    if id_scope not in ("osmid", "edge"):
        raise ValueError("id_scope is 'osmid' or 'edge'")
    owner = F.col("osmid") if id_scope == "osmid" else F.concat_ws("_", "osmid", "u", "v")
    lines = with_line(distinct_edges(edges)).withColumn("run", F.expr(geo.running_length("geometry")))
    before = F.expr(f"aggregate(earlier, 0, (n, m) -> n + int(greatest(ceil(m / {float(chunk_m)}D), 1)))") if "earlier" in lines.columns else F.lit(0)
    cut = chunk_plan(lines, chunk_m).select(
        segment_id(owner, F.col("chunk") + before).alias("segment_id"),
        "osmid", "u", "v", "name", "oneway", "highway", "maxspeed", "lanes",
        F.expr(geo.line_substring("geometry", "run", "begin_at", "end_at")).alias("geometry"),
    )
    # Edges are distinct on these three, so they decide alone; per edge, ids are distinct already.
    kept = cut if id_scope == "edge" else one_row_per_key(cut, ["segment_id"], [F.col("u"), F.col("v"), F.col("osmid")])
    return kept.select(
        "segment_id", "osmid", "u", "v", "name", "oneway", "highway",
        clean_speed_limit(F.col("maxspeed")).alias("speed_limit"),
        "lanes",
        F.expr(geo.bearing("geometry")).alias("azimuth"),
        F.expr(geo.line_metres("geometry")).alias("length"),
        "geometry",
    )
