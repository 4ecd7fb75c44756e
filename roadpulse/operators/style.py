"""Display attributes of traffic rows: class, colour, line width and border."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.functions.traffic import (
    border_opacity, colour_of, default_palette, display_class, merged_palette, stroke_width)


def style_rows(rows: DataFrame, config: Column | None = None) -> DataFrame:
    """Add ``display``, ``colour``, ``width`` and ``opacity``; ``config`` is a map of colour texts."""
    palette = default_palette() if config is None else merged_palette(config)
    shown = rows.withColumn("display", display_class(
        F.col("congestion_level"), F.col("jamFactor"), F.col("speed"), F.col("freeFlowSpeed")))
    return shown.withColumns({
        "colour": colour_of(palette, F.col("display")),
        "width": stroke_width(F.col("highway"), F.col("congestion_level")),
        "opacity": border_opacity(F.coalesce(F.col("oneway"), F.lit(False))),
    })


def style_features(rows: DataFrame, geojson: str | None = None, config: Column | None = None) -> DataFrame:
    """Styled drawable lines: one row per line of the geometry, lines of fewer than two points left out."""
    lines = geo.geojson_lines(geojson) if geojson else "filter(array(geometry), l -> size(l) >= 2)"
    drawn = rows.withColumn("points", F.explode(F.expr(lines)))
    return style_rows(drawn, config).drop("geometry", *([geojson] if geojson else []))
