"""Traffic measures and display rules as Column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadpulse.functions.text import hex_colour

# Jam factor bounds, level names and unit factor.
JAM_HIGH = 7
JAM_MEDIUM = 4
KMH_PER_MS = 3.6

# Default colour of each display class.
DEFAULT_COLOURS = {
    "low": "#00BCD4",
    "medium": "#FF9800",
    "high": "#E91E63",
    "severe": "#9C27B0",
    "default": "#2196F3",
}

# Line width of road classes, the width of all others, and added width by level.
ROAD_WIDTHS = {
    "motorway": 4.0,
    "trunk": 4.0,
    "primary": 3.5,
    "secondary": 3.0,
    "tertiary": 2.5,
    "residential": 2.0,
    "living_street": 2.0,
    "unclassified": 2.0,
}
OTHER_WIDTH = 2.5
LEVEL_EXTRA = {"severe": 1.0, "high": 1.0, "medium": 0.5}

# Road classes shown below each zoom level; above the last all are shown.
ZOOM_CLASSES = [
    (12, ["motorway", "trunk", "primary"]),
    (14, ["motorway", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link"]),
    (16, ["motorway", "trunk", "trunk_link", "primary", "primary_link", "secondary", "secondary_link",
          "tertiary", "tertiary_link"]),
]


def kmh(metres_per_second: Column) -> Column:
    return metres_per_second * KMH_PER_MS


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def implied_jam(speed: Column, free_flow: Column) -> Column:
    """Jam factor 0-10 from the loss of speed; NULL when the ratio is unknown."""
    loss = 10.0 * (1.0 - F.try_divide(speed, free_flow))
    return F.when(loss.isNotNull(), clamp(loss, 0.0, 10.0))


def congestion_level(jam: Column) -> Column:
    return F.when(jam >= JAM_HIGH, "High").when(jam >= JAM_MEDIUM, "Medium").otherwise("Low")


def classes_at_zoom(zoom: float) -> list[str] | None:
    """Road classes shown at a zoom level; None means all."""
    return next((names for below, names in ZOOM_CLASSES if zoom < below), None)


def display_class(level: Column, jam: Column, speed: Column, free_flow: Column) -> Column:
    """Display class by the first usable measure: level name, jam factor, then speed ratio."""
    named = F.lower(level)
    ratio = F.when(free_flow > 0, speed / F.when(free_flow > 0, free_flow))
    return (
        F.when(named.isin("low", "medium", "high", "severe"), named)
        .when(jam < 1, "low").when(jam < 2, "medium").when(jam < 3, "high").when(jam.isNotNull(), "severe")
        .when(ratio > 0.7, "low").when(ratio > 0.4, "medium").when(ratio > 0.2, "high")
        .when(ratio.isNotNull(), "severe")
        .otherwise("default")
    )


def _lookup(table: Mapping[str, float], key: Column, default: float) -> Column:
    entries = F.create_map(*[F.lit(part) for item in table.items() for part in item])
    return F.coalesce(F.try_element_at(entries, key), F.lit(default))


def stroke_width(highway: Column, level: Column) -> Column:
    return _lookup(ROAD_WIDTHS, highway, OTHER_WIDTH) + _lookup(LEVEL_EXTRA, F.lower(level), 0.0)


def border_opacity(oneway: Column) -> Column:
    return F.when(oneway, 0.5).otherwise(0.3)


def default_palette() -> Column:
    """Display class to ARGB number."""
    return F.create_map(*[part for name, text in DEFAULT_COLOURS.items()
                          for part in (F.lit(name), hex_colour(F.lit(text)))])


def merged_palette(config: Column) -> Column:
    """Defaults overridden by ``config`` (``map<string,string>`` of hex texts).

    Names are lower-cased, bad colours are ignored, and of equal names the last one counts.
    """
    # A name that Python repeats is worked out again at each place, and in a lambda for each entry; so both steps are bound.
    pairs = F.filter(
        F.transform(F.map_entries(config), lambda e: F.struct(F.lower(e["key"]).alias("k"), hex_colour(e["value"]).alias("v"))),
        lambda e: e["v"].isNotNull(),
    )

    def last_ones(pairs: Column) -> Column:
        def is_last(pair: Column, i: Column) -> Column:
            later = F.slice(pairs, i + 2, F.greatest(F.size(pairs) - i - 1, F.lit(0)))
            return ~F.exists(later, lambda other: other["k"] == pair["k"])
        return F.map_from_entries(F.filter(pairs, is_last))

    def over_defaults(chosen: Column) -> Column:
        kept = F.map_filter(default_palette(), lambda k, v: ~F.map_contains_key(chosen, k))
        return F.map_concat(kept, chosen)

    return F.when(config.isNull(), default_palette()).otherwise(_bound(_bound(pairs, last_ones), over_defaults))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def colour_of(palette: Column, display: Column) -> Column:
    return F.coalesce(F.try_element_at(palette, F.lower(display)), F.try_element_at(palette, F.lit("default")))
