"""Snapshot flattening and flow cleaning: pure projections and filters, also usable on streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions.traffic import implied_jam

# Fixed value: least confidence kept.
MIN_CONFIDENCE = 0.7


def flatten_snapshots(snapshots: DataFrame) -> DataFrame:
    """One row per measured location; snapshots without results give no rows. Key and arrival of a delivery stay with its rows."""
    key = [c for c in ("delivery", "arrived") if c in snapshots.columns]
    item = snapshots.select("sourceUpdated", *key, F.explode("results").alias("item"))
    place, flow = F.col("item.location"), F.col("item.currentFlow")
    return item.select(
        F.col("sourceUpdated").cast("timestamp").alias("timestamp"),
        place["description"].alias("street_name"),
        place["length"].alias("traverse_length"),
        place["shape"]["links"].alias("links"),
        flow["speed"].alias("speed"),
        flow["jamFactor"].alias("jamFactor"),
        flow["confidence"].alias("confidence"),
        flow["traversability"].alias("traversability"),
        flow["freeFlow"].alias("freeFlowSpeed"),
        *key,
    )


def usable_flow(flow: DataFrame) -> DataFrame:
    """Rows with a positive speed, length and free-flow speed; NULL fails each test."""
    return flow.filter((F.col("speed") > 0) & (F.col("traverse_length") > 0) & (F.col("freeFlowSpeed") > 0))


def fill_gaps(flow: DataFrame) -> DataFrame:
    """Unknown traversability becomes open, an unknown jam factor follows from the speeds."""
    return flow.withColumns({
        "traversability": F.coalesce("traversability", F.lit("open")),
        "jamFactor": F.coalesce("jamFactor", implied_jam(F.col("speed"), F.col("freeFlowSpeed"))),
    })


def confident(flow: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    return flow.filter(F.col("confidence") >= min_confidence)


def named_only(flow: DataFrame) -> DataFrame:
    return flow.filter(F.trim("street_name") != "")


def clean_flow(flow: DataFrame, min_confidence: float = MIN_CONFIDENCE, require_name: bool = False) -> DataFrame:
    """Clean flow out of raw snapshots (nested) or of an already flat flow table."""
    flat = flatten_snapshots(flow) if "results" in flow.columns else flow
    if require_name:
        flat = named_only(flat)
    return confident(fill_gaps(usable_flow(flat)), min_confidence)
