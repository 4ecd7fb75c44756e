"""Schemas of the tables the jobs read and write, as DDL text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Field names of the traffic feed.
SNAPSHOT = (
    "sourceUpdated timestamp, "
    "results array<struct<"
    "location: struct<description: string, length: double, "
    "shape: struct<links: array<struct<"
    "points: array<struct<lat: double, lng: double>>, length: double, functionalClass: string>>>>, "
    "currentFlow: struct<speed: double, speedUncapped: double, freeFlow: double, "
    "jamFactor: double, confidence: double, traversability: string>>>"
)

# Column names of the stored tables.
CLEAN_FLOW = (
    "timestamp timestamp, street_name string, traverse_length double, "
    "links array<struct<points: array<struct<lat: double, lng: double>>, length: double, "
    "functionalClass: string>>, "
    "speed double, jamFactor double, confidence double, traversability string, freeFlowSpeed double"
)
ROAD_EDGES = (
    "osmid string, u bigint, v bigint, name string, oneway boolean, highway string, "
    "length double, maxspeed string, lanes string, geometry binary"
)
ROAD_NETWORK = (
    "u bigint, v bigint, osmid string, name string, oneway boolean, highway string, "
    "speed_limit double, lanes string, length double, azimuth double, "
    "geometry array<struct<x: double, y: double>>"
)
ROAD_SEGMENTS = (
    "segment_id string, osmid string, u bigint, v bigint, name string, oneway boolean, "
    "highway string, speed_limit double, lanes string, azimuth double, length double, "
    "geometry array<struct<x: double, y: double>>"
)
TRAFFIC_EVENTS = (
    "street_id string, timestamp timestamp, speed double, jamFactor double, confidence double, "
    "traversability string, freeFlowSpeed double, congestion_level string"
)
LABELLED_EVENTS = (
    "timestamp timestamp, street_id bigint, traverse_length double, speed double, "
    "jamFactor double, confidence double, traversability string, freeFlowSpeed double, "
    "congestion_level string, wkt_shape string"
)
STREET_LABELS = "street_id bigint, street_name string"


def struct(ddl: str) -> T.StructType:
    """The schema of a text; needs a running session."""
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Reorder and cast ``df`` to a schema; a missing required column or a narrowing cast fails."""
    return df.to(struct(ddl))
