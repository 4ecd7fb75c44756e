"""Dimensions, fact and aggregates for analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo


def road_key(segment: DataFrame | None = None) -> Column:
    return F.xxhash64("osmid", "u", "v")


def time_key(timestamp: str = "timestamp") -> Column:
    """Hour as a number: yyyyMMddHH."""
    return F.date_format(timestamp, "yyyyMMddHH").cast("bigint")


def road_dim(segments: DataFrame) -> DataFrame:
    """One row per road edge that has segments."""
    return segments.select(road_key().alias("road_key"), "osmid", "u", "v", "name", "highway", "oneway",
                           "speed_limit", "lanes").distinct()


def location_dim(segments: DataFrame) -> DataFrame:
    """One row per segment: its road, start, end and length."""
    first, last = geo.start_point("geometry"), geo.end_point("geometry")
    return segments.select(
        F.xxhash64("segment_id").alias("location_key"), "segment_id", road_key().alias("road_key"),
        F.expr(f"{first}.x").alias("start_lon"), F.expr(f"{first}.y").alias("start_lat"),
        F.expr(f"{last}.x").alias("end_lon"), F.expr(f"{last}.y").alias("end_lat"), "length")


def time_dim(events: DataFrame) -> DataFrame:
    hours = events.select(F.date_trunc("hour", "timestamp").alias("hour")).distinct()
    return hours.select(
        time_key("hour").alias("time_key"), "hour", F.to_date("hour").alias("day"), F.year("hour").alias("year"),
        F.month("hour").alias("month"), F.dayofmonth("hour").alias("day_of_month"), F.hour("hour").alias("hour_of_day"),
        (F.weekday("hour") + 1).alias("day_of_week"))


def congestion_fact(events: DataFrame) -> DataFrame:
    """Events with dimension keys, computed from their own values, so no join is needed."""
    return events.select(
        F.xxhash64("street_id").alias("location_key"), time_key().alias("time_key"), "timestamp", "speed", "freeFlowSpeed",
        "jamFactor", "confidence", "traversability", "congestion_level")


def hourly_jam(events: DataFrame, segments: DataFrame) -> DataFrame:
    """Events, mean and worst jam factor per hour and road class.

    Events are added up per street and hour first; only those sums meet the segments.
    """
    sums = events.groupBy("street_id", F.date_trunc("hour", "timestamp").alias("hour")).agg(
        F.count("*").alias("n"), F.sum("jamFactor").alias("total"), F.count("jamFactor").alias("known"),
        F.max("jamFactor").alias("worst"))
    roads = segments.select(F.col("segment_id").alias("street_id"), "highway")
    merged = sums.join(roads, "street_id").groupBy("hour", "highway").agg(
        F.sum("n").alias("events"), F.try_divide(F.sum("total"), F.sum("known")).alias("avg_jam"), F.max("worst").alias("max_jam"))
    return merged


def windowed_congestion(events: DataFrame, length: str = "15 minutes", slide: str | None = None,
                        keys: tuple[str, ...] = ("street_id",)) -> DataFrame:
    """Mean speed and jam per time window and street; the same on batch and stream."""
    span = F.window("timestamp", length, slide) if slide else F.window("timestamp", length)
    return events.groupBy(span.alias("span"), *keys).agg(
        F.count("*").alias("events"), F.avg("speed").alias("avg_speed"), F.avg("jamFactor").alias("avg_jam"),
        F.max("jamFactor").alias("max_jam"),
    ).select(F.col("span.start").alias("window_start"), F.col("span.end").alias("window_end"), *keys,
             "events", "avg_speed", "avg_jam", "max_jam")


def jam_episodes(events: DataFrame, gap: str = "30 minutes", min_jam: float = 7.0) -> DataFrame:
    """Runs of jammed events per street, split where none comes for ``gap``; the same on batch and stream."""
    jammed = events.filter(F.col("jamFactor") >= min_jam)
    return jammed.groupBy(F.session_window("timestamp", gap).alias("span"), "street_id").agg(
        F.count("*").alias("events"), F.max("jamFactor").alias("max_jam"),
    ).select(F.col("span.start").alias("episode_start"), F.col("span.end").alias("episode_end"), "street_id", "events", "max_jam")
