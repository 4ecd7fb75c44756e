"""Street labels: ids for street names, and the older fact keyed by them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadpulse.functions import geometry as geo
from roadpulse.functions.traffic import congestion_level
from roadpulse.operators.matching import with_flow_line
from roadpulse.operators.rows import keyed_join, numbered

# Columns of the older fact.
LABELLED_COLUMNS = ["timestamp", "street_id", "traverse_length", "speed", "jamFactor", "confidence",
                    "traversability", "freeFlowSpeed", "congestion_level", "wkt_shape"]


def street_names(flow: DataFrame) -> DataFrame:
    """Distinct usable names. NULL and blank ones are left out: they would be new on every run."""
    return flow.select("street_name").filter(F.trim("street_name") != "").distinct()


def new_streets(flow: DataFrame, labels: DataFrame) -> DataFrame:
    return street_names(flow).join(labels.select("street_name"), "street_name", "left_anti")


def extend_labels(flow: DataFrame, labels: DataFrame) -> DataFrame:
    """Known labels and new ones, numbered by name after the greatest known id."""
    top = labels.agg(F.coalesce(F.max("street_id"), F.lit(0)) + 1).scalar()
    fresh = numbered(new_streets(flow, labels), ["street_name"], "street_id", start=top)
    return labels.select("street_id", "street_name").unionByName(fresh.select("street_id", "street_name"))


def attach_labels(flow: DataFrame, labels: DataFrame) -> DataFrame:
    """Left join of the label id; names may be hot and NULL, which is left to Spark to split."""
    return keyed_join(flow.drop("street_id"), labels.select("street_id", "street_name"), "street_name", how="left")


def label_streets(flow: DataFrame, labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The extended labels, and the flow with congestion level and label id."""
    extended = extend_labels(flow, labels)
    levelled = flow.withColumn("congestion_level", congestion_level(F.col("jamFactor")))
    return extended, attach_labels(levelled, extended)


def labelled_events(labelled: DataFrame) -> DataFrame:
    """The older fact: label id, measures and the shape as text in lon lat order."""
    shaped = with_flow_line(labelled).withColumn("wkt_shape", F.expr(geo.to_wkt("line")))
    return shaped.select(*LABELLED_COLUMNS)
