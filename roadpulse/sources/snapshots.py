"""Landing and reading raw traffic snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from roadpulse.functions.text import snapshot_key
from roadpulse.model import SNAPSHOT
from roadpulse.session import cut_lineage


def read_snapshots(spark: SparkSession, path: str, arrival: bool = False) -> DataFrame:
    """Snapshots, one JSON document per line, with the fixed schema.

    A field that does not fit its type becomes NULL; the rest of the document stays. ``arrival`` adds
    ``arrived``, the time of the file.
    """
    found = spark.read.schema(SNAPSHOT).option("mode", "PERMISSIVE").json(path)
    return found.select("*", F.col("_metadata.file_modification_time").alias("arrived")) if arrival else found


def broken_documents(spark: SparkSession, path: str) -> DataFrame:
    """Documents that do not parse, or not whole, as they are: column ``value``."""
    parsed = F.from_json("value", SNAPSHOT + ", broken string", {"columnNameOfCorruptRecord": "broken"})
    return spark.read.text(path).filter(parsed["broken"].isNotNull())


def content_key(*columns: str | Column) -> Column:
    """A 128-bit text key of the columns' values."""
    return F.lower(F.concat(F.hex(F.xxhash64(*columns)), F.hex(F.xxhash64(F.lit(1), *columns))))


def with_delivery(snapshots: DataFrame) -> DataFrame:
    """Add ``delivery``, a key of a snapshot's content: areas of one time differ, a repeat does not."""
    return snapshots.withColumn("delivery", content_key("sourceUpdated", "results"))


def distinct_deliveries(snapshots: DataFrame) -> DataFrame:
    """Each delivery once, with its key, and its last arrival where arrivals are known."""
    keyed = snapshots if "delivery" in snapshots.columns else with_delivery(snapshots)
    once = keyed.dropDuplicates(["sourceUpdated", "delivery"])
    if "arrived" not in keyed.columns:
        return once
    last = keyed.groupBy("delivery").agg(F.max("arrived").alias("arrived"))
    return once.drop("arrived").join(last, "delivery")


def with_location(flow: DataFrame) -> DataFrame:
    """Add ``location``, a key of the measured place (name and points of the shape) of flat flow rows."""
    return flow.withColumn("location", content_key("street_name", F.expr("transform(links, l -> l.points)")))


def newest_rows(flow: DataFrame) -> DataFrame:
    """Of flat flow rows with ``location``, ``arrived`` and ``delivery`` those of the newest delivery for each time and place.

    Deliveries of one arrival are told apart by their key. A delivery's rows stay together, also where it names a place twice.
    """
    rank = F.struct("arrived", "delivery")
    newest = F.max(rank).over(Window.partitionBy("timestamp", "location"))
    return flow.withColumn("_newest", newest).filter(rank == F.col("_newest")).drop("_newest")


def land_key(source_updated: Column) -> Column:
    return snapshot_key(source_updated)


def land_payloads(payloads: DataFrame, path: str, text: str = "value") -> None:
    """Add raw JSON documents as they are, in one folder per day (``unknown_time`` without one); files grow with bytes.

    A payload that the folder of its day holds already is left out, so landing it twice leaves it once, while other
    payloads of the same time, also a restated one, stay beside each other.
    """
    key = land_key(F.get_json_object(text, "$.sourceUpdated"))
    day = F.when(key.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}_"), F.substring(key, 1, 10)).otherwise(F.lit("unknown_time"))
    given = payloads.select(F.col(text).alias("value"), day.alias("day")).distinct()
    landed = _landed(payloads.sparkSession, path)
    fresh = given if landed is None else given.join(landed, ["day", "value"], "left_anti")
    # Stored before the write, as it reads the folder it adds to; adaptive execution sizes the files.
    cut_lineage(fresh).repartition("day").write.mode("append").partitionBy("day").text(path)


def _landed(spark: SparkSession, path: str) -> DataFrame | None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(where) or not any(f.isDirectory() for f in files.listStatus(where)):
        return None
    return spark.read.text(path).select(F.col("day").cast("string").alias("day"), "value")


def layer_path(raw_path: str, layer: str) -> str:
    """The path of another layer: the folder named ``raw`` and the file ending change, nothing else."""
    parts = raw_path.split("/")
    if "raw" not in parts:
        raise ValueError(f"no raw folder in {raw_path}")
    parts[parts.index("raw")] = layer
    moved = "/".join(parts)
    return moved[: -len(".json")] + ".parquet" if moved.endswith(".json") else moved
