"""The ingest path as Structured Streaming: cleaning, late and repeated snapshots, windows, latest state.

The transformations are the batch ones; only sources, watermarks and sinks differ.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from roadpulse.model import SNAPSHOT
from roadpulse.operators.clean import MIN_CONFIDENCE, clean_flow, flatten_snapshots
from roadpulse.operators.gold import jam_episodes, windowed_congestion
from roadpulse.operators.serving import latest_per_street
from roadpulse.plans.jobs import store_flow
from roadpulse.session import cut_lineage
from roadpulse.sources.snapshots import with_delivery, with_location
from roadpulse.sources.tables import drop_partition


def snapshot_stream(spark: SparkSession, path: str, files_per_batch: int = 1000, arrival: bool = False) -> DataFrame:
    """New snapshot files of a folder, as a stream; ``arrival`` adds ``arrived``, the time of the file."""
    found = spark.readStream.schema(SNAPSHOT).option("maxFilesPerTrigger", files_per_batch).json(path)
    return found.select("*", F.col("_metadata.file_modification_time").alias("arrived")) if arrival else found


def arriving_rows(snapshots: DataFrame, delay: str = "2 days") -> DataFrame:
    """Flat rows of a snapshot stream, as they come with a newer delivery of their time and place.

    State holds for each time and place which delivery was the last, by arrival and key, and a timer forgets it ``delay`` after the
    watermark has passed that time. Rows of an older delivery, or of the same again, give nothing; a newer one gives its rows,
    which replace those given before. The stream needs ``arrived``; what is written with ``keep_flow`` equals the batch job's table.
    """
    flat = with_location(flatten_snapshots(with_delivery(snapshots)))
    columns = [c for c in flat.columns if c not in ("timestamp", "location", "arrived", "delivery")]
    packed = flat.select("timestamp", "location", "arrived", "delivery", F.to_json(F.struct(*columns)).alias("row"))
    milliseconds = int(pd.Timedelta(delay).total_seconds() * 1000)

    def newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        rows = pd.concat(list(batches))
        best = max(zip(rows["arrived"], rows["delivery"]))
        known = tuple(state.get) if state.exists else None
        if known is not None and (pd.Timestamp(known[0], unit="us"), known[1]) >= best:
            return
        state.update((int(best[0].value // 1000), best[1]))
        if not pd.isna(key[0]):
            state.setTimeoutTimestamp(max(int(pd.Timestamp(key[0]).value // 1_000_000), state.getCurrentWatermarkMs()) + milliseconds)
        own = rows[(rows["arrived"] == best[0]) & (rows["delivery"] == best[1])]
        yield own.drop_duplicates()[["timestamp", "location", "arrived", "delivery", "row"]]

    kept = packed.withWatermark("timestamp", delay).groupBy("timestamp", "location").applyInPandasWithState(
        newest, "timestamp timestamp, location string, arrived timestamp, delivery string, row string",
        "arrived long, delivery string", "update", GroupStateTimeout.EventTimeTimeout)
    shape = T.StructType([flat.schema[c] for c in columns])
    return kept.withColumn("row", F.from_json("row", shape)).select("timestamp", "location", "arrived", "delivery", "row.*")


def keep_flow(rows: DataFrame, path: str, checkpoint: str, min_confidence: float = MIN_CONFIDENCE, every: str | None = None) -> StreamingQuery:
    """Cleans rows of ``arriving_rows`` and adds each batch to the stored flow, where it replaces what its times and places had."""
    def write(batch: DataFrame, batch_id: int) -> None:
        store_flow(cut_lineage(batch), path, min_confidence)

    writer = rows.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def unrepeated(snapshots: DataFrame, delay: str = "2 days", keys: tuple[str, ...] = ("sourceUpdated", "delivery")) -> DataFrame:
    """Drop snapshots delivered again; state for a key is kept no longer than the delay.

    The key has the content in it, so two areas of one time both stay.
    """
    keyed = snapshots if "delivery" in snapshots.columns else with_delivery(snapshots)
    return keyed.withWatermark("sourceUpdated", delay).dropDuplicatesWithinWatermark(list(keys))


def clean_stream(snapshots: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Clean flow rows out of a snapshot stream, by the batch rules."""
    return clean_flow(snapshots, min_confidence)


def timed(events: DataFrame, delay: str) -> DataFrame:
    """Events with a watermark; times without a zone are read as UTC session time first."""
    return events.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", delay)


def windowed_stream(events: DataFrame, length: str = "15 minutes", slide: str | None = None, delay: str = "1 hour",
                    keys: tuple[str, ...] = ("street_id",)) -> DataFrame:
    return windowed_congestion(timed(events, delay), length, slide, keys)


def episode_stream(events: DataFrame, gap: str = "30 minutes", min_jam: float = 7.0, delay: str = "1 hour") -> DataFrame:
    return jam_episodes(timed(events, delay), gap, min_jam)


def to_parquet(stream: DataFrame, path: str, checkpoint: str, mode: str = "append", every: str | None = None) -> StreamingQuery:
    """Write a stream to a folder: all that is there now, or on with a trigger interval."""
    writer = stream.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint).option("path", path)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def latest_writer(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that keeps the newest event per street of each batch.

    A batch is one row per changed street in a partition of its own, named by the query and the batch, so a
    repeated batch replaces itself, no batch rewrites the whole state, and a query that starts anew
    with another checkpoint does not touch what an earlier one wrote.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        run = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"
        (latest_per_street(batch).withColumns({"run": F.lit(run), "batch_id": F.lit(batch_id)})
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run", "batch_id").parquet(path))

    return write


def keep_latest(events: DataFrame, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    writer = events.writeStream.foreachBatch(latest_writer(path)).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)).start()


def read_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest event per street over all batches."""
    return latest_per_street(spark.read.parquet(path).drop("run", "batch_id"))


def compact_latest(spark: SparkSession, path: str) -> int:
    """Merge the batches that are there into one partition and remove them; returns how many there were.

    The merged rows are written before anything goes, and a row that is there twice changes no
    result, so readers are right at each moment, and a run that breaks off is finished by the next.
    """
    merged = [r.asDict() for r in spark.read.parquet(path).select("run", "batch_id").distinct().collect()]
    (read_latest(spark, path).withColumns({"run": F.lit(f"merged-{uuid.uuid4().hex}"), "batch_id": F.lit(0)})
     .write.mode("append").partitionBy("run", "batch_id").parquet(path))
    for keys in merged:
        drop_partition(spark, path, keys)
    return len(merged)
