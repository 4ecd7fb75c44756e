"""Session settings and lineage cuts shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "roadpulse", master: str | None = None,
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """A session with the settings the library is written for.

    Shuffle partitions stay at Spark's own setting unless given: on a cluster AQE
    coalesces from a high initial number, and only local tests want a small one.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.sql.sources.partitionOverwriteMode", "dynamic")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it.

    Only a local session without the setting gets a temporary folder; a cluster
    session without it is an error, as executors could not read each other's disks.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        configured = tempfile.mkdtemp(prefix="roadpulse-checkpoint-")
    context.setCheckpointDir(configured)
    return configured


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Hash rows over at least as many partitions as there are cores.

    For rows that are few in bytes but costly to work on, such as lines before a spatial
    join: adaptive execution would put them into few partitions by their size.
    """
    spark = df.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, *keys)


def cut_lineage(df: DataFrame, spread_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` to the reliable checkpoint folder and go on from the written rows."""
    checkpoint_dir(df.sparkSession)
    return (spread(df, *spread_by) if spread_by else df).checkpoint(eager=True)


def keep_small(df: DataFrame) -> DataFrame:
    """Write ``df`` to Parquet below the checkpoint folder and go on from there.

    Rows of a checkpoint still count as many as what they were made from was thought to be; files have their own size, by which
    Spark decides on broadcasts. For tables that are much smaller than those they are joined to.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
