"""Row-level helpers that hold up under hot keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from roadpulse.session import cut_lineage


def one_row_per_key(df: DataFrame, keys: list[str], order: list[Column], newest: bool = False) -> DataFrame:
    """One whole row per key, the least (or greatest) by ``order``.

    An aggregate, not a window: each task first keeps one row per key, so the copies of a
    hot key never meet in one task.
    """
    rest = [c for c in df.columns if c not in keys]
    pick = F.max_by if newest else F.min_by
    picked = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("kept"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"kept.{c}").alias(c) for c in df.columns])


def drop_copies(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key, the least over all other columns, so the choice never depends on order."""
    return one_row_per_key(df, keys, [F.col(c) for c in df.columns if c not in keys])


def keyed_join(fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, how: str = "inner") -> DataFrame:
    """Join a large fact side to a keyed table whose keys may be hot (or NULL) in the facts.

    A plain join: Spark broadcasts the keyed side when its size is below the session's bound, and otherwise adaptive
    execution splits the partitions that hot keys make large, as many ways as their size asks for.
    Nothing is repeated when no key is hot. Output columns: those of ``fact``, then those of ``dim`` but its key.
    """
    right = dim.withColumnRenamed(dim_key or key, "_dim_key")
    joined = fact.join(right, fact[key] == right["_dim_key"], how)
    return joined.drop("_dim_key")


def numbered(df: DataFrame, order: list[str], name: str, start: Column | int = 1) -> DataFrame:
    """Consecutive numbers in the order of ``order``, without one task seeing all rows.

    Rows are range-partitioned and kept; only one count per partition is then gathered to
    find where each partition starts.
    """
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    kept = cut_lineage(ranged)
    sizes = kept.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # One row per partition, so this window and the broadcast are small by construction.
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (kept.join(F.broadcast(offsets), "_part")
            .withColumn(name, (F.col("_offset") + within - 1 + start).cast("bigint"))
            .drop("_part", "_offset"))
