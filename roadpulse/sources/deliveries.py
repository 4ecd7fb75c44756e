"""A stored table of deliveries: files are only added, and a manifest that is written last says which ones count.

A run writes its rows into a folder of its own, split by day, and, beside it, the keys of stored rows that it replaces. Then it adds a
manifest that lists the runs of the table. Readers take the newest manifest, so a run that breaks off is never seen, and a row
counts until a later run restates its key: the newest arrival wins. Files grow with bytes and runs, not with
payloads; ``compact`` puts the rows that count into one run again.

Layout below the table's path: ``data/run=R/day=D/*.parquet``, ``gone/run=R/*.parquet``, ``_manifest/V.json``.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("timestamp", "location")


def _hadoop(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none where it is not there."""
    files, where = _hadoop(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(where)) if files.exists(where) else []


def manifest(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    """The newest version (0 before the first) and its runs, each with ``run`` and whether it replaced rows."""
    versions = [n for n in names_in(spark, f"{path}/_manifest") if n.endswith(".json")]
    if not versions:
        return 0, []
    files, where = _hadoop(spark, f"{path}/_manifest/{versions[-1]}")
    stream = files.open(where)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return int(versions[-1].removesuffix(".json")), json.loads(text)


def _commit(spark: SparkSession, path: str, version: int, runs: list[dict]) -> None:
    """Writes a manifest under another name and renames it; fails if another writer was first."""
    files, where = _hadoop(spark, f"{path}/_manifest/{version:012d}.json")
    _, draft = _hadoop(spark, f"{path}/_manifest/.{uuid.uuid4().hex}")
    out = files.create(draft, False)
    try:
        out.write(bytearray(json.dumps(runs).encode()))
    finally:
        out.close()
    if files.exists(where) or not files.rename(draft, where):
        files.delete(draft, False)
        raise RuntimeError(f"another run has written version {version} of {path}")


def _rows(spark: SparkSession, path: str, runs: list[dict]) -> DataFrame | None:
    """Rows of the listed runs that no later one replaced, with ``run`` and ``day``."""
    have = [f"{path}/data/run={r['run']}" for r in runs if r["rows"]]
    if not have:
        return None
    # Days are folders; their names are read as text so that a table of one day has the same type as any other.
    stored = spark.read.option("basePath", f"{path}/data").parquet(*have).withColumns({"day": F.col("day").cast("date"), "run": F.col("run").cast("string")})
    gone = [f"{path}/gone/run={r['run']}" for r in runs if r["gone"]]
    if not gone:
        return stored
    replaced = spark.read.parquet(*gone).withColumnRenamed("old", "run")
    same = [stored[c].eqNullSafe(replaced[c]) for c in replaced.columns]
    return stored.join(replaced, same, "left_anti")


def read(spark: SparkSession, path: str) -> DataFrame:
    """The rows that count, each key by its newest delivery; ``day`` is the day of its time."""
    rows = _rows(spark, path, manifest(spark, path)[1])
    if rows is None:
        raise ValueError(f"{path} holds no rows")
    return rows.drop("run")


def write(rows: DataFrame, delivered: DataFrame, path: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """Adds a run: ``rows`` are stored, and what earlier runs hold under any key of ``delivered`` no longer counts.

    ``rows`` have ``timestamp`` and the keys; ``delivered`` has the keys of all that came, also of what was filtered
    out of ``rows``. Both are read more than once, so they should be stored. Only the days of the delivered keys are looked up.
    Returns the rows that count now.
    """
    spark = rows.sparkSession
    version, runs = manifest(spark, path)
    run = f"{version + 1:012d}-{uuid.uuid4().hex[:8]}"
    stored, replaced = _rows(spark, path, runs), False
    if stored is not None:
        came = delivered.select(*keys).distinct().withColumn("day", F.to_date("timestamp"))
        same = [stored[c].eqNullSafe(came[c]) for c in (*keys, "day")]
        old = stored.select("run", "day", *keys).join(came, same, "left_semi").select(F.col("run").alias("old"), *keys).distinct()
        old.write.mode("overwrite").parquet(f"{path}/gone/run={run}")
        replaced = not spark.read.parquet(f"{path}/gone/run={run}").isEmpty()
    written = _append(rows, path, run, keys)
    _commit(spark, path, version + 1, [*runs, {"run": run, "rows": written, "gone": replaced}])
    counted = _rows(spark, path, manifest(spark, path)[1])
    return rows.withColumn("day", F.to_date("timestamp")).limit(0) if counted is None else counted.drop("run")


def _append(rows: DataFrame, path: str, run: str, keys: tuple[str, ...]) -> bool:
    """Sorted files of one run, as many as its bytes ask for; whether there are any."""
    dated = rows.withColumn("day", F.to_date("timestamp")).repartitionByRange(*keys).sortWithinPartitions(*keys)
    dated.write.mode("overwrite").partitionBy("day").parquet(f"{path}/data/run={run}")
    return any(n.startswith("day=") for n in names_in(rows.sparkSession, f"{path}/data/run={run}"))


def compact(spark: SparkSession, path: str, keys: tuple[str, ...] = KEYS) -> int:
    """Puts the rows that count into one run and lists only that; returns how many runs it merged."""
    version, runs = manifest(spark, path)
    rows = _rows(spark, path, runs)
    if rows is None or len(runs) < 2:
        return 0
    run = f"{version + 1:012d}-{uuid.uuid4().hex[:8]}"
    written = _append(rows.drop("run", "day"), path, run, keys)
    _commit(spark, path, version + 1, [{"run": run, "rows": written, "gone": False}])
    return len(runs)


def remove_unlisted(spark: SparkSession, path: str) -> int:
    """Deletes the files of runs that the newest manifest does not list, once no reader of an older one is left."""
    version, runs = manifest(spark, path)
    listed, removed = {f"run={r['run']}" for r in runs}, 0
    for kind in ("data", "gone"):
        for name in names_in(spark, f"{path}/{kind}"):
            if name not in listed:
                files, where = _hadoop(spark, f"{path}/{kind}/{name}")
                removed += bool(files.delete(where, True))
    return removed
