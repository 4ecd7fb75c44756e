"""Stored tables: Parquet folders and JDBC tables behind one reading and writing surface."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadpulse.functions import geometry as geo
from roadpulse.model import conform

# Driver class, batch size and text handling of the serving database.
POSTGRES_DRIVER = "org.postgresql.Driver"
BATCH_SIZE = 1000
SEGMENT_COLUMNS = ["segment_id", "osmid", "name", "oneway", "highway", "u", "v", "speed_limit", "lanes", "length", "azimuth"]


@dataclass(frozen=True)
class Jdbc:
    """How to reach a database table. Extra options go to Spark as they are."""

    url: str
    table: str
    user: str
    password: str = field(repr=False)
    driver: str = POSTGRES_DRIVER
    options: dict[str, str] = field(default_factory=dict)

    def read_options(self, partition_column: str | None = None, bounds: tuple[int, int] | None = None,
                     partitions: int = 1, fetch_size: int = 10_000) -> dict[str, str]:
        """Options of a scan; with a numeric column and its bounds the scan runs in parallel."""
        base = {"url": self.url, "dbtable": self.table, "user": self.user, "password": self.password,
                "driver": self.driver, "fetchsize": str(fetch_size)}
        if partition_column:
            low, high = bounds
            base |= {"partitionColumn": partition_column, "lowerBound": str(low), "upperBound": str(high),
                     "numPartitions": str(partitions)}
        return base | self.options

    def write_options(self, keep_table: bool = False) -> dict[str, str]:
        """Options of a write; ``keep_table`` empties the table on overwrite and keeps its keys and indexes."""
        base = {"url": self.url, "dbtable": self.table, "user": self.user, "password": self.password,
                "driver": self.driver, "batchsize": str(BATCH_SIZE), "stringtype": "unspecified"}
        return base | ({"truncate": "true"} if keep_table else {}) | self.options


def segment_subquery(table: str) -> str:
    """A pushed query for the segment columns with the geometry as binary."""
    return f"(SELECT {', '.join(SEGMENT_COLUMNS)}, ST_AsBinary(geometry) AS geometry FROM {table}) AS segments"


def read_table(spark: SparkSession, source: str | Jdbc, **scan) -> DataFrame:
    """A Parquet folder by path, or a database table."""
    if isinstance(source, Jdbc):
        return spark.read.format("jdbc").options(**source.read_options(**scan)).load()
    return spark.read.parquet(source)


def load_segments(spark: SparkSession, source: str | Jdbc, **scan) -> DataFrame:
    """Road segments from either store, with the geometry as a line."""
    if isinstance(source, Jdbc):
        source = Jdbc(source.url, segment_subquery(source.table), source.user, source.password, source.driver, source.options)
    segments = read_table(spark, source, **scan)
    kind = segments.schema["geometry"].dataType
    if isinstance(kind, T.BinaryType):
        return segments.withColumn("geometry", geo.from_wkb("geometry"))
    if isinstance(kind, T.StringType):
        return segments.withColumn("geometry", geo.from_hex_wkb("geometry"))
    return segments


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite",
                  schema: str | None = None) -> DataFrame:
    """Write, read back and return the stored rows.

    Overwriting a partitioned table replaces only the partitions that ``df`` has rows for.
    """
    shaped = conform(df, schema) if schema is not None else df
    writer = shaped.write.mode(mode)
    if partition_by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by)
    writer.parquet(path)
    return read_back(df.sparkSession, path, shaped.columns)


def drop_partition(spark: SparkSession, path: str, keys: dict) -> None:
    """Remove one partition folder of a stored table, if it is there."""
    parts = [f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for k, v in keys.items()]
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join([path, *parts]))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def read_back(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Open what was written and check that every column is there."""
    stored = spark.read.parquet(path)
    missing = set(columns) - set(stored.columns)
    if missing:
        raise ValueError(f"{path} lacks {sorted(missing)}")
    return stored


def with_box_columns(lines: DataFrame, line: str = "geometry") -> DataFrame:
    """Add ``xmin, ymin, xmax, ymax`` so that scans can skip files by a map window."""
    return lines.withColumn("_box", F.expr(geo.bounds(line))).select(*lines.columns, "_box.*")


def write_segments(segments: DataFrame, path: str, tile_degrees: float = 0.1) -> DataFrame:
    """Segments with box columns, near ones in the same files, so map windows read few files."""
    boxed = with_box_columns(segments)
    tile = [F.floor(F.col(c) / tile_degrees).alias(f"_{c}") for c in ("xmin", "ymin")]
    # The place inside the tile lets a dense tile spread over several tasks and sorts its row groups.
    order = ["_xmin", "_ymin", "xmin", "ymin"]
    placed = boxed.select("*", *tile).repartitionByRange(*order).sortWithinPartitions(*order)
    return write_parquet(placed.drop("_xmin", "_ymin"), path)


def append_events(events: DataFrame, path: str) -> DataFrame:
    """Add events by day; a day that comes again is kept beside the old rows."""
    dated = events.withColumn("day", F.to_date("timestamp"))
    return write_parquet(dated, path, ["day"], mode="append")


def write_jdbc(df: DataFrame, target: Jdbc, mode: str = "append", keep_table: bool = False, stamp: bool = False) -> None:
    """Write to a database table; lines go as hex WKB, ``stamp`` adds the load time."""
    out = df
    for f in df.schema.fields:
        if f.dataType.simpleString() == "array<struct<x:double,y:double>>":
            out = out.withColumn(f.name, geo.to_hex_wkb(f.name))
    if stamp:
        out = out.withColumn("created_at", F.current_timestamp())
    out.write.format("jdbc").options(**target.write_options(keep_table)).mode(mode).save()
