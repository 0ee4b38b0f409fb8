"""Session settings and the scratch area that derived tables are written to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.constants import CHUNK_SIZE

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Partition values are labels: a language code such as "nan" must stay text.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    # Audio rows are large: few per Arrow batch, and bounded bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": str(CHUNK_SIZE),
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 * 1024 * 1024),
    # A task rarely meets more than a few partitions: write them side by side
    # instead of sorting wide audio rows first.
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def build_session(app_name: str = "voxloom", **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the SQL options on a session somebody else created."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by the session."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
    folder = tempfile.mkdtemp(prefix="voxloom-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, which tasks must know to open it without Spark."""
    place, _ = _hadoop(spark, path)
    return place.toString()


def exists(spark: SparkSession, path: str) -> bool:
    place, system = _hadoop(spark, path)
    return system.exists(place)


def _hadoop(spark: SparkSession, path: str) -> tuple:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return system.makeQualified(place), system


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(spark: SparkSession, df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back."""
    path = scratch_path(spark, name)
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def within_bounds(
    df: DataFrame, max_rows: int = 100_000, max_bytes: int = 32 * 1024 * 1024
) -> bool:
    """Measure whether a flat table has at most that many rows and bytes."""
    width = F.lit(0)
    for name, kind in df.dtypes:
        size = F.octet_length(F.col(f"`{name}`")) if kind == "string" else F.lit(16)
        width = width + F.coalesce(size, F.lit(0))
    found = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(width)).first()
    return found[0] <= max_rows and (found[1] or 0) <= max_bytes


def as_lookup(df: DataFrame, name: str = "lookup", **bounds: int) -> DataFrame:
    """The lookup side of a join whose other side may have hot keys.

    It becomes a table of its own, so that it is computed once. Measured small, that
    is broadcast. Otherwise both inputs of the join are plain shuffles, which AQE splits where a
    key is hot. It would not do so above an aggregate that happens to be
    partitioned by the join key.
    """
    table = cut_lineage(df.sparkSession, df, name)
    return F.broadcast(table) if within_bounds(table, **bounds) else table


def spread_if_few_files(df: DataFrame) -> DataFrame:
    """Use every core for costly row work on a table of fewer splits than cores.

    Large inputs have enough splits and are left where they are. Spark plans them without
    reading rows; no file name reaches Python.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if scan_splits(df) < cores else df


def scan_splits(df: DataFrame) -> int:
    """Splits of the widest scan below a plan, as the file sources plan them."""
    scans = df._jdf.queryExecution().sparkPlan().collectLeaves()
    widths = [scans.apply(i).execute().getNumPartitions() for i in range(scans.size())]
    return max(widths, default=0)
