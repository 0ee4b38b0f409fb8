"""Sinks: corpus, manifest, distribution, predictions, metrics, tables and reports."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.sources.corpus import PARTITION_KEYS
from voxloom.sources.tables import ROW_ORDER

MANIFEST_FOLDER = "_composition"
DISTRIBUTION_COLUMNS = ["dataset", "split", "language", "corpus", "hours", "path"]


def refuse_overlap(target: str, sources: list[str]) -> None:
    """Spark cannot overwrite a path that the same plan reads."""
    place = _normal(target)
    for source in sources:
        other = _normal(source)
        if place.startswith(other) or other.startswith(place):
            raise ValueError(f"output {target} overlaps input {source}")


def _normal(path: str) -> str:
    """Scheme and path without ``.``, ``..`` and doubled slashes, ending in a slash."""
    scheme, colon, rest = path.partition(":/")
    if not colon:
        scheme, rest = "file", path
    authority = ""
    if colon and rest.startswith("/") and scheme != "file":
        authority, _, rest = rest[1:].partition("/")
    return f"{scheme}://{authority}" + posixpath.normpath("/" + rest.lstrip("/")).rstrip("/") + "/"


def write_corpus(df: DataFrame, root: str) -> None:
    """Overwrite ``root`` with the corpus, partitioned by corpus, split and language.

    Rows are written by the tasks that read them: source files already follow the
    partitions, so no audio is shuffled.
    """
    df.write.mode("overwrite").partitionBy(*PARTITION_KEYS).parquet(root)


def write_manifest(manifest: DataFrame, root: str) -> None:
    """Write below ``root`` under a name that corpus scans skip; call after the corpus."""
    manifest.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(
        f"{root}/{MANIFEST_FOLDER}"
    )


def read_manifest(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.json(f"{root}/{MANIFEST_FOLDER}")


def write_distribution(distribution: DataFrame, path: str) -> None:
    """Hours per partition as one tab-separated file with a header."""
    (
        distribution.select(*DISTRIBUTION_COLUMNS)
        .coalesce(1)
        .write.mode("overwrite")
        .option("sep", "\t")
        .csv(path, header=True)
    )


def write_json(df: DataFrame, path: str) -> None:
    """Predictions or metrics as JSON lines, UTF-8, nulls kept."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_filled(df: DataFrame, path: str, source: str, joined: bool = False) -> None:
    """The filled table as CSV parts in input row order.

    Every part has a header, as Spark expects. With ``joined`` only the first one has, and
    the parts, one after the other in order of their names, are one CSV file: sorted by
    all tasks, without a task that writes it all.
    """
    refuse_overlap(path, [source])
    style = {"escape": '"', "emptyValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    if not joined:
        ordered = df.orderBy(ROW_ORDER).drop(ROW_ORDER)
        ordered.write.mode("overwrite").options(**style).csv(path, header=True)
        return
    names = [name for name in df.columns if name != ROW_ORDER]
    line = lambda *columns: F.to_csv(F.struct(*columns), style).alias("line")
    rows = df.select(F.lit(True).alias("row"), ROW_ORDER, line(*(F.col(f"`{name}`") for name in names)))
    kind = df.schema[ROW_ORDER].dataType
    head = df.sparkSession.range(1).select(
        F.lit(False).alias("row"), F.lit(None).cast(kind).alias(ROW_ORDER), line(*(F.lit(n).alias(n) for n in names))
    )
    write_lines(head.unionByName(rows), path, ["row", ROW_ORDER])


def write_lines(df: DataFrame, path: str, order: list[str]) -> None:
    """The ``line`` column as text parts in the given order."""
    df.orderBy(*order).select(F.col("line")).write.mode("overwrite").text(path)
