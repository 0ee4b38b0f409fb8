"""The audit manifest of a composed corpus and the gates that read it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.operators.paths import RESOLVED
from voxloom.operators.sanitize import KEEP
from voxloom.sources.corpus import SOURCE_FILE

MANIFEST_KEYS = ["corpus", "source_split", "destination_split", "source_language", "language"]


def file_counts(rows: DataFrame, files: DataFrame | None, keys: list[str]) -> DataFrame:
    """Rows read, rows kept and paths replaced per source file.

    Listed files join in as rows that count nothing, so files without a single
    row show up too.
    """
    counted = rows.select(*keys, SOURCE_FILE, F.lit(1).alias("one"), KEEP, RESOLVED)
    if files is not None:
        nothing = [F.lit(0).alias("one"), F.lit(False).alias(KEEP), F.lit(0).alias(RESOLVED)]
        counted = counted.unionByName(files.select(*keys, SOURCE_FILE, *nothing))
    return counted.groupBy(*keys, SOURCE_FILE).agg(
        F.sum("one").alias("rows_before"),
        F.count_if(KEEP).alias("rows_after"),
        F.sum(RESOLVED).alias("normalized_audio_paths"),
    )


def composition_manifest(
    rows: DataFrame, files: DataFrame | None = None, keys: list[str] = MANIFEST_KEYS
) -> DataFrame:
    """One row of counters per partition.

    ``rows`` carries the keys, the source file, ``keep`` and the number of
    replaced paths; ``files`` lists every (keys, source file). Paths are counted
    before rows are dropped. Both steps combine before they shuffle.
    """
    return (
        file_counts(rows, files, keys)
        .groupBy(*keys)
        .agg(
            F.count_if(F.col("rows_after") > 0).alias("parquet_files"),
            F.sum("rows_before").alias("rows_before"),
            F.sum("rows_after").alias("rows_after"),
            F.sum(F.col("rows_before") - F.col("rows_after")).alias("dropped_rows"),
            F.count_if(F.col("rows_after") == 0).alias("dropped_files"),
            F.sum("normalized_audio_paths").alias("normalized_audio_paths"),
        )
    )


def emptied_partitions(manifest: DataFrame) -> DataFrame:
    """Partitions that would contribute no row at all."""
    return manifest.where(F.col("parquet_files") == 0)


def check_composition(manifest: DataFrame) -> None:
    """Fail when nothing was found, or a partition lost all its rows."""
    if not manifest.limit(1).count():
        raise FileNotFoundError("no Parquet partition found in any source")
    emptied = emptied_partitions(manifest).select(*MANIFEST_KEYS).take(20)
    if emptied:
        raise ValueError(f"all rows were filtered out of {[r.asDict() for r in emptied]}")


def missing_source_splits(present: DataFrame, expected: DataFrame) -> DataFrame:
    """Expected (source, split) pairs without any partition."""
    return F.broadcast(expected).join(present, ["source", "split"], "left_anti")


def check_manifest_fields(manifest: DataFrame) -> DataFrame:
    """Fail on a manifest written before rows were sanitized and paths resolved."""
    missing = [name for name in C.MANIFEST_COUNTERS if name not in manifest.columns]
    if missing:
        raise ValueError(f"stale manifest, rebuild the corpus: missing {missing}")
    return manifest
