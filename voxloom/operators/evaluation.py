"""Evaluation rows: caps, duration filter, prediction rows, skip counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions.audio import duration_seconds, duration_status
from voxloom.operators.joins import RESERVED
from voxloom.session import as_lookup, cut_lineage
from voxloom.sources.tables import require_columns

STATUS = "status"
RECOGNITION_FAILED = "recognition_failed"


def cap_samples(df: DataFrame, order: list[str], limit: int | None) -> DataFrame:
    """The first ``limit`` rows in the given order; taken before any filter.

    ``order`` tells all rows apart. Only these columns are dealt out, in ranges, for the
    key of the last row to take: the range that holds it follows from the ranges' sizes,
    and only that one is sorted. The rows themselves, with their audio, are filtered where
    they are.
    """
    if limit is None:
        return df
    spark, key = df.sparkSession, F.struct(*order)
    ranged = df.select(key.alias("key")).repartitionByRange("key").withColumn("part", F.spark_partition_id())
    ranged = cut_lineage(spark, ranged, "sample-keys")
    # One row per range, at most the configured shuffle width.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    sizes = sizes.withColumn("start", F.coalesce(F.sum("size").over(before), F.lit(0)))
    holds = sizes.where((F.col("start") < limit) & (F.col("start") + F.col("size") >= limit))
    inside = ranged.join(F.broadcast(holds), "part")
    rank = F.row_number().over(Window.partitionBy("part").orderBy("key"))
    bound = inside.withColumn("rank", rank).where(F.col("start") + F.col("rank") == limit).select("key")
    bound = cut_lineage(spark, bound, "last-of-sample")
    if bound.isEmpty():
        return df if limit else df.limit(0)
    # One row: the bound.
    bound = F.broadcast(bound.select(F.col("key").alias(f"{RESERVED}last"), F.lit(1).alias(f"{RESERVED}one")))
    joined = df.withColumn(f"{RESERVED}one", F.lit(1)).join(bound, f"{RESERVED}one")
    return joined.where(key <= F.col(f"{RESERVED}last")).drop(f"{RESERVED}one", f"{RESERVED}last")


def with_duration_status(
    df: DataFrame,
    n_samples: Column,
    sample_rate: Column,
    limit: float = C.MAX_AUDIO_SECONDS,
) -> DataFrame:
    """Add ``seconds`` and whether a row is scored or why it is skipped."""
    seconds = duration_seconds(n_samples, sample_rate)
    timed = df.withColumn("seconds", seconds)
    return timed.withColumn(STATUS, duration_status(F.col("seconds"), limit))


def scorable(df: DataFrame) -> DataFrame:
    return df.where(is_scorable())


def is_scorable() -> Column:
    return F.col(STATUS) == "ok"


def status_counts(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.groupBy(*(keys or []), STATUS).agg(F.count(F.lit(1)).alias("samples"))


#: Every status that a sample can have.
STATUSES = ["ok", "too_long", "decode_failed", RECOGNITION_FAILED]


def watch_statuses(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows, and what will be the number of each status once an action has passed them."""
    seen = Observation()
    # A null status is no status of a sample, but is not lost.
    counts = [F.count_if(F.col(STATUS) == name).alias(name) for name in STATUSES]
    other = F.count_if(F.coalesce(~F.col(STATUS).isin(*STATUSES), F.lit(True))).alias("unknown")
    return df.observe(seen, *counts, other), seen


def counted_statuses(spark: SparkSession, seen: Observation) -> DataFrame:
    """(status, samples) of the statuses that were seen."""
    rows = [F.struct(F.lit(name), F.lit(n).cast("long")) for name, n in seen.get.items() if n]
    # Not createDataFrame, which has Python workers of another kind started to read a few rows.
    counts = F.array(*rows).cast(f"array<struct<{STATUS}: string, samples: bigint>>")
    return spark.range(1).select(F.inline(counts))


def with_position(df: DataFrame, file: str, row: str, name: str = "position") -> DataFrame:
    """Number all rows from 0 in (file, row) order, without a global sort of the rows.

    Only the rows per file are totalled; the offsets of the files come from a
    range-partitioned table of one row per file. ``row`` numbers the rows of a
    file from 0 without gaps.
    """
    counts = df.groupBy(file).agg((F.max(row) + 1).alias("rows"))
    ranged = counts.repartitionByRange(file).withColumn("part", F.spark_partition_id())
    ranged = cut_lineage(df.sparkSession, ranged, "file-offsets")
    totals = ranged.groupBy("part").agg(F.sum("rows").alias("part_rows"))
    # One row per range partition, at most the configured shuffle width.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("part", F.coalesce(F.sum("part_rows").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy(file).rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranged.join(F.broadcast(starts), "part").select(
        file, (F.col("start") + F.coalesce(F.sum("rows").over(inside), F.lit(0))).alias("offset")
    )
    # One short row per file; sample rows are too wide to shuffle for it.
    lookup = as_lookup(offsets)
    joined = df.join(lookup, file)
    return joined.withColumn(name, F.col("offset") + F.col(row)).drop("offset")


def prediction_rows(
    df: DataFrame, language: str, config: str, split: str, model_card: str
) -> DataFrame:
    """Rows in the prediction layout, with the run's values where a column is absent.

    Without an ``id`` column the position of the row among all samples is its id.
    """
    require_columns(df, "transcription", "prediction")
    row_id = F.col("id") if "id" in df.columns else F.col("position")
    spoken = F.col("language") if "language" in df.columns else F.lit(language)
    return df.select(
        row_id.cast("string").alias("id"),
        spoken.cast("string").alias("language"),
        F.lit(config).alias("config"),
        F.lit(split).alias("split"),
        F.col("transcription").alias("reference"),
        "prediction",
        F.lit(model_card).alias("model_card"),
    )
