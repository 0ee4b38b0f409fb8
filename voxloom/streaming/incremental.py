"""Incremental inference and running error totals with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from voxloom import constants as C
from voxloom.operators.evaluation import STATUS, counted_statuses, is_scorable, watch_statuses
from voxloom.operators.inference import Predictor, transcribe
from voxloom.operators.joins import RESERVED
from voxloom.operators.scoring import COUNTS, score_rows, score_totals
from voxloom.sinks.published import current_version, prune, publish, version_folder


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 64
) -> DataFrame:
    """Parquet files of ``path`` as a stream, a bounded number per micro-batch."""
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def append_predictions(
    samples: DataFrame,
    make_predictor: Callable[[], Predictor],
    audio: str,
    out: str,
    checkpoint: str,
    batch_size: int = C.BATCH_SIZE,
    counts: str | None = None,
) -> StreamingQuery:
    """Predict the scorable samples of each micro-batch and write them as JSON in ``out/batch=<id>``.

    Runs until all files present are done; a restart with the same checkpoint
    goes on after the last finished micro-batch, and one that runs again replaces what it
    wrote before. ``counts`` names a folder for the samples of each status, which the pass
    that writes the predictions observes: all samples go through it, and only the scorable
    ones to the recognizer.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        flagged = batch.withColumn(_SCORABLE, F.coalesce(is_scorable(), F.lit(False)))
        heard = transcribe(flagged, make_predictor, audio, batch_size, only=_SCORABLE)
        watched, seen = watch_statuses(heard)
        kept = watched.where(_SCORABLE).drop(_SCORABLE)
        kept.write.mode("overwrite").option("ignoreNullFields", "false").json(f"{out}/batch={number}")
        if counts is not None:
            counted_statuses(spark, seen).coalesce(1).write.mode("overwrite").json(f"{counts}/batch={number}")

    return (
        samples.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_SCORABLE = f"{RESERVED}scorable"


def keep_totals(
    predictions: DataFrame, keys: list[str], out: str, checkpoint: str
) -> StreamingQuery:
    """Running sums of edits and units per group; read them with ``last_totals``.

    Where predictions have a ``status``, only those that are ok are scored; ``skipped``
    counts the others. The state is one row of sums per group; rates follow from the sums with
    ``with_rates``. Each micro-batch publishes its totals as a version of its own, so that
    readers see the last whole one, whether a batch dies or runs again.
    """
    if STATUS not in predictions.columns:
        totals = score_totals(score_rows(predictions), keys)
    else:
        texts = {name: F.when(is_scorable(), F.col(name)) for name in ("reference", "prediction")}
        totals = score_rows(predictions.withColumns(texts)).groupBy(*keys).agg(
            F.count_if(is_scorable()).alias("num_samples"),
            F.count_if(~is_scorable()).alias("skipped"),
            *[F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COUNTS],
        )
    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, number: publish_totals(batch, number, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def publish_totals(batch: DataFrame, number: int, out: str) -> None:
    """Publish the totals after a micro-batch; a batch that is published already changes nothing."""
    spark = batch.sparkSession
    if current_version(spark, out) == str(number):
        return
    publish(spark, out, str(number), lambda folder: batch.write.mode("overwrite").parquet(folder))
    prune(spark, out)


def last_totals(spark: SparkSession, out: str) -> DataFrame:
    """The totals after the last micro-batch that was published."""
    version = current_version(spark, out)
    if version is None:
        raise FileNotFoundError(f"no totals published in {out}")
    return spark.read.parquet(version_folder(out, version))
