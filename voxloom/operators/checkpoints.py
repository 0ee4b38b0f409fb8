"""Choose the best checkpoint of each training run from its logs.

Logs have run, line_order and the text fields of ``read_log``; the checkpoint
inventory has run and step. Every operator works on many runs at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions import parsing as P
from voxloom.session import as_lookup

RUN_STEP = ["run", "step"]


def parsed_log(log: DataFrame) -> DataFrame:
    """Rows with a readable step and loss."""
    return log.select(
        "run",
        "line_order",
        P.lenient_long(F.col(f"`{C.LOG_STEP}`")).alias("step"),
        P.lenient_double(F.col(f"`{C.LOG_LOSS}`")).alias("loss"),
        F.col(f"`{C.LOG_WER}`").alias("wer"),
        F.col(f"`{C.LOG_UER}`").alias("uer"),
    ).where(F.col("step").isNotNull() & F.col("loss").isNotNull())


def checkpoint_inventory(files: DataFrame) -> DataFrame:
    """(run, step, path) of the checkpoints below ``ws_*`` whose weight file exists."""
    found = rf"^(.*/(ws_[^/]*)/checkpoints/step_([^/]*))/{C.CHECKPOINT_WEIGHTS}$"
    path = F.col("path")
    return files.where(path.rlike(found)).select(
        F.regexp_extract(path, found, 2).alias("run"),
        F.regexp_extract(path, found, 3).try_cast("bigint").alias("step"),
        F.regexp_extract(path, found, 1).alias("path"),
    ).dropna(subset=["step"])


def checkpoint_steps(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.select(*RUN_STEP).distinct()


def with_checkpoint(parsed: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Log rows whose step has a checkpoint."""
    return parsed.join(as_lookup(checkpoint_steps(checkpoints)), RUN_STEP, "left_semi")


def last_loss(parsed: DataFrame) -> DataFrame:
    """The last loss that each step logged."""
    return parsed.groupBy(*RUN_STEP).agg(F.max_by("loss", "line_order").alias("train_loss"))


def steps_with_loss(checkpoints: DataFrame, train: DataFrame) -> DataFrame:
    """Checkpoint steps with their train loss, null where none was logged."""
    return checkpoint_steps(checkpoints).join(last_loss(train), RUN_STEP, "left")


def best_checkpoint(valid: DataFrame, train: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """One row per run with checkpoints.

    The smallest validation loss wins, then the smallest train loss, then the
    latest step. Ties go to the earlier line or step, and NaN loses to any number.
    """
    first = F.struct("loss", "line_order", "step", "wer", "uer")
    by_valid = (
        with_checkpoint(valid, checkpoints).groupBy("run").agg(F.min(first).alias("valid"))
    )
    trained = F.when(F.col("train_loss").isNotNull(), F.struct("train_loss", "step"))
    by_train = (
        steps_with_loss(checkpoints, train)
        .groupBy("run")
        .agg(F.min(trained).alias("train"), F.max("step").alias("latest"))
    )
    has_valid, has_train = F.col("valid").isNotNull(), F.col("train").isNotNull()
    step = F.coalesce(F.col("valid.step"), F.col("train.step"), F.col("latest"))
    return by_train.join(by_valid, "run", "left").select(
        "run",
        step.alias("step"),
        F.col("valid.loss").alias("eval_loss"),
        F.when(~has_valid, F.col("train.train_loss")).alias("train_loss"),
        F.col("valid.wer").alias("wer"),
        F.col("valid.uer").alias("uer"),
        F.concat(F.lit("step_"), step).alias("path"),
        F.when(has_valid, "validation_ctc_loss")
        .when(has_train, "train_ctc_loss")
        .otherwise("latest_step")
        .alias("selection_source"),
    )


def require_checkpoints(checkpoints: DataFrame) -> DataFrame:
    if not checkpoints.limit(1).count():
        raise RuntimeError("no checkpoint with model weights was found")
    return checkpoints


def require_single_run(df: DataFrame) -> DataFrame:
    """Strict mode: fail unless exactly one run is present."""
    runs = [row.run for row in df.select("run").distinct().take(3)]
    if len(runs) != 1:
        raise RuntimeError(f"expected exactly one run, found {sorted(runs) or 'none'}")
    return df


def run_of(path: Column) -> Column:
    """The ``ws_*`` directory name in a path."""
    return F.regexp_extract(path, r"(?:^|/)(ws_[^/]*)/", 1)
