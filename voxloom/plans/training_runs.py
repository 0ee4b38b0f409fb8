"""Choose and report the best checkpoint of the runs below a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import checkpoints as K
from voxloom.operators import report as R
from voxloom.sinks.writers import write_lines
from voxloom.sources import corpus as S
from voxloom.sources import tables as D


def read_run_log(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``root/ws_*/metrics/<name>.jsonl`` of all runs."""
    log = D.read_log(spark, f"{root}/ws_*/metrics/{name}.jsonl")
    return log.withColumn("run", K.run_of(F.col("file"))).drop("file")


def select_checkpoints(spark: SparkSession, root: str, strict: bool = True) -> DataFrame:
    """The best checkpoint of each run; ``strict`` accepts exactly one run folder."""
    weights = S.file_inventory(spark, root, "*.pt")
    saved = K.require_checkpoints(K.checkpoint_inventory(weights))
    if strict:
        folders = S.file_inventory(spark, root).select(K.run_of(F.col("path")).alias("run"))
        K.require_single_run(folders.where("run <> ''"))
    valid, train = (K.parsed_log(read_run_log(spark, root, name)) for name in ("valid", "train"))
    places = saved.groupBy("run", "step").agg(F.min("path").alias("path"))
    best = K.best_checkpoint(valid, train, saved).drop("path")
    return best.join(places, K.RUN_STEP)


def save_report(spark: SparkSession, root: str, out: str, strict: bool = True) -> DataFrame:
    """Write the Markdown report of the chosen checkpoints; returns the choice."""
    best = select_checkpoints(spark, root, strict)
    valid, train = (read_run_log(spark, root, name) for name in ("valid", "train"))
    write_lines(R.full_report(best, valid, train), out, R.REPORT_ORDER)
    return best
