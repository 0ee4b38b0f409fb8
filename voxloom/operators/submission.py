"""Fill a submission table by ID."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.text import strip
from voxloom.operators.joins import spread_nulls
from voxloom.session import within_bounds
from voxloom.sources.tables import ROW_ORDER

CLEAN_ID = "sample_id"


def with_clean_id(table: DataFrame) -> DataFrame:
    """Add the stripped ID; blank IDs become null."""
    stripped = strip(F.col("ID").cast("string"))
    return table.withColumn(CLEAN_ID, F.nullif(stripped, F.lit("")))


def unique_ids(table: DataFrame) -> DataFrame:
    """Each non-blank ID once, with the order of its first row."""
    named = with_clean_id(table).where(F.col(CLEAN_ID).isNotNull())
    return named.groupBy(CLEAN_ID).agg(F.min(ROW_ORDER).alias("first_row"))


def match_audio(ids: DataFrame, index: DataFrame) -> DataFrame:
    """IDs with the path of their audio, null where there is none."""
    return ids.join(index, F.col(CLEAN_ID) == F.col("stem"), "left").drop("stem")


def missing_ids(ids: DataFrame, index: DataFrame) -> DataFrame:
    return ids.join(index, F.col(CLEAN_ID) == F.col("stem"), "left_anti")


def fill_targets(table: DataFrame, predictions: DataFrame) -> DataFrame:
    """Write the prediction of an ID to all of its rows; others keep their target.

    ``predictions`` is a written table with one row per ``sample_id``; it is
    measured before the join. ``filled`` tells which rows changed.
    """
    keyed = with_clean_id(table)
    keyed = keyed.withColumn(CLEAN_ID, spread_nulls(F.col(CLEAN_ID), ROW_ORDER))
    usable = predictions.where(F.col("prediction").isNotNull()).select(CLEAN_ID, "prediction")
    joined = keyed.join(F.broadcast(usable) if within_bounds(usable) else usable, CLEAN_ID, "left")
    return joined.withColumns(
        {
            "Target": F.coalesce("prediction", "Target"),
            "filled": F.col("prediction").isNotNull(),
        }
    ).drop(CLEAN_ID, "prediction")


def fill_report(filled: DataFrame, matched: DataFrame) -> DataFrame:
    """Rows filled and rows in all; unique IDs, those without audio and undecodable ones.

    ``matched`` has one row per unique ID with ``path`` and ``decoded``.
    """
    rows = filled.agg(
        F.count_if("filled").alias("filled_rows"), F.count(F.lit(1)).alias("total_rows")
    )
    ids = matched.agg(
        F.count(F.lit(1)).alias("unique_ids"),
        F.count_if(F.col("path").isNull()).alias("missing_ids"),
        F.count_if(F.col("path").isNotNull() & ~F.coalesce("decoded", F.lit(False))).alias(
            "decode_skips"
        ),
    )
    one = F.lit(1).alias("one")
    return rows.select("*", one).join(ids.select("*", one), "one").drop("one")
