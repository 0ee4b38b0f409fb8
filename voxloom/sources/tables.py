"""Scans of submission tables, audio folders, evaluation splits and training logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions import parsing as P
from voxloom.functions.text import strip
from voxloom.sources.corpus import file_inventory, file_path

ROW_ORDER = "row_order"
LOG_FIELDS = [C.LOG_STEP, C.LOG_LOSS, C.LOG_WER, C.LOG_UER, C.LOG_LR]


def read_order() -> Column:
    """A sortable key that follows the order of rows in text files."""
    return F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    """Fail while the plan is built when a column is missing."""
    missing = [name for name in names if name not in df.columns]
    if missing:
        raise ValueError(f"missing required column(s) {missing}; found {df.columns}")
    return df


def read_submission(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """A CSV with ``ID`` and an optional ``Target``; absent or null targets become ''.

    Quoted line feeds belong to their field. Where there are none, ``multi_line=False``
    lets Spark split large files.
    """
    table = spark.read.csv(path, header=True, escape='"', multiLine=multi_line)
    require_columns(table, "ID")
    target = F.coalesce("Target", F.lit("")) if "Target" in table.columns else F.lit("")
    return table.withColumn("Target", target).withColumn(ROW_ORDER, read_order())


def read_audio_index(spark: SparkSession, folder: str) -> DataFrame:
    """(stem, path) of the .wav files directly inside ``folder``; first path per stem."""
    return first_path_per_stem(file_inventory(spark, folder, "*.wav", depth=0).select("path"))


def first_path_per_stem(paths: DataFrame) -> DataFrame:
    return paths.groupBy(P.stem(F.col("path"), "wav").alias("stem")).agg(F.min("path").alias("path"))


def evaluation_config(language: str) -> str:
    """The configuration read for a language when none is named."""
    return f"{language.lower().strip()}_asr"


def evaluation_split(
    df: DataFrame, language: str | None = None, config: str | None = None, split: str = "test"
) -> DataFrame:
    """Rows of one (config, split); both are literal filters, so partitions are pruned."""
    if config is None:
        if language is None:
            raise ValueError("name a language or a config")
        config = evaluation_config(language)
    return df.where((F.col("config") == config) & (F.col("split") == split))


def config_column(language: Column) -> Column:
    return F.concat(strip(F.lower(language)), F.lit("_asr"))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A JSON-lines training log as text fields with its line order.

    Malformed lines, and lines that are no object, are dropped. A missing path
    gives an empty table.
    """
    schema = ", ".join(f"`{name}` string" for name in LOG_FIELDS)
    try:
        log = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        empty = spark.createDataFrame([], schema)
        order = "struct<file: string, block: bigint, row: bigint>"
        return empty.select("*", F.lit(None).cast(order).alias("line_order"), F.lit("").alias("file"))
    return log.select("*", read_order().alias("line_order"), file_path().alias("file"))
