"""Hours and sampling settings of a corpus on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.operators import stats as H
from voxloom.plans.compose import plain_root
from voxloom.sinks.writers import write_distribution
from voxloom.sources import corpus as S

DISTRIBUTION_FOLDER = "_language_distribution"


def corpus_distribution(spark: SparkSession, root: str) -> DataFrame:
    """Hours per corpus, split and language in the distribution layout."""
    group_hours = H.hours(S.read_any_layout(spark, root))
    place = plain_root(root)
    return H.distribution(group_hours, place.rsplit("/", 1)[-1], place)


def save_distribution(spark: SparkSession, root: str) -> str:
    """Write the distribution below ``root`` where corpus scans skip it."""
    path = f"{root}/{DISTRIBUTION_FOLDER}"
    distribution = corpus_distribution(spark, root)
    if distribution.isEmpty():
        raise FileNotFoundError(f"no Parquet partition below {root}")
    write_distribution(distribution, path)
    return path


def sampling_settings(spark: SparkSession, root: str, model_name: str) -> DataFrame:
    """One row: group counts, exponents, validation split and length limits."""
    kind = "llm" if "llm" in model_name.lower() else "ctc"
    listed = S.partition_listing(S.file_inventory(spark, root, "*.parquet"))
    one = F.lit(1).alias("one")
    groups = H.train_groups(listed).select("*", one)
    split = H.valid_split(listed).select("*", one)
    return groups.join(split, "one").select(
        "corpora",
        "languages",
        "beta_corpus",
        "beta_language",
        "valid_split",
        F.lit(C.MIN_AUDIO_SAMPLES).alias("min_audio_len"),
        F.lit(C.MAX_AUDIO_SAMPLES[kind]).alias("max_audio_len"),
        F.lit(C.MAX_AUDIO_SAMPLES[kind]).alias("max_num_elements"),
    )
