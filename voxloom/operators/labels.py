"""Split and language labels of the combined corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions.parsing import language_base
from voxloom.operators.joins import RESERVED
from voxloom.session import as_lookup


def two_corpus_splits(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        C.TWO_CORPUS_SPLITS, "source string, split string, destination_split string"
    )


def map_two_corpus_splits(
    df: DataFrame, source: str = "source", name: str = "destination_split"
) -> DataFrame:
    """Add ``name``, the split to write to, by source and split; others are left out."""
    splits = two_corpus_splits(df.sparkSession).select(
        F.col("source").alias(source), "split", F.col("destination_split").alias(name)
    )
    return df.join(F.broadcast(splits), [source, "split"])


def merged_split(split: Column) -> Column:
    """Any validation split is validation, all else training."""
    return F.when(split.isin(C.VALIDATION_SPLITS), "validation").otherwise("train")


def raw_split(split: Column) -> Column:
    """Only the split called validation stays apart."""
    return F.when(split == "validation", "validation").otherwise("train")


def label_by_base(labels: DataFrame) -> DataFrame:
    """One label per language base; the smallest wins, so the choice is repeatable."""
    return labels.groupBy(language_base(F.col("language")).alias("base")).agg(
        F.min("language").alias("label")
    )


def label_lookup(labels: DataFrame) -> DataFrame:
    """(base, label) of the ``language`` values in use, ready to join."""
    return as_lookup(label_by_base(labels.select("language").distinct()))


def harmonize_language(df: DataFrame, lookup: DataFrame, name: str = "language") -> DataFrame:
    """Give ``df`` the labels that another corpus uses for the same language base.

    ``lookup`` comes from ``label_lookup``. Unmatched languages keep their own label.
    """
    base, label = f"{RESERVED}base", f"{RESERVED}label"
    joined = df.withColumn(base, language_base(F.col(name))).join(
        lookup.select(F.col("base").alias(base), F.col("label").alias(label)), base, "left"
    )
    return joined.withColumn(name, F.coalesce(label, name)).drop(base, label)


def companion_corpus(df: DataFrame, pairs: DataFrame) -> DataFrame:
    """Add the ``companion`` that ``pairs`` lists for each ``corpus``; fail on others."""
    pairs = as_lookup(pairs)
    unknown = df.select("corpus").distinct().join(pairs, "corpus", "left_anti").take(5)
    if unknown:
        raise ValueError(f"no companion corpus for {[row.corpus for row in unknown]}")
    return df.join(pairs, "corpus")
