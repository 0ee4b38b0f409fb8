"""The corpus pipeline: five operators, each working on what the one before kept.

Each stage takes (session, documents, table directory) and returns a DataFrame, which
is written as Parquet and read again for the next. All but the last return the columns
of the documents.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

import voxloom
from voxloom.llm import bpe, chains, divergence, mixing, simhash
from voxloom.llm import catalog as Q
from voxloom.session import apply_settings, cut_lineage

# Functions of the package travel with the tasks, so workers need no install.
cloudpickle.register_pickle_by_value(voxloom)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep.

    Null and empty texts go, as texts of few words do; very long ones are judged whole. Null
    languages are a language of their own. Repeated rows are judged alike and all columns
    stay. An empty table stays empty.
    """
    apply_settings(spark)
    return divergence.keep(docs)


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic; the models are trained on a sample of the labelled documents.

    Null and empty texts are not toxic; very long ones are judged whole. Repeated rows are
    judged alike and all columns stay. Without labels of both kinds, and for an empty
    table, all rows stay.
    """
    apply_settings(spark)
    documents, labels = Q.table(spark, sf_dir, "documents"), Q.table(spark, sf_dir, "labels")
    return docs.where(~chains.toxic(docs, chains.fit(documents, labels, Q.CATEGORIES)))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that with the smallest id.

    Null and empty texts are one group; null ids are the largest. Of rows with one id and
    fingerprint one stays, with all its columns. An empty table stays empty.
    """
    apply_settings(spark)
    return simhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them.

    Null sources are a source of their own, the last; null and empty texts have no words.
    Rows of a source with one id are taken together. An empty table stays empty.
    """
    apply_settings(spark)
    return mixing.mixed_rows(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document's token ids and what they decode to, as digests.

    Null texts are empty ones, without tokens; very long ones are encoded whole. Repeated
    rows are encoded alike. An empty table stays empty.
    """
    apply_settings(spark)
    return Q.digests(bpe.round_trip(docs, "text", Q.tokenizer()))


STAGES = [
    ("quality", quality),
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("mixing", mix),
    ("bpe", tokens),
]

#: SQL has no models, random draws or tokenizers; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, with a table in the shared folder between two."""
    docs = Q.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
