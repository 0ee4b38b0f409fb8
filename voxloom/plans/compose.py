"""Compose one training corpus out of several sources."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import parsing as P
from voxloom.operators import labels as L
from voxloom.operators import manifest as M
from voxloom.operators.joins import RESERVED
from voxloom.operators.paths import count_replacements, path_lookup, replace_paths
from voxloom.operators.sanitize import KEEP, mark_usable
from voxloom.session import cut_lineage
from voxloom.sinks.published import current_version, publish
from voxloom.sinks.writers import refuse_overlap, write_corpus, write_manifest
from voxloom.sources import corpus as S

SOURCE = f"{RESERVED}source"
SPLIT = f"{RESERVED}split"


@dataclass
class Composition:
    """Marked rows of all sources, their path counts, every source file, manifest keys.

    All columns of the sources are kept but the in-file language, which gives way to the
    partition's, and ``source_split`` and ``source_file``, which a composed corpus gets.
    """

    rows: DataFrame
    counted: DataFrame
    files: DataFrame
    keys: list[str]

    def manifest(self) -> DataFrame:
        return M.composition_manifest(self.counted, self.files, self.keys)

    def corpus(self) -> DataFrame:
        """The rows to write; the source split and file stay as columns."""
        kept = self.rows.where(KEEP).withColumns({"source_split": F.col("split"), "split": F.col(SPLIT)})
        return kept.drop(KEEP, SPLIT)


def marked_source(
    spark: SparkSession,
    root: str,
    inventory: DataFrame,
    raw: bool = False,
    corpus: str | None = None,
    base: str | None = None,
) -> tuple[DataFrame, DataFrame]:
    """All rows of one source with ``KEEP`` and resolved paths, and their path counts.

    ``inventory`` lists the files below ``base``, the dataset's root (by default
    ``root``), against which paths are tried last. Usability is judged per file schema, before sources are aligned.
    """
    scans = S.read_by_schema(spark, root, raw, corpus, inventory=inventory)
    rows = S.union_all([mark_usable(scan.frame, present=scan.present).drop(S.SCHEMA) for scan in scans])
    if corpus is not None:
        rows = rows.where(F.col("corpus") == corpus)
    rows = rows.drop("lang", "source_split")
    lookup = path_lookup(rows, inventory, F.lit(plain_root(base or root)))
    counted = count_replacements(rows, lookup, [*S.PARTITION_KEYS, S.SOURCE_FILE, KEEP])
    return replace_paths(rows, lookup), counted.withColumn("source_language", F.col("language"))


def plain_root(root: str) -> str:
    """The root in the form that file paths have."""
    return root.rstrip("/").removeprefix("file://") or "/"


def compose_two(
    spark: SparkSession, first_root: str, first: str, second_root: str, second: str
) -> Composition:
    """Corpus ``first`` trains in full; corpus ``second`` also supplies validation.

    The second corpus takes over the language labels of the first.
    """
    rows, counted, files = [], [], []
    # A root that both corpora lie in is listed once.
    inventories = {root: S.file_inventory(spark, root) for root in dict.fromkeys((first_root, second_root))}
    sources = (("first", first_root, first), ("second", second_root, second))
    for role, root, name in sources:
        inventory = inventories[root]
        listed = S.partition_listing(inventory.where(F.endswith("path", F.lit(".parquet"))))
        listed = listed.where(F.col("corpus") == name)
        files.append(_named_files(listed, source=F.lit(role)))
    expected = L.two_corpus_splits(spark)
    present = S.union_all(files).select("source", "split").distinct()
    absent = M.missing_source_splits(present, expected).collect()
    if absent:
        raise FileNotFoundError(f"no partitions for {[(r.source, r.split) for r in absent]}")
    for role, root, name in sources:
        marked, numbers = marked_source(spark, root, inventories[root], corpus=name)
        rows.append(marked.withColumn(SOURCE, F.lit(role)))
        counted.append(numbers.withColumn("source", F.lit(role)))
    labels = L.label_lookup(files[0])
    both = [S.union_all([a, L.harmonize_language(b, labels)]) for a, b in (rows, counted, files)]
    narrow = [L.map_two_corpus_splits(g).withColumnRenamed("split", "source_split") for g in both[1:]]
    mapped = L.map_two_corpus_splits(both[0], SOURCE, SPLIT).drop(SOURCE)
    return Composition(mapped, *narrow, keys=M.MANIFEST_KEYS)


def compose_roots(spark: SparkSession, roots: list[str]) -> Composition:
    """Any number of partitioned roots; validation splits of any name stay apart."""
    rows, counted, files = [], [], []
    for root in roots:
        name = F.lit(plain_root(root).rsplit("/", 1)[-1])
        inventory = S.file_inventory(spark, root)
        listed = S.partition_listing(inventory.where(F.endswith("path", F.lit(".parquet"))))
        if not listed.limit(1).count():
            raise FileNotFoundError(f"no corpus/split/language partitions below {root}")
        files.append(_named_files(listed, source_dataset=name))
        marked, numbers = marked_source(spark, root, inventory)
        rows.append(marked)
        counted.append(numbers.withColumn("source_dataset", name))
    split, language = L.merged_split(F.col("split")), P.script_label(F.col("language"))
    narrow = [_relabel(S.union_all(group), split, language) for group in (counted, files)]
    marked = S.union_all(rows).withColumns({SPLIT: split, "language": language})
    return Composition(marked, *narrow, keys=["source_dataset", *M.MANIFEST_KEYS])


def compose_raw(spark: SparkSession, root: str) -> Composition:
    """Raw shards; the language label is the directory name."""
    # Audio may lie anywhere below the dataset's root; shards lie two levels below base.
    inventory = S.file_inventory(spark, root)
    base = S.raw_shard_root(spark, root, inventory)
    listed = S.shard_files(inventory, base)
    files = _named_files(listed.withColumn("corpus", F.lit("ASR")))
    marked, counted = marked_source(spark, base, inventory, raw=True, base=root)
    split = L.raw_split(F.col("split"))
    narrow = [_relabel(group, split, F.col("language")) for group in (counted, files)]
    return Composition(marked.withColumn(SPLIT, split), *narrow, keys=M.MANIFEST_KEYS)


def write_composition(composition: Composition, out: str, sources: list[str]) -> DataFrame:
    """Check the manifest, write the corpus, then the manifest beside it.

    The manifest is counted once and kept as a table; the gates and the sink
    read that.
    """
    manifest = _checked_manifest(composition, out, sources)
    _write(composition, manifest, out)
    return manifest


def publish_composition(
    composition: Composition, out: str, sources: list[str], version: str | None = None
) -> DataFrame:
    """As ``write_composition``, as a version of its own that readers of ``out`` see when it is whole.

    The manifest is written after the corpus, and the pointer after both. Running again
    under the same ``version`` replaces what a dead run left. ``published`` names the
    folder to read.
    """
    manifest = _checked_manifest(composition, out, sources)
    spark = composition.rows.sparkSession
    if version is not None and version == current_version(spark, out):
        raise ValueError(f"version {version} of {out} is being read; name another")
    publish(spark, out, version or uuid.uuid4().hex, lambda folder: _write(composition, manifest, folder))
    return manifest


def _checked_manifest(composition: Composition, out: str, sources: list[str]) -> DataFrame:
    refuse_overlap(out, sources)
    manifest = cut_lineage(composition.rows.sparkSession, composition.manifest(), "manifest")
    M.check_composition(manifest)
    return manifest


def _write(composition: Composition, manifest: DataFrame, folder: str) -> None:
    write_corpus(composition.corpus(), folder)
    write_manifest(manifest.orderBy(*composition.keys), folder)


def _named_files(listed: DataFrame, **columns: Column) -> DataFrame:
    named = listed.withColumn(S.SOURCE_FILE, F.col("path"))
    return named.withColumn("source_language", F.col("language")).withColumns(columns)


def _relabel(df: DataFrame, split: Column, language: Column) -> DataFrame:
    return df.withColumns({"destination_split": split, "language": language}).withColumnRenamed(
        "split", "source_split"
    )
