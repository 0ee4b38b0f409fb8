"""Resolve relative audio paths against the files that exist."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom import constants as C
from voxloom.functions import parsing as P
from voxloom.operators.joins import RESERVED, plain_columns, spread_nulls
from voxloom.session import as_lookup, cut_lineage, within_bounds
from voxloom.sources.corpus import SOURCE_FILE, union_all

RESOLVED = "resolved_paths"
FOUND = f"{RESERVED}found_path"


def base_folders(folder: Column, root: Column) -> Column:
    """The folders a relative path is tried against, best first."""
    first = P.parent(folder)
    second = P.parent(first)
    return F.array(folder, first, second, P.parent(second), root)


def resolve_keys(keys: DataFrame, inventory: DataFrame) -> DataFrame:
    """(folder, relative, resolved, rank) for each distinct key that has an existing file.

    ``keys`` has folder, relative and root; ``inventory`` has path.
    """
    candidates = (
        keys.select("folder", "relative", "root")
        .distinct()
        .select(
            "folder",
            "relative",
            F.posexplode(base_folders(F.col("folder"), F.col("root"))).alias("rank", "base"),
        )
        .select("folder", "relative", "rank", P.join_path(F.col("base"), F.col("relative")).alias("path"))
    )
    return (
        candidates.join(inventory.select("path"), "path", "left_semi")
        .groupBy("folder", "relative")
        .agg(F.min(F.struct("rank", "path")).alias("best"))
        .select("folder", "relative", F.col("best.path").alias("resolved"), F.col("best.rank").alias("rank"))
    )


@dataclass
class PathLookup:
    """The resolved keys of a table, and how to join them."""

    keys: DataFrame
    columns: list[str]
    small: bool
    root: Column | None = None
    tried: DataFrame | None = None

    def folder_ranks(self) -> DataFrame:
        """Per folder, the one rank at which all its paths exist, or -1."""
        at = self.keys.select("folder", "relative", "rank")
        all_keys = self.tried.select("folder", "relative").distinct().join(at, ["folder", "relative"], "left")
        one = (F.min("rank") == F.max("rank")) & (F.count("rank") == F.count(F.lit(1)))
        ranks = all_keys.groupBy("folder").agg(F.when(one, F.min("rank")).otherwise(-1).alias("rank"))
        return cut_lineage(self.keys.sparkSession, ranks, "path-folders")

    def attach(self, df: DataFrame, path: Column, name: str) -> DataFrame:
        """Add the resolved path of each row as ``name``, null where there is none."""
        # Rows without a relative path have no match; in a shuffle they are spread
        # over keys that cannot match instead of meeting in one task.
        key = F.when(P.is_resolvable(path), path)
        if not self.small:
            key = spread_nulls(key, *plain_columns(df))
        folder, relative = f"{RESERVED}folder", f"{RESERVED}relative"
        keyed = df.withColumns({folder: P.parent(F.col(SOURCE_FILE)), relative: key})
        side = self.keys.select(
            F.col("folder").alias(folder), F.col("relative").alias(relative), F.col("resolved").alias(name)
        )
        side = F.broadcast(side) if self.small else side
        return keyed.join(side, [folder, relative], "left").drop(folder, relative)


def path_lookup(df: DataFrame, inventory: DataFrame, root: Column) -> PathLookup:
    """Resolve the distinct relative paths of ``df``; reads paths, never audio bytes."""
    columns = [name for name in C.AUDIO_COLUMNS if _has_path(df, name)]
    if not columns:
        return PathLookup(df, [], True)
    keys = union_all(
        [
            df.where(P.is_resolvable(F.col(name)["path"])).select(
                P.parent(F.col(SOURCE_FILE)).alias("folder"),
                F.col(name)["path"].alias("relative"),
                root.alias("root"),
            )
            for name in columns
        ]
    )
    resolved = cut_lineage(df.sparkSession, resolve_keys(keys, inventory), "resolved-paths")
    if resolved.isEmpty():
        columns = []
    return PathLookup(resolved, columns, within_bounds(resolved), root, keys)


def replace_paths(df: DataFrame, lookup: PathLookup) -> DataFrame:
    """Put resolved paths in; null, blank, absolute and unmatched paths stay."""
    if lookup.small:
        return _replaced_by_join(df, lookup)
    return df if not lookup.columns else _replaced_by_folder(df, lookup)


def _replaced_by_join(df: DataFrame, lookup: PathLookup) -> DataFrame:
    for name in lookup.columns:
        df = lookup.attach(df, F.col(name)["path"], FOUND)
        df = _with_found(df, name).drop(FOUND)
    return df


def _with_found(df: DataFrame, name: str) -> DataFrame:
    found = F.col(FOUND)
    updated = F.when(found.isNotNull(), F.col(name).withField("path", found))
    return df.withColumn(name, updated.otherwise(F.col(name)))


def _replaced_by_folder(df: DataFrame, lookup: PathLookup) -> DataFrame:
    """As ``replace_paths`` with more keys than can be broadcast, without moving audio.

    Nearly always all paths of a folder exist at one base, so a row per folder says
    where, and paths are put together by expression. Only rows of the other folders
    are joined with the keys.
    """
    folder, rank = f"{RESERVED}at", f"{RESERVED}rank"
    ranks = lookup.folder_ranks().select(F.col("folder").alias(folder), F.col("rank").alias(rank))
    ranks = as_lookup(ranks, "path-folders")
    df = df.withColumn(folder, P.parent(F.col(SOURCE_FILE))).join(ranks, folder, "left")
    mixed = F.coalesce(F.col(rank) < 0, F.lit(False))
    same = df.where(~mixed)
    for name in lookup.columns:
        given = F.col(name)["path"]
        base = F.get(base_folders(F.col(folder), lookup.root), F.col(rank))
        found = F.when(P.is_resolvable(given), P.join_path(base, given))
        same = _with_found(same.withColumn(FOUND, found), name).drop(FOUND)
    apart = _replaced_by_join(df.where(mixed), lookup)
    return same.unionByName(apart).drop(folder, rank)


def count_replacements(df: DataFrame, lookup: PathLookup, columns: list[str]) -> DataFrame:
    """The given columns with the number of paths ``replace_paths`` changes in each row.

    Paths are taken out of their structs first, so no audio bytes are read.
    """
    paths = [F.col(name)["path"].alias(f"{RESERVED}{name}_path") for name in lookup.columns]
    counted = df.select(*columns, *paths).withColumn(RESOLVED, F.lit(0).cast("long"))
    for name in lookup.columns:
        counted = lookup.attach(counted, F.col(f"{RESERVED}{name}_path"), FOUND)
        changed = F.col(FOUND).isNotNull().cast("long")
        counted = counted.withColumn(RESOLVED, F.col(RESOLVED) + changed).drop(FOUND)
    return counted.select(*columns, RESOLVED)


def _has_path(df: DataFrame, name: str) -> bool:
    if name not in df.columns:
        return False
    kind = df.schema[name].dataType
    return isinstance(kind, T.StructType) and "path" in kind.names
