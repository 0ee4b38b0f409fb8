"""Near-duplicate embeddings by an index of pivot permutations.

A vector is described by its ``prefix``: the reference points (pivots) nearest to it,
in order. Each pivot has an inverted list of the vectors that name it. Vectors that
share enough pivots are candidates, found list by list, and are verified by cosine in
double precision. Lists of any length are compared in units of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.blocks import by_unit, dealt, units
from voxloom.llm.common import checked
from voxloom.llm.components import connected_components
from voxloom.session import cut_lineage

MIN_COSINE = 0.95
#: Pivots of a vector's prefix, and how many of them candidates share.
PREFIX = 8
SHARED = 2
#: Vectors that pivots are chosen from, and the cosine that two pivots stay below.
SAMPLE = 8192
MAX_PIVOT_COSINE = 0.7
#: Vectors of one list that a unit takes from each of two chunks.
CHUNK = 2048
#: Rows of a unit compared with all others at once.
ROWS = 256


def unit_vectors(rows: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision."""
    rows = rows.astype(np.float64)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def matrix(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length as the rows of a matrix."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def usable(vector: Column) -> Column:
    """Whether a vector has a direction: no null, NaN or infinity, and not all zero."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def choose_pivots(sample: list[np.ndarray], wanted: int) -> dict[int, tuple[int, np.ndarray]]:
    """Pivots for each length of vectors: the number of the first, and their rows.

    Pivots are taken in the sample's order, each unless it is close to one before, so
    that a dense group of vectors does not take most of them.
    """
    found, number = {}, 0
    for length in sorted({len(v) for v in sample}):
        rows = unit_vectors(np.array([v for v in sample if len(v) == length]))
        open_rows, chosen = np.ones(len(rows), dtype=bool), []
        for i in range(len(rows)):
            if open_rows[i]:
                chosen.append(i)
                open_rows &= rows @ rows[i] < MAX_PIVOT_COSINE
                if len(chosen) == wanted:
                    break
        found[length] = (number, rows[chosen])
        number += len(chosen)
    return found


def prefix_column(vector: Column, pivots: dict[int, tuple[int, np.ndarray]], size: int) -> Column:
    """Numbers of the nearest pivots, nearest first."""

    def apply(vectors: pa.Array) -> pa.Array:
        prefixes: list = [None] * len(vectors)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            if length not in pivots:  # a length so rare that the sample has none
                for i in at:
                    prefixes[i] = [-int(length)]
                continue
            first, rows = pivots[length]
            near = unit_vectors(matrix(vectors.take(pa.array(at)))) @ rows.T
            order = np.argsort(-near, axis=1, kind="stable")[:, :size] + first
            for i, row in zip(at, order.tolist(), strict=True):
                prefixes[i] = row
        return pa.array(prefixes, type=pa.list_(pa.int32()))

    apply.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "array<int>")(vector)


def linked(prefixes: np.ndarray, rows: np.ndarray, pivot: int, shared: int, min_cosine: float) -> np.ndarray:
    """Links among the rows of a list, as a matrix of booleans.

    A pair of vectors is in the list of every pivot they share; it counts in the list
    of the least of these alone.
    """
    names, local = np.unique(prefixes, return_inverse=True)
    member = np.zeros((len(rows), len(names)), dtype=np.float32)
    np.put_along_axis(member, local.reshape(prefixes.shape), 1, axis=1)
    lesser = member[:, names < pivot]
    found = np.zeros((len(rows), len(rows)), dtype=bool)
    for at in range(0, len(rows), ROWS):
        part = slice(at, at + ROWS)
        candidates = member[part] @ member.T >= shared
        if lesser.shape[1]:
            candidates &= lesser[part] @ lesser.T == 0
        if candidates.any():
            found[part] = candidates & (rows[part] @ rows.T >= min_cosine)
    np.fill_diagonal(found, False)
    return found


def stars(found: np.ndarray) -> list[tuple[int, int]]:
    """Links (root, member) that join what the matrix joins."""
    rest = found.any(axis=1)
    pairs = []
    while rest.any():
        root = int(np.argmax(rest))
        rest[root] = False
        front = np.array([root])
        while len(front):
            front = np.flatnonzero(found[front].any(axis=0) & rest)
            rest[front] = False
            pairs += [(root, int(i)) for i in front]
    return pairs


_FOUND = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.int64())])


def compared(table: pa.Table, shared: int, min_cosine: float) -> Iterator[pa.RecordBatch]:
    """For the units of a table, links (a, b) that join, and the links that each ``a`` has."""
    keys, i, j = (np.asarray(table.column(c)) for c in ("_llm_key", "_llm_i", "_llm_j"))
    own, number, copies = (np.asarray(table.column(c)) for c in ("_llm_own", "number", "copies"))
    vectors, prefixes = table.column("vector"), table.column("prefix")
    a, b, links = [], [], []
    for s, e in units(table):
        p = matrix(prefixes.slice(s, e - s))
        need = 1 if keys[s] < 0 else min(shared, p.shape[1])
        found = linked(p, unit_vectors(matrix(vectors.slice(s, e - s))), keys[s], need, min_cosine)
        if i[s] < j[s]:
            # Pairs within a chunk count in one of its units: chunk 0 in (0, 1), others with 0.
            mine = own[s:e]
            for chunk, counts in ((i[s], i[s] == 0 and j[s] == 1), (j[s], i[s] == 0)):
                if not counts:
                    at = np.flatnonzero(mine == chunk)
                    found[np.ix_(at, at)] = False
        n = number[s:e]
        total = found @ copies[s:e]
        for k in np.flatnonzero(total):
            a.append(n[k])
            b.append(None)
            links.append(total[k])
        for root, member in stars(found):
            a.append(n[root])
            b.append(n[member])
            links.append(0)
    if a:
        yield pa.RecordBatch.from_arrays([pa.array(x, type=pa.int64()) for x in (a, b, links)], schema=_FOUND)


def near_duplicates(df: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding",
                    min_cosine: float = MIN_COSINE, prefix: int = PREFIX, shared: int = SHARED,
                    sample: int = SAMPLE, chunk: int = CHUNK) -> DataFrame:
    """``id_column``, ``n_links``, ``component_id`` and ``kept`` for each row.

    Links are pairs of rows with cosine ``min_cosine`` or more. Equal vectors are one
    class, which enters the index once and counts as often as it has rows. Vectors that
    are null or empty, have a null or non-finite component, or are all zero link with
    nothing; nor do vectors of different lengths. Null ids are the largest. Repeated
    rows are rows of their own; an empty table stays empty.

    Pivots come from at most ``sample`` classes, chosen by hash; there are about as many
    as the root of the number of classes. All vectors are indexed.
    """
    checked(df, id_column, vector_column)
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector"))
    rows = rows.withColumn("usable", usable(F.col("vector")))
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id")).alias("first")
    classes = rows.where("usable").groupBy("vector").agg(first, F.count(F.lit(1)).alias("copies"))
    classes = cut_lineage(spark, classes.withColumn("number", F.monotonically_increasing_id()), "classes")
    count = classes.count()
    if not count:
        return rows.select(F.col("id").alias(id_column), F.lit(0).cast("long").alias("n_links"),
                           F.col("id").alias("component_id"), F.lit(True).alias("kept"))
    chosen = classes.orderBy(F.xxhash64("vector"), "number").limit(sample).select("vector").collect()
    pivots = choose_pivots([np.array(r.vector) for r in chosen], max(prefix, int(np.ceil(np.sqrt(count)))))

    described = classes.select(
        "number", "copies", "vector", prefix_column(F.col("vector"), pivots, prefix).alias("prefix")
    )
    described = cut_lineage(spark, described, "prefixes")
    listed = described.withColumn("pivot", F.explode("prefix"))
    listed = dealt(listed, F.col("pivot").cast("long"), F.xxhash64("number"), chunk)
    listed = listed.select("number", "copies", "vector", "prefix", "_llm_own", "_llm_key", "_llm_i", "_llm_j")
    found = by_unit(
        listed, lambda t: compared(t, shared, min_cosine), "a long, b long, links long", "number"
    )
    found = cut_lineage(spark, found, "found")
    links = found.where("b is null").groupBy(F.col("a").alias("number")).agg(F.sum("links").alias("links"))
    nodes = connected_components(found.where("b is not null").select("a", "b"))
    nodes = cut_lineage(spark, nodes.withColumnRenamed("node", "number"), "components")
    known = classes.select("number", "first", "copies").join(nodes, "number", "left")
    known = known.withColumn("component", F.coalesce("component", "number"))
    known = cut_lineage(spark, known, "known")
    least = cut_lineage(spark, known.groupBy("component").agg(F.min("first").alias("least")), "least")
    known = known.join(least, "component").join(cut_lineage(spark, links, "links"), "number", "left")
    known = known.select(
        "number", F.col("least.id").alias("component_id"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    labels = known.join(classes.select("number", "vector"), "number").drop("number")
    labels = cut_lineage(spark, labels, "labels")
    joined = rows.where("usable").join(labels, "vector").select("id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select(
        "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")
    )
    return joined.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
