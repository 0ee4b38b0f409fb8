"""Connected components of a graph that is given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.session import cut_lineage


def _signature(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def _toward_least(edges: DataFrame, name: str) -> DataFrame:
    """Every link (u, v), with the least of u and all its v's as ``m``.

    The minima combine before the shuffle and are written, so the join has a plain
    table on each side and Spark splits the links of a hub over tasks.
    """
    spark = edges.sparkSession
    least = edges.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return edges.join(cut_lineage(spark, least, name), "u")


def connected_components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Component of each node that has a link.

    ``edges`` has columns ``a`` and ``b`` (long, not null); direction, repeats and
    links of a node to itself do not matter. Returns ``node`` and ``component``, the
    least node of the component. An empty table gives an empty table.

    Alternates large and small stars: every node points its larger neighbours, then
    its smaller ones, to the least node it sees. Links never outnumber the first
    round's, and each round is a table in the shared folder, so lost executors cost
    one round at most.
    """
    spark = edges.sparkSession
    ordered = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = cut_lineage(spark, ordered.where("u != v").distinct(), "links")
    before = _signature(now)
    for _ in range(max_rounds if before[0] else 0):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _toward_least(both, "least").where("v > u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = cut_lineage(spark, large.distinct(), "links")
        small = _toward_least(large, "least")
        small = small.select(
            F.explode(
                F.array(
                    F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                    F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
                )
            ).alias("e")
        )
        small = small.select("e.u", "e.v").where("u != v")
        now = cut_lineage(spark, small.distinct(), "links")
        after = _signature(now)
        if after == before:
            break
        before = after
    else:
        if before[0]:
            raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
