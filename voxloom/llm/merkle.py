"""A Merkle manifest of a table, with a witness for every row.

Rows are leaves of one tree per group, and the trees' roots are leaves of one tree
more. Nodes are appended in order; runs of ``ARITY`` have one parent. An append gives
the new node what stands left of it in its run, as the first part of its witness, and
extends the witnesses of the nodes before it, for the run's open subtrees. So a witness
is whole as soon as the last sibling of each ancestor has come.

A tree's leaves are dealt into aligned blocks of ``HEIGHT`` levels: the root of a block
is a node of the tree. Tasks append block by block, and the roots of
blocks are appends of the next round, which has a row per block. Witnesses of block roots
go back to the blocks, whose leaves' witnesses they extend.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voxloom.llm.blocks import _starts, by_unit
from voxloom.llm.common import checked
from voxloom.session import as_lookup, cut_lineage

ARITY = 16
#: Levels of a block, which so has 4,096 leaves.
HEIGHT = 3

STEPS = "array<struct<left: string, right: string>>"


def leaf(*columns: Column) -> Column:
    """Digest of values, each as its UTF-8 length, a colon and itself; nulls are a hyphen."""
    parts = [c.cast("string") for c in columns]
    parts = [F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in parts]
    return F.sha2(F.concat(*parts), 256)


def fold(start: Column, steps: Column) -> Column:
    """The root that a leaf's digest and its witness give."""
    return F.aggregate(steps, start, lambda d, s: F.sha2(F.concat(s["left"], d, s["right"]), 256))


def siblings(steps: Column) -> Column:
    """All digests of a witness in one text, level by level, left to right."""
    return F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), "")


class Subtree:
    """A node and the part of its witness that the siblings so far make up."""

    __slots__ = ("digest", "left", "right", "parent")

    def __init__(self, digest: str):
        self.digest = digest
        self.left = ""
        self.right: list[str] | str = []
        self.parent: Subtree | None = None

    def witness(self) -> Iterator[tuple[str, str]]:
        node = self
        while node.parent is not None:
            if not isinstance(node.right, str):
                node.right = "".join(node.right)
            yield node.left, node.right
            node = node.parent


class Block:
    """An aligned part of a tree, of ``height`` levels above its leaves."""

    def __init__(self, height: int, arity: int = ARITY):
        self.height, self.arity = height, arity
        self.open: list[list[Subtree]] = [[] for _ in range(height + 1)]

    def append(self, node: Subtree, level: int = 0) -> None:
        run = self.open[level]
        node.left = "".join([x.digest for x in run])
        for x in run:
            x.right.append(node.digest)
        run.append(node)
        if len(run) == self.arity and level < self.height:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        parent = Subtree(hashlib.sha256("".join([x.digest for x in run]).encode()).hexdigest())
        for x in run:
            x.parent = parent
        self.append(parent, level + 1)

    def root(self) -> Subtree:
        """Close what is open; no more nodes come."""
        for level in range(self.height):
            if self.open[level]:
                self._close(level)
        return self.open[self.height][0]


def height_of(n: int, most: int) -> int:
    """Levels of a block in a tree of ``n`` nodes: until one remains, or whole."""
    height = 0
    while n > 1 and height < most:
        n, height = -(-n // ARITY), height + 1
    return height


def _appended(table: pa.Table, start: int, end: int, height: int) -> tuple[list[Subtree], Subtree]:
    nodes = [Subtree(d) for d in table.column("digest").slice(start, end - start).to_pylist()]
    block = Block(height_of(table.column("n")[start].as_py(), height))
    for node in nodes:
        block.append(node)
    return nodes, block.root()


def _in_blocks(nodes: DataFrame, height: int) -> DataFrame:
    block = F.expr(f"pos div {ARITY**height}")
    return nodes.withColumns({"_llm_key": F.col("tree"), "_llm_i": block, "_llm_j": F.lit(0).cast("long")})


_ROOTS = "tree long, pos long, n long, digest string"


def _block_roots(nodes: DataFrame, height: int) -> DataFrame:
    """The roots of the nodes' blocks, as nodes of the next round."""

    def apply(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at = _starts(table).tolist()
        rows = []
        for s, e in zip(at[:-1], at[1:], strict=True):
            tree, block, n = (table.column(c)[s].as_py() for c in ("_llm_key", "_llm_i", "n"))
            rows.append((tree, block, -(-n // ARITY**height), _appended(table, s, e, height)[1].digest))
        names = ["tree", "pos", "n", "digest"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        arrays = [pa.array([r[i] for r in rows], type=k) for i, k in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays(arrays, names=names)

    return by_unit(_in_blocks(nodes.select("tree", "pos", "n", "digest"), height), apply, _ROOTS, "pos")


_ARROW_STEP = pa.struct([("left", pa.string()), ("right", pa.string())])


def _steps(witnesses: list[list[tuple[str, str]]]) -> pa.Array:
    left = [step[0] for w in witnesses for step in w]
    right = [step[1] for w in witnesses for step in w]
    offsets = [0]
    for w in witnesses:
        offsets.append(offsets[-1] + len(w))
    steps = pa.StructArray.from_arrays(
        [pa.array(left, type=pa.string()), pa.array(right, type=pa.string())], fields=list(_ARROW_STEP)
    )
    return pa.ListArray.from_arrays(pa.array(offsets, type=pa.int32()), steps)


def _witnessed(nodes: DataFrame, above: DataFrame, height: int) -> DataFrame:
    """Nodes with ``steps`` up to the last root, ``subroot`` and ``root``.

    ``above`` has what holds for the root of each block (tree, pos): steps from there
    on, subroot and root. Its row goes before the block's nodes.
    """
    names = nodes.columns
    header = above.select(
        F.col("tree").alias("_llm_key"), F.col("pos").alias("_llm_i"), F.lit(0).cast("long").alias("_llm_j"),
        F.lit(-1).cast("long").alias("pos"), "steps", "subroot", "root",
    )
    rows = _in_blocks(nodes, height).unionByName(header, allowMissingColumns=True)

    def apply(table: pa.Table) -> Iterator[pa.RecordBatch]:
        at = _starts(table).tolist()
        for s, e in zip(at[:-1], at[1:], strict=True):
            subroot, root = (table.column(c)[s].as_py() for c in ("subroot", "root"))
            upper = [(x["left"], x["right"]) for x in table.column("steps")[s].as_py()]
            found = _appended(table, s + 1, e, height)[0]
            for begin in range(0, len(found), 512):
                part = found[begin : begin + 512]
                steps = _steps([[*x.witness(), *upper] for x in part])
                # A copy, as slices of an Arrow table keep the offsets of the whole.
                own = table.select(names).slice(s + 1 + begin, len(part)).combine_chunks().to_batches()[0]
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, steps, pa.array([subroot] * len(part), type=pa.string()),
                     pa.array([root] * len(part), type=pa.string())],
                    names=[*names, "steps", "subroot", "root"],
                )

    schema = T.StructType([*nodes.schema.fields, T.StructField("steps", above.schema["steps"].dataType),
                           T.StructField("subroot", T.StringType()), T.StructField("root", T.StringType())])
    return by_unit(rows, apply, schema, "pos")


def _grown(nodes: DataFrame, height: int) -> tuple[list[DataFrame], DataFrame]:
    """Rounds of block roots above the nodes, and the root of each tree (tree, digest)."""
    spark = nodes.sparkSession
    rounds, last, subroots = [], nodes, None
    while True:
        last = cut_lineage(spark, _block_roots(last, height), "block_roots")
        rounds.append(last)
        done = last.where("n = 1").select("tree", "digest")
        subroots = done if subroots is None else subroots.unionByName(done)
        last = last.where("n > 1")
        if last.isEmpty():
            return rounds, subroots


def _extended(nodes: DataFrame, rounds: list[DataFrame], tops: DataFrame, height: int) -> DataFrame:
    """Nodes with their whole witnesses; ``tops`` has those of the trees' roots."""
    spark = nodes.sparkSession
    above = None
    for r in reversed(rounds):
        done = r.where("n = 1").join(tops, "tree").select("tree", "pos", "steps", "subroot", "root")
        if above is None:
            above = done
        else:
            more = _witnessed(r.where("n > 1"), above, height).select("tree", "pos", "steps", "subroot", "root")
            above = done.unionByName(more)
        above = cut_lineage(spark, above, "block_witnesses")
    return _witnessed(nodes, above, height)


def _in_order(rows: DataFrame, order: list[str], group: str | None) -> DataFrame:
    """A table in order: its rows with ``part``, ``run`` of one group in it and ``local`` place there."""
    names = rows.columns

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        run, local, last = -1, 0, None
        for batch in batches:
            groups = batch.column(group).to_pylist() if group else [None] * batch.num_rows
            runs, locals_ = [], []
            for g in groups:
                if run < 0 or g != last:
                    run, local, last = run + 1, 0, g
                runs.append(run)
                locals_.append(local)
                local += 1
            new = [pa.array(x, type=pa.int64()) for x in ([part] * len(runs), runs, locals_)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*names, "part", "run", "local"])

    schema = T.StructType([*rows.schema.fields, *(T.StructField(n, T.LongType()) for n in ("part", "run", "local"))])
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return cut_lineage(rows.sparkSession, ranged.mapInArrow(apply, schema), "in_order")


def _placed(leaves: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Leaves as nodes of their groups' trees, and the trees (tree, n); trees are numbered in group order."""
    spark = leaves.sparkSession
    rows = _in_order(leaves, ["group", "id", "digest"], "group")
    # A row per range and group in it: a group has no more rows than there are ranges.
    own = Window.partitionBy("group")
    before = own.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("part", "run").agg(F.first("group").alias("group"), F.count(F.lit(1)).alias("size"))
    runs = runs.withColumns({
        "start": F.coalesce(F.sum("size").over(before), F.lit(0).cast("long")), "n": F.sum("size").over(own),
    })
    runs = cut_lineage(spark, runs.drop("size"), "runs")

    groups = _in_order(runs.where("start = 0").select("group", "n"), ["group"], None)
    sizes = groups.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    trees = groups.join(starts, "part").select("group", "n", (F.col("start") + F.col("local")).alias("tree"))
    trees = cut_lineage(spark, trees, "trees")
    places = runs.join(trees.withColumnRenamed("group", "of").drop("n"), F.col("group").eqNullSafe(F.col("of")))
    places = as_lookup(places.select("part", "run", "start", "n", "tree"), "places")
    rows = rows.join(places, ["part", "run"]).withColumn("pos", F.col("start") + F.col("local"))
    return rows.drop("part", "run", "local", "start"), trees.select("tree", "n")


def witnesses(df: DataFrame, columns: list[str], id_column: str = "doc_id", group_column: str = "source",
              carry: dict[str, Column] | None = None, height: int = HEIGHT) -> DataFrame:
    """The manifest: per row its id, group, ``leaf``, ``subroot``, ``root``, ``steps`` and what it carries.

    ``leaf`` is the digest of ``columns``; ``steps`` its witness, one step a level with
    the digests ``left`` and ``right`` of it, up to the root of its group's tree and on
    to ``root``. Leaves ascend by id, null first; rows with one id by digest. Groups
    ascend bytewise, null first; null and empty are groups of their own. A lone leaf is
    the root of its tree and has no step. Null and empty values have digests of their
    own; texts count whole. Repeated rows are leaves of their own. An empty table gives
    an empty manifest. Columns that are not named have no influence and may have any
    name. ``carry`` names expressions of the row to return beside it.

    Texts are read once and never shuffled: what is sorted and dealt are digests.
    """
    checked(df, id_column, group_column, *columns)
    spark = df.sparkSession
    carry = carry or {}
    leaves = df.select(
        F.col(f"`{group_column}`").cast("string").alias("group"), F.col(f"`{id_column}`").alias("id"),
        leaf(*(F.col(f"`{c}`") for c in columns)).alias("digest"),
        *(c.alias(f"{n}_") for n, c in carry.items()),
    )
    leaves = cut_lineage(spark, leaves, "leaves")
    nodes, trees = _placed(leaves)
    nodes = cut_lineage(spark, nodes, "nodes")
    rounds, subroots = _grown(nodes, height)

    count = trees.count()
    of_groups = subroots.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("long").alias("n"), "digest"
    )
    above, roots = _grown(of_groups, height)
    top = roots.select(
        "tree", F.expr(f"cast(array() as {STEPS})").alias("steps"), F.lit(None).cast("string").alias("subroot"),
        F.col("digest").alias("root"),
    )
    groups = _extended(of_groups, above, top, height).select(
        F.col("pos").alias("tree"), "steps", F.col("digest").alias("subroot"), "root"
    )
    found = _extended(nodes, rounds, cut_lineage(spark, groups, "tree_witnesses"), height)
    return found.select(
        F.col("id").alias(id_column), F.col("group").alias(group_column), F.col("digest").alias("leaf"),
        "subroot", "root", "steps", *(F.col(f"{n}_").alias(n) for n in carry),
    )
