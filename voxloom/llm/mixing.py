"""Mixing sources to target weights by pivotal dependent rounding.

A source that is to fill ``target`` words with documents of ``size`` words takes each
document ``target / size`` times: the whole part always, the fraction as a probability.
The fractions are rounded against each other. Two documents are paired, and words move
at random from one to the other, none getting lost, until one of them is taken or left
out; the other, still fractional, meets the next. Every expectation stays as it was and
the words taken miss the target by less than one document.

Pairing runs as a reduction tree: groups of bounded size fold their documents to one
residual, the residuals are grouped and folded in turn, up to one for each source,
which is rounded to the nearer side. Groups are dealt within the sources, so a source
with most of the rows is many groups. All of it is DataFrame expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import RESERVED, SPACE, checked, id_hash
from voxloom.session import as_lookup, cut_lineage

WEIGHTS = (1.0, 2.0, 3.0)
MAX_REPEAT = 3.0
#: Fractional documents that a group of the tree folds to one.
GROUP = 128
_EPS = 1e-12


def word_count(text: Column) -> Column:
    """Words of a text as a long; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[^{SPACE}]+")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS,
            max_repeat: float = MAX_REPEAT) -> DataFrame:
    """Target of each row of ``sizes`` (``source`` unique or null, ``source_size``).

    Other columns stay; ``slot`` numbers the sources in the order of their code
    points, null last. In that order they get the weights in turn.
    Shares of all words follow the weights; no target exceeds ``max_repeat`` times its
    source's size, and what is over goes to the others by weight until none is above.
    """
    spark = sizes.sparkSession
    weighed = cut_lineage(spark, _weighed(sizes, weights), "weighed")
    totals = weighed.agg(
        F.coalesce(F.sum("source_size"), F.lit(0)).alias("size"), F.sum("weight").alias("weight")
    ).first()
    # Words left per unit of weight, after the sources that are full.
    level = totals["size"] / totals["weight"] if totals["weight"] else 0.0
    limit = F.col("source_size") * F.lit(float(max_repeat))
    while True:
        full = F.lit(level) * F.col("weight") >= limit
        got = weighed.agg(
            F.sum(F.when(full, limit)).alias("full"), F.sum(F.when(~full, F.col("weight"))).alias("open")
        ).first()
        if not got["open"]:
            break
        raised = (totals["size"] - (got["full"] or 0.0)) / got["open"]
        if raised <= level:
            break
        level = raised
    target = F.least(limit, F.lit(level) * F.col("weight"))
    return weighed.withColumn("target", target.cast("double")).drop("weight")


def _weighed(sizes: DataFrame, weights: tuple[float, ...]) -> DataFrame:
    """Number the sources without a task that sees all: by range, then offsets."""
    spark = sizes.sparkSession
    order = [F.col("source").isNull(), F.col("source")]
    dealt = sizes.repartitionByRange(*order).withColumn("part", F.spark_partition_id())
    dealt = cut_lineage(spark, dealt, "sources")
    counts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    values = F.array(*(F.lit(float(w)) for w in weights))
    # One row for each partition of the sources: never more than shuffle partitions.
    return (
        dealt.withColumn("rank", rank)
        .join(F.broadcast(offsets), "part")
        .withColumn("slot", F.col("rank") + F.col("offset"))
        .withColumn("weight", F.get(values, F.pmod("slot", F.lit(len(weights))).cast("int")))
        .drop("part", "rank", "offset")
    )


def _uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone."""
    return (F.shiftrightunsigned(F.xxhash64(*columns), 11) + F.lit(0.5)) / F.lit(float(1 << 53))


#: The size comes first, as groups are sorted by it.
_UNIT = "struct<size: double, id: long, p: double>"
_DONE = "struct<id: long, taken: boolean>"


def _fold(units: Column) -> Column:
    """Fold units to the last one that is still open and the decided ones."""

    def step(state: Column, unit: Column) -> Column:
        held, p, q = state["held"], state["held"]["p"], unit["p"]
        here, there = held["size"], unit["size"]
        # Words that may move to the held unit, and away from it.
        into = F.least((1 - p) * here, q * there)
        away = F.least(p * here, (1 - q) * there)
        gains = _uniform(held["id"], unit["id"]) * (into + away) < away
        moved = F.when(gains, into).otherwise(-away)
        new_p = _settled(p + moved / here)
        new_q = _settled(q - moved / there)
        closed = (new_p == 0.0) | (new_p == 1.0)
        decided = F.when(closed, _done(held["id"], new_p)).otherwise(_done(unit["id"], new_q))
        left = F.when(closed, _unit(unit["id"], there, new_q)).otherwise(_unit(held["id"], here, new_p))
        return F.struct(left.alias("held"), F.array_append(state["done"], decided).alias("done"))

    first = F.struct(
        F.element_at(units, 1).cast(_UNIT).alias("held"),
        F.array().cast(f"array<{_DONE}>").alias("done"),
    )
    return F.aggregate(F.slice(units, 2, F.greatest(F.size(units), F.lit(1))), first, step)


def _settled(p: Column) -> Column:
    return F.when(p < _EPS, 0.0).when(p > 1 - _EPS, 1.0).otherwise(p)


def _unit(key: Column, size: Column, p: Column) -> Column:
    return F.struct(size.alias("size"), key.alias("id"), p.alias("p")).cast(_UNIT)


def _done(key: Column, p: Column) -> Column:
    # Of two units one is always closed; its p is 0 or 1 up to rounding.
    return F.struct(key.alias("id"), (p >= 0.5).alias("taken")).cast(_DONE)


def rounded(units: DataFrame, largest: int, group: int = GROUP) -> DataFrame:
    """Round ``p`` of the units (``slot``, ``id``, ``size``, ``p``, ``n``) to ``taken``.

    ``slot`` numbers the source, in which ids are unique, and ``n`` is its number of
    units; ``largest`` is the largest ``n`` and sets the tree's depth. Each level is a
    table.
    """
    spark = units.sparkSession
    decided = []
    left = units
    while True:
        groups = max(1, -(-largest // group))
        # Sources vary in size; a group takes what falls on it, ``group`` on average.
        bucket = F.pmod(F.xxhash64("id", F.lit(groups)), F.greatest(F.lit(1), F.ceil(F.col("n") / group)))
        if groups == 1:
            bucket = F.lit(0)
        folded = (
            left.withColumn("bucket", bucket)
            .groupBy("slot", "bucket")
            .agg(
                # From large to small, so that what stays open tends to be small.
                _fold(
                    F.sort_array(F.collect_list(_unit(F.col("id"), F.col("size"), F.col("p"))), asc=False)
                ).alias("f"),
                F.first("n").alias("n"),
            )
            .select("slot", "f", F.ceil(F.col("n") / group).cast("long").alias("n"))
        )
        folded = cut_lineage(spark, folded, "folded")
        decided.append(folded.select("slot", F.explode("f.done").alias("d")).select("slot", "d.id", "d.taken"))
        left = folded.select("slot", "f.held.id", "f.held.size", "f.held.p", "n")
        if groups == 1:
            break
        largest = groups
    # What is still open is one unit of each source; the nearer side keeps it close.
    result = left.select("slot", "id", (F.col("p") >= 0.5).alias("taken"))
    for d in decided:
        result = result.unionByName(d)
    return result


def decisions(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
              source_column: str = "source", weights: tuple[float, ...] = WEIGHTS,
              max_repeat: float = MAX_REPEAT, group: int = GROUP) -> DataFrame:
    """A row per row of ``df``: the id, ``source``, and what ``mix`` adds.

    Rows of a source with one id (or one 64-bit hash of it) are parts of one document
    and are taken together; so are those without id.
    """
    checked(df, id_column, text_column, source_column)
    spark = df.sparkSession
    rows = df.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{source_column}`").cast("string").alias("source"),
        word_count(F.col(f"`{text_column}`")).alias("size"),
        id_hash(id_column).alias("key"),
    )
    rows = cut_lineage(spark, rows, "sizes")
    sizes = rows.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.count(F.when(F.col("size") > 0, 1)).alias("n")
    )
    sizes = cut_lineage(spark, sizes, "source_sizes")
    wanted = targets(sizes, weights, max_repeat)
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    whole = F.floor(ratio + _EPS)
    params = wanted.select(
        "source", "slot", "source_size", "target", "n", whole.alias("whole"),
        F.greatest(F.lit(0.0), ratio - whole).alias("p"),
    )
    params = cut_lineage(spark, params, "targets")
    largest = params.agg(F.max("n")).first()[0] or 0
    rows = rows.join(
        as_lookup(params.withColumnRenamed("source", "of"), "targets"),
        F.col("source").eqNullSafe(F.col("of")),
    ).drop("of")
    units = (
        rows.where((F.col("size") > 0) & (F.col("p") > _EPS))
        .groupBy("slot", F.col("key").alias("id"))
        .agg(F.sum("size").cast("double").alias("size"), F.first("p").alias("p"), F.first("n").alias("n"))
    )
    extra = rounded(units, largest, group).where("taken").select("slot", F.col("id").alias("key"), "taken")
    extra = cut_lineage(spark, extra, "taken")
    copies = F.col("whole") + F.coalesce(F.col("taken").cast("long"), F.lit(0))
    copies = F.when(F.col("size") > 0, copies).otherwise(F.lit(0)).cast("long")
    return rows.join(extra, ["slot", "key"], "left").select(
        F.col("id").alias(id_column), "source", "key", "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"),
    )


def mix(df: DataFrame, id_column: str = "doc_id", **options) -> DataFrame:
    """Target and share of each row: the id, ``size``, ``source_size``, ``target``,
    ``copies`` (how often the mix takes the document) and ``taken`` (its words in it).

    Null texts have no words and are never taken; null sources are one source. A row
    comes back for each row; an empty table gives an empty one. The draws depend on
    ids and sizes alone, so reruns agree. Other columns are not returned.
    """
    found = decisions(df, id_column, **options)
    return found.select(id_column, "size", "source_size", "target", "copies", "taken")


def mixed_rows(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
               source_column: str = "source", **options) -> DataFrame:
    """The mix itself: every row of ``df`` as often as the mix takes it, all columns."""
    found = decisions(df, id_column, text_column, source_column, **options)
    found = found.groupBy(F.col("key").alias(f"{RESERVED}key"), F.col("source").alias(f"{RESERVED}source")).agg(
        F.max("copies").alias(f"{RESERVED}copies")
    )
    found = cut_lineage(df.sparkSession, found.where(F.col(f"{RESERVED}copies") > 0), "copies")
    keyed = df.withColumn(f"{RESERVED}key", id_hash(id_column))
    source = F.col(f"`{source_column}`").cast("string")
    joined = keyed.join(
        found.withColumnRenamed(f"{RESERVED}key", f"{RESERVED}k"),
        (F.col(f"{RESERVED}key") == F.col(f"{RESERVED}k")) & source.eqNullSafe(F.col(f"{RESERVED}source")),
    ).where(word_count(F.col(f"`{text_column}`")) > 0)
    times = F.explode(F.array_repeat(F.lit(1), F.col(f"{RESERVED}copies").cast("int")))
    return joined.withColumn(f"{RESERVED}i", times).select(*(F.col(f"`{c}`") for c in df.columns))
