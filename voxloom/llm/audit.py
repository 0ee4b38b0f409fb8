"""How far the sources of a language diverge from each other, term by term.

Every group (language, source) has a smoothed probability of each kept term of its
language, in whole billionths, and all arithmetic is on integers. The work on pairs of
groups is a cube of cells (group block, group block, term block): a cell gets the rows
of its two group blocks that fall in its term block, has all probabilities there, as
terms that a group lacks share one, and gives a partial divergence for each pair.
Partial divergences are summed along the term axis.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import checked, utf8
from voxloom.session import as_lookup, cut_lineage

#: Runs of ASCII letters and of everything beyond ASCII.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
MIN_DOCUMENTS = 3
UNIT = 1_000_000_000
TOP_TERMS = 200
#: Groups of a group block, and kept terms of a term block on average.
GROUP_BLOCK = 32
TERM_BLOCK = 8192
#: Terms that a task counts before it hands them on.
HELD_TERMS = 200_000

_COUNTED = pa.schema(
    [("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())]
)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences of terms and the documents they are in, for each language and source."""
    # In UTF-8, bytes from 0x80 on are those of characters beyond ASCII.
    find = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+").findall
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    terms_held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), type=pa.string()), pa.array([source] * len(terms), type=pa.string()),
                 pa.array(terms, type=pa.binary()).cast(pa.string()), pa.array([n[t] for t in terms], type=pa.int64()),
                 pa.array([docs[t] for t in terms], type=pa.int64())],
                schema=_COUNTED,
            )
        held.clear()

    for batch in batches:
        groups = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
        for group, text in zip(groups, utf8(batch.column(2)), strict=True):
            n, docs = held.setdefault(group, (Counter(), Counter()))
            own = Counter(find(text.lower()))
            terms_held -= len(n)
            n.update(own)
            docs.update(own.keys())
            terms_held += len(n)
            if terms_held > HELD_TERMS:
                yield from flush()
                terms_held = 0
    yield from flush()


def probability(n: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(UNIT * (n + 1) / (total + terms))``, exact for counts of any size."""
    n, total, terms = (c.cast("decimal(19,0)") for c in (n, total, terms))
    share = F.call_function("div", (n + 1).cast("decimal(20,0)") * F.lit(UNIT).cast("decimal(10,0)"), total + terms)
    return (share + 1).cast("long")


def _excess(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def kept_terms(docs: DataFrame, min_documents: int) -> DataFrame:
    """A row per language and kept term: its number, its count and those of its sources.

    Rows are dealt by (language, term) once; tasks have counted before, so a common term
    has few rows for each group.
    """
    counted = docs.select("lang", "source", "text").mapInArrow(
        _counted, "lang string, source string, term string, n long, docs long"
    )
    by_group = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(
        F.sum("n").alias("n"), F.sum("docs").alias("docs")
    )
    by_term = by_group.groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.collect_list(F.struct("source", "n")).alias("groups")
    )
    kept = by_term.where(F.col("docs") >= min_documents).drop("docs")
    kept = kept.withColumn("number", F.monotonically_increasing_id())
    return cut_lineage(docs.sparkSession, kept, "kept_terms")


_PARTIAL = "lang string, a int, b int, value long"


def _cell(table: pa.Table) -> pa.Table:
    """Partial divergences of the pairs of a cell.

    Rows without a term are the groups, with what a term they lack has there; ``terms``
    is the number of terms in the cell's term block.
    """
    groups, terms, p = (np.asarray(table.column(c)) for c in ("g", "term", "p"))
    i, j, lang, size = (table.column(c)[0].as_py() for c in ("i", "j", "lang", "terms"))
    head = terms < 0
    names, at = np.unique(groups[head], return_index=True)
    lacking = p[head][at]
    row = np.searchsorted(names, groups[~head])
    known, column = np.unique(terms[~head], return_inverse=True)
    full = np.repeat(lacking[:, None], len(known), axis=1)
    has = np.zeros(full.shape, dtype=bool)
    full[row, column] = p[~head]
    has[row, column] = True
    a_side, b_side = np.flatnonzero(names // GROUP_BLOCK == i), np.flatnonzero(names // GROUP_BLOCK == j)
    found = []
    for a in a_side:
        for b in b_side:
            if a == b or (i == j and a > b):
                continue
            seen = np.flatnonzero(has[a] | has[b])
            x, y = full[a, seen], full[b, seen]
            square = (x - y) ** 2
            rest, both = size - len(seen), int(lacking[a] - lacking[b]) ** 2
            to_b = int((square // y).sum()) + rest * (both // int(lacking[b]))
            to_a = int((square // x).sum()) + rest * (both // int(lacking[a]))
            found += [(names[a], names[b], to_b), (names[b], names[a], to_a)]
    return pa.table(
        [pa.array([lang] * len(found), type=pa.string()), pa.array([f[0] for f in found], type=pa.int32()),
         pa.array([f[1] for f in found], type=pa.int32()), pa.array([f[2] for f in found], type=pa.int64())],
        names=["lang", "a", "b", "value"],
    )


def _pairs(groups: DataFrame, rows: DataFrame, terms: DataFrame, term_block: int) -> DataFrame:
    """Divergence of each group ``a`` from each other group ``b`` of its language."""
    blocks = F.ceil(F.col("v") / term_block).cast("long")
    term_of = lambda number: F.pmod(F.xxhash64(number), blocks)
    # Kept terms of each term block; a block has about as many as a cell may hold.
    sizes = terms.groupBy("lang", term_of("number").alias("t")).agg(F.count(F.lit(1)).alias("terms"))
    heads = groups.where("v > 0").join(as_lookup(sizes, "term_blocks"), "lang").select(
        "lang", "g", "group_blocks", "t", "terms", F.lit(-1).cast("long").alias("term"),
        F.col("p0").alias("p"),
    )
    slices = rows.select(
        "lang", "g", "group_blocks", term_of("number").alias("t"), F.lit(0).cast("long").alias("terms"),
        F.col("number").alias("term"), "p",
    )
    own = F.expr(f"g div {GROUP_BLOCK}")
    cells = heads.unionByName(slices).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("group_blocks") - 1)))
    cells = cells.select("lang", "g", "t", "terms", "term", "p",
                         F.least(own, "other").alias("i"), F.greatest(own, "other").alias("j"))

    def partial(key: tuple, table: pa.Table) -> pa.Table:
        # The heads come first, so that the first row has the cell's number of terms.
        return _cell(table.sort_by([("term", "ascending")]))

    found = cells.groupBy("lang", "i", "j", "t").applyInArrow(partial, _PARTIAL)
    return found.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(df: DataFrame, text_column: str = "text", lang_column: str = "lang", source_column: str = "source",
          min_documents: int = MIN_DOCUMENTS, top_terms: int = TOP_TERMS, term_block: int = TERM_BLOCK) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value`` and ``rank``.

    Part ``pair``: divergence of the group from each other source of its language, the
    sum of ``(p - q)^2 div q`` over the language's kept terms, all ranks. Part ``term``:
    what the terms that the group has more of than its language add to its divergence
    from that, the first ``top_terms``. Ranks descend by value, ties ascend bytewise.

    Null texts, languages and sources are empty ones. Texts count whole; repeated rows
    are documents of their own. A language without kept terms has pairs of value 0, one
    without documents no row; an empty table gives no rows. Columns that are not named
    have no influence and may have any name.

    Sources and languages are numbered in tables that are broadcast only if measured
    small. A group with most of the rows is counted by all tasks first and cut into term
    blocks after, as any other is.
    """
    checked(df, text_column, lang_column, source_column)
    spark = df.sparkSession
    lang, source = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (lang_column, source_column))
    docs = df.select(lang.alias("lang"), source.alias("source"), F.col(f"`{text_column}`").alias("text"))
    kept = kept_terms(docs, min_documents)

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("lang_total"))
    totals = kept.select("lang", F.explode("groups").alias("x")).groupBy("lang", F.col("x.source").alias("source"))
    totals = totals.agg(F.sum("x.n").alias("total"))
    groups = docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = groups.select(
        "lang", "source",
        (F.row_number().over(by_source) - 1).cast("long").alias("g"),
        F.coalesce("v", F.lit(0)).cast("long").alias("v"), F.coalesce("total", F.lit(0)).cast("long").alias("total"),
        "lang_total",
    )
    groups = groups.withColumn("p0", F.expr("if(v = 0, null, v)"))
    groups = groups.withColumn("p0", probability(F.lit(0), F.col("total"), F.col("p0")))
    groups = groups.withColumn(
        "group_blocks", F.expr(f"(count(*) over (partition by lang) + {GROUP_BLOCK - 1}) div {GROUP_BLOCK}")
    )
    groups = cut_lineage(spark, groups, "groups")

    terms = kept.select("lang", "number").join(as_lookup(langs, "languages"), "lang")
    rows = kept.select("lang", "term", "number", F.col("n").alias("lang_n"), F.explode("groups").alias("x"))
    rows = rows.select("lang", "term", "number", "lang_n", "x.source", "x.n")
    rows = rows.join(as_lookup(groups, "group_numbers"), ["lang", "source"])
    rows = rows.withColumn("p", probability(F.col("n"), F.col("total"), F.col("v")))

    some = _pairs(groups, rows, terms, term_block)
    a = groups.select("lang", F.col("g").alias("a"), "source")
    b = groups.select("lang", F.col("g").alias("b"), F.col("source").alias("item"))
    pairs = a.join(b, "lang").where("a <> b").join(some, ["lang", "a", "b"], "left")
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    q = probability(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    above = rows.withColumn("q", q).where("p > q").select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), _excess(F.col("p"), F.col("q")).alias("value")
    )
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order)
    above = above.withColumn("rank", rank).where(F.col("rank") <= top_terms)
    return pairs.withColumn("rank", rank).unionByName(above)
