"""Nearest neighbours by a permutation index.

A vector is represented by the order of its nearest reference points (pivots) and
posted in the inverted files of the first of them. A query opens the files of its own
nearest pivots, ranks what it finds by the footrule distance of the two orders, and the
best ranked are ranked again by true distance.

How many files a query opens and up to which footrule it reranks is not guessed: the
true neighbours of a bounded sample of queries, found against all rows, say what it
takes. Queries that find too few neighbours are compared with all rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import checked
from voxloom.llm.pivots import matrix, usable
from voxloom.session import as_lookup, cut_lineage

#: Neighbours of a query.
K = 10
#: Vectors that pivots are taken from: about the root of their number is taken, so this
#: bounds it, and suffices for the square of it in vectors.
SAMPLE = 16384
LEAST_PIVOTS = 16
#: Pivots of an order that count in the footrule, and files a vector is posted in.
ORDER = 64
POSTS = 2
#: Queries that tell what it takes, and the share of their neighbours that files and footrule must each find.
TRIED = 96
FOUND = 0.985
#: Vectors and queries of one inverted file that meet in one task.
CHUNK = 8192
QUERY_CHUNK = 4096
#: Numbers of a block of distances or positions.
HELD = 1 << 22


def distances(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision, summed in order of the components."""
    total = np.zeros(len(rows))
    for j in range(rows.shape[1]):
        total += (rows[:, j] - query[j]) ** 2
    return np.sqrt(total)


def orders(rows: np.ndarray, pivots: np.ndarray, size: int) -> np.ndarray:
    """Numbers of the ``size`` nearest pivots of each row, nearest first."""
    size = min(size, len(pivots))
    found = np.empty((len(rows), size), dtype=np.int32)
    half = (pivots**2).sum(axis=1) / 2
    step = max(1, HELD // len(pivots))
    for at in range(0, len(rows), step):
        near = half - rows[at : at + step] @ pivots.T
        if size < len(pivots):
            first = np.argpartition(near, size - 1, axis=1)[:, :size]
            # Ascending numbers first, so that ties go to the smaller one.
            first.sort(axis=1)
            by = np.argsort(np.take_along_axis(near, first, axis=1), axis=1, kind="stable")
            found[at : at + step] = np.take_along_axis(first, by, axis=1)
        else:
            found[at : at + step] = np.argsort(near, axis=1, kind="stable")
    return found


def positions(order: np.ndarray, pivots: int) -> np.ndarray:
    """For each pivot its place in each row's order; the length of orders if it has none."""
    place = np.full((pivots, len(order)), order.shape[1], dtype=np.int16)
    np.put_along_axis(place.T, order, np.arange(order.shape[1], dtype=np.int16)[None], axis=1)
    return place


def footrule(place: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Footrule distance of one order from each whose pivots' places are given."""
    size = len(order)
    at = place[order]
    own = np.arange(size, dtype=np.int16)[:, None]
    # Pivots of the other order alone count as far as they are from its end.
    alone = size * (size + 1) // 2 - (size - at).sum(axis=0, dtype=np.int32)
    return np.abs(at - own).sum(axis=0, dtype=np.int32) + alone


@dataclass
class Index:
    """Pivots of each length of vectors, files that a query opens and its greatest footrule."""

    pivots: dict[int, np.ndarray]
    first: dict[int, int]
    files: dict[int, int] = field(default_factory=dict)
    radius: dict[int, int] = field(default_factory=dict)
    order: int = ORDER


def fit(sample: list[np.ndarray], count: int, order: int = ORDER) -> Index:
    """An index of pivots: of each length the first of the sample, so that dense regions have more."""
    wanted = max(LEAST_PIVOTS, int(np.ceil(np.sqrt(count))))
    pivots, first, number = {}, {}, 0
    for length in sorted({len(v) for v in sample}):
        pivots[length] = np.array([v for v in sample if len(v) == length][:wanted], dtype=np.float64)
        first[length] = number
        number += len(pivots[length])
    return Index(pivots, first, order=order)


def calibrate(index: Index, tried: dict[int, np.ndarray], neighbours: list[tuple[int, np.ndarray]],
              posts: int, share: float) -> None:
    """Set files and radius to what ``share`` of the known neighbours of tried queries take."""
    files: dict[int, list[int]] = {}
    radius: dict[int, list[int]] = {}
    for number, vector in neighbours:
        pivots = index.pivots.get(len(vector))
        if pivots is None:
            continue
        both = np.array([tried[number], vector])
        whole = orders(both[:1], pivots, len(pivots))[0]
        short = orders(both, pivots, index.order)
        files.setdefault(len(vector), []).append(1 + min(np.flatnonzero(np.isin(whole, short[1][:posts]))))
        radius.setdefault(len(vector), []).append(int(footrule(positions(short[1:], len(pivots)), short[0])[0]))
    for length, pivots in index.pivots.items():
        for found, kept, most in ((files, index.files, len(pivots)), (radius, index.radius, index.order**2)):
            known = sorted(found.get(length, []))
            kept[length] = known[min(len(known) - 1, int(np.ceil(share * len(known))))] if known else most


def _files(index: Index, vector: Column, posts: int | None) -> Column:
    """Inverted files of a vector: ``posts`` of them, or as many as a query opens."""

    def apply(vectors: pa.Array) -> pa.Array:
        found: list = [None] * len(vectors)
        lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for length in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == length)
            if length not in index.pivots:  # so rare that the sample has none: one file
                for i in at:
                    found[i] = [-int(length)]
                continue
            rows = matrix(vectors.take(pa.array(at))).astype(np.float64)
            size = posts or index.files[length]
            for i, row in zip(at, (orders(rows, index.pivots[length], size) + index.first[length]).tolist(), strict=True):
                found[i] = row
        return pa.array(found, type=pa.list_(pa.int64()))

    apply.__annotations__ = {"vectors": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, "array<long>")(vector)


_NEAR = pa.schema([("query", pa.int64()), ("number", pa.int64()), ("distance", pa.float64()), ("ids", pa.list_(pa.int64()))])
_NEAR_SQL = "query long, number long, distance double, ids array<long>"


def best(distance: np.ndarray, least: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` nearest, ties by least id."""
    if len(distance) > k:
        near = np.flatnonzero(distance <= np.partition(distance, k - 1)[k - 1])
    else:
        near = np.arange(len(distance))
    return near[np.lexsort((least[near], distance[near]))][:k]


def _least(ids: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """The first id of each list; null is the largest."""
    largest = np.iinfo(np.int64).max
    return np.array([largest if v[0] is None else v[0] for v in ids.to_pylist()], dtype=np.int64)


def _search(index: Index | None, k: int):
    """Compares the vectors with the queries of a unit."""

    def apply(key: tuple, table: pa.Table) -> pa.Table:
        asks = np.asarray(table.column("asks"))
        data, queries = table.filter(pa.array(~asks)), table.filter(pa.array(asks))
        found: list[list] = [[], [], [], []]
        if data.num_rows and queries.num_rows:
            rows, wanted = (matrix(t.column("vector")).astype(np.float64) for t in (data, queries))
            numbers, asking = (np.asarray(t.column("number")) for t in (data, queries))
            ids = data.column("ids").to_pylist()
            least = _least(data.column("ids"))
            pivots = index.pivots.get(rows.shape[1]) if index else None
            place = mine = None
            if pivots is not None:
                place = positions(orders(rows, pivots, index.order), len(pivots))
                mine = orders(wanted, pivots, index.order)
            for q, number in enumerate(asking):
                near = np.flatnonzero(numbers != number)
                if place is not None:
                    rank = footrule(place, mine[q])
                    near = near[rank[near] <= index.radius[rows.shape[1]]]
                    near = near[np.argsort(rank[near], kind="stable")]
                distance = distances(rows[near], wanted[q])
                for i in best(distance, least[near], k):
                    for column, value in zip(found, (number, numbers[near[i]], distance[i], ids[near[i]]), strict=True):
                        column.append(value)
        return pa.Table.from_arrays([pa.array(c, type=f.type) for c, f in zip(found, _NEAR, strict=True)], schema=_NEAR)

    return apply


def _met(data: DataFrame, queries: DataFrame, index: Index | None, k: int, chunk: int, query_chunk: int) -> DataFrame:
    """The ``k`` nearest classes of each query among those in its files.

    Vectors and queries of a file are dealt into chunks, and each pair of chunks is a
    unit, so that no task holds a file that many vectors or queries are in.
    """
    both = data.select("file", F.lit(False).alias("asks")).unionByName(queries.select("file", F.lit(True).alias("asks")))
    count = lambda asks, size: F.greatest(F.lit(1), F.ceil(F.count_if(F.col("asks") == asks) / size)).cast("long")
    sizes = both.groupBy("file").agg(count(False, chunk).alias("chunks"), count(True, query_chunk).alias("query_chunks"))
    # Files without queries take no part.
    sizes = as_lookup(sizes.join(queries.select("file").distinct(), "file", "left_semi"), "files")
    own = lambda n: F.pmod(F.xxhash64("number"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    data = data.join(sizes, "file").withColumn("i", own("chunks")).withColumn("j", each("query_chunks"))
    queries = queries.join(sizes, "file").withColumn("j", own("query_chunks")).withColumn("i", each("chunks"))
    columns = ["file", "i", "j", "number", "vector", "ids", "asks"]
    units = data.withColumn("asks", F.lit(False)).select(columns).unionByName(
        queries.withColumns({"asks": F.lit(True), "ids": F.lit(None).cast("array<long>")}).select(columns)
    )
    found = units.groupBy("file", "i", "j").applyInArrow(_search(index, k), _NEAR_SQL).dropDuplicates(["query", "number"])
    return found.withColumn("least", F.get("ids", F.lit(0)))


def _nearest(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy("distance", F.col("least").asc_nulls_last())
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def _true_neighbours(classes: DataFrame, tried: dict[int, np.ndarray], k: int) -> DataFrame:
    """The ``k`` nearest of all vectors for a few queries (query, vector)."""
    vectors = {}
    for length in {len(v) for v in tried.values()}:
        numbers = [n for n, v in tried.items() if len(v) == length]
        vectors[length] = (np.array(numbers), np.array([tried[n] for n in numbers]))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[float, int, list]]] = {n: [] for n in tried}
        for batch in batches:
            number, column = np.asarray(batch.column(0)), batch.column(1)
            lengths = column.value_lengths().to_numpy(zero_copy_only=False)
            for length, (asking, queries) in vectors.items():
                at = np.flatnonzero(lengths == length)
                if not len(at):
                    continue
                rows = matrix(column.take(pa.array(at))).astype(np.float64)
                for q, query in zip(asking.tolist(), queries, strict=True):
                    distance = distances(rows, query)
                    distance[number[at] == q] = np.inf
                    few = np.argsort(distance, kind="stable")[:k]
                    new = [(float(distance[i]), int(number[at[i]]), rows[i].tolist()) for i in few if distance[i] < np.inf]
                    held[q] = sorted(held[q] + new)[:k]
        rows = [(q, *x) for q, found in held.items() for x in found]
        kinds = [pa.int64(), pa.float64(), pa.int64(), pa.list_(pa.float64())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], type=t) for i, t in enumerate(kinds)],
            names=["query", "distance", "number", "vector"],
        )

    found = classes.select("number", "vector").mapInArrow(apply, "query long, distance double, number long, vector array<double>")
    order = Window.partitionBy("query").orderBy("distance", "number")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def search(df: DataFrame, asked: Column, id_column: str = "vec_id", vector_column: str = "embedding", k: int = K,
           sample: int = SAMPLE, order: int = ORDER, posts: int = POSTS, tried: int = TRIED, share: float = FOUND,
           chunk: int = CHUNK, query_chunk: int = QUERY_CHUNK, exact: bool = False) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id`` and ``score``: the ``k`` nearest found of each query.

    Queries are the rows for which ``asked`` holds; all rows but a query's own are its
    candidates. ``score`` is the Euclidean distance in double precision, ties go to the
    smaller id, null ids are the largest. Vectors that are null or empty, have a null or
    non-finite component, or are all zero take no part; vectors of different lengths do
    not meet. Equal vectors are one class, of which the ``k + 1`` smallest ids are kept,
    as no query returns more; repeated rows are rows of their own. A query finds fewer
    than ``k`` only if there are no more candidates. An empty table gives no rows.

    Every vector is indexed. Pivots come from at most ``sample`` classes, chosen by hash,
    and ``tried`` queries, chosen by hash too, tell how much of the index to search for
    ``share`` of their neighbours. ``exact`` compares queries with all rows instead, in
    blocks, which measures recall.
    """
    checked(df, id_column, vector_column)
    spark = df.sparkSession
    rows = df.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{vector_column}`").alias("vector"),
                     F.coalesce(asked, F.lit(False)).alias("asked")).where(usable(F.col("vector")))
    # 128 bits stand for a vector where it would have to be shuffled.
    rows = rows.withColumns({"h1": F.xxhash64("vector"), "h2": F.xxhash64(F.lit(1), F.reverse("vector"))})
    some = Window.partitionBy("h1", "h2").orderBy(F.col("id").asc_nulls_last())
    members = rows.select("h1", "h2", "vector", "id").withColumn("place", F.row_number().over(some)).where(F.col("place") <= k + 1)
    classes = members.groupBy("h1", "h2").agg(
        F.first("vector").alias("vector"), F.sort_array(F.collect_list(F.struct(F.col("id").isNull().alias("n"), "id"))).alias("ids")
    )
    classes = classes.select(F.monotonically_increasing_id().alias("number"), "h1", "h2", "vector", F.col("ids.id").alias("ids"))
    classes = cut_lineage(spark, classes, "classes")
    asking = rows.where("asked").select("id", "h1", "h2").join(classes.select("h1", "h2", "number", F.col("ids").alias("own")), ["h1", "h2"])
    asking = cut_lineage(spark, asking.select("id", "number", "own"), "asking")
    wanted = classes.join(asking.select("number").distinct(), "number", "left_semi").select("number", "vector")
    wanted = cut_lineage(spark, wanted, "queries")

    one_file = -F.size("vector").cast("long")
    if exact:
        index, found = None, _met(classes.withColumn("file", one_file), wanted.withColumn("file", one_file), None, k, chunk, query_chunk)
    else:
        count = classes.count()
        by_hash = lambda table, n: table.orderBy(F.xxhash64("vector"), "number").limit(n).select("number", "vector").collect()
        index = fit([np.array(r.vector, dtype=np.float64) for r in by_hash(classes, sample)], count, order)
        trial = {r.number: np.array(r.vector, dtype=np.float64) for r in by_hash(wanted, tried)}
        known = _true_neighbours(classes, trial, k).select("query", "vector").collect()
        calibrate(index, trial, [(r.query, np.array(r.vector)) for r in known], posts, share)
        posted = classes.withColumn("file", F.explode(_files(index, F.col("vector"), posts)))
        opened = wanted.withColumn("file", F.explode(_files(index, F.col("vector"), None)))
        found = _met(posted, opened, index, k, chunk, query_chunk)
    near = cut_lineage(spark, _nearest(found, k), "nearest")
    if not exact:
        full = near.groupBy("query").agg(F.sum(F.size("ids")).alias("rows")).where(F.col("rows") >= k)
        short = wanted.join(full.select(F.col("query").alias("number")), "number", "left_anti")
        short = cut_lineage(spark, short.withColumn("file", one_file), "short")
        if not short.isEmpty():
            rest = _nearest(_met(classes.withColumn("file", one_file), short, None, k, chunk, query_chunk), k)
            near = near.join(short.select(F.col("number").alias("query")), "query", "left_anti").unionByName(rest)

    near = near.groupBy("query").agg(F.collect_list(F.struct("distance", "ids")).alias("near"))
    joined = asking.join(near.withColumnRenamed("query", "number"), "number", "left")
    # Of its own class a query leaves out itself, once.
    here = F.array_position("own", F.col("id"))
    own = F.when(here > 0, F.filter("own", lambda x, i: i != here - 1)).otherwise(F.col("own"))
    entry = lambda d, x: F.struct(d.alias("score"), x.isNull().alias("n"), x.alias("vec_id"))
    others = F.coalesce(F.col("near"), F.expr("cast(array() as array<struct<distance: double, ids: array<long>>>)"))
    others = F.flatten(F.transform(others, lambda c: F.transform(c["ids"], lambda x: entry(c["distance"], x))))
    every = F.concat(F.transform(own, lambda x: entry(F.lit(0.0), x)), others)
    ranked = joined.select(F.col("id").alias("query_id"), F.posexplode(F.slice(F.sort_array(every), 1, k)).alias("rank", "x"))
    return ranked.select("query_id", (F.col("rank") + 1).cast("int").alias("rank"), "x.vec_id", "x.score")


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the rows of an exact search that the search found; 1 if there are none."""
    hit = found.select("query_id", "vec_id", F.lit(1).alias("hit")).distinct()
    hits = exact.join(hit, ["query_id", "vec_id"], "left").agg(F.avg(F.coalesce("hit", F.lit(0)))).first()[0]
    return 1.0 if hits is None else hits
