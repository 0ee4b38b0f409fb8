import math

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SF, rows
from voxloom.llm import catalog, permutation

KINDS = "vec_id long, embedding array<float>"
ASKED = "vec_id % 10 = 0"


def plain(data, asked, k=10):
    """(query, rank, id, distance) of (id, vector) rows with usable vectors."""
    largest = lambda i: math.inf if i is None else i
    out = []
    for at, (q, v) in enumerate(data):
        if q is None or q % asked:
            continue
        v = np.array(v, dtype=np.float32).astype(float)
        near = []
        for other, (i, w) in enumerate(data):
            if other != at and len(w) == len(v):
                total = 0.0
                for x, y in zip(v, np.array(w, dtype=np.float32).astype(float), strict=True):
                    total += float(x - y) * float(x - y)
                near.append((math.sqrt(total), largest(i), i))
        near.sort(key=lambda x: x[:2])
        out += [(q, r, i, d) for r, (d, _, i) in enumerate(near[:k], 1)]
    return out


def clustered(n, seed, noise, width=24):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(8, width))
    return [(k, (centers[k % 8] + noise * r.normal(size=width)).tolist()) for k in range(n)]


def found(spark, data, **options):
    return permutation.search(spark.createDataFrame(data, KINDS), F.expr(ASKED), **options)


def test_query_against_brute_force(spark):
    data = [(r.vec_id, r.embedding) for r in catalog.table(spark, SF, "embeddings").collect()]
    got = {(r.query_id, r.vec_id): r.score for r in catalog.op12_neighbours(spark, SF).collect()}
    want = {(q, i): d for q, _, i, d in plain(data, 100)}
    assert len(got) == len(want)
    assert sum(p in want for p in got) >= 0.95 * len(want)
    assert all(got[p] == want[p] for p in got if p in want)


def test_exact_equals_brute_force(spark):
    data = clustered(300, 1, 0.3)
    want = plain(data, 10)
    for chunk in (64, 8192):
        assert [tuple(r) for r in found(spark, data, exact=True, chunk=chunk, query_chunk=7).orderBy("query_id", "rank").collect()] == want


def test_recall_and_ranks(spark):
    data = clustered(3000, 2, 0.4)
    got, exact = found(spark, data, chunk=100, query_chunk=50), found(spark, data, exact=True)
    assert permutation.recall(got, exact) >= 0.9
    assert permutation.recall(found(spark, data, order=16, posts=3), exact) >= 0.9
    ranks = {}
    for r in got.orderBy("query_id", "rank").collect():
        ranks.setdefault(r.query_id, []).append((r.rank, r.score, r.vec_id))
    assert len(ranks) == 300
    for q, near in ranks.items():
        assert [n[0] for n in near] == list(range(1, 11)) and q not in [n[2] for n in near]
        assert [n[1:] for n in near] == sorted(n[1:] for n in near)


def test_copies_and_ties(spark):
    cloud = clustered(40, 3, 0.2)
    data = cloud + [(k, cloud[0][1]) for k in range(100, 400)] + [(500, cloud[1][1])] * 3
    assert rows(found(spark, data, exact=True)) == rows(spark.createDataFrame(plain(data, 10), "a long, b int, c long, d double"))
    got = found(spark, data)
    copies = [(r.query_id, r.rank, r.vec_id, r.score) for r in got.where("query_id = 390").collect()]
    assert copies == [(390, k, i, 0.0) for k, i in enumerate([0, *range(100, 109)], 1)]
    assert got.where("query_id = 500 and vec_id = 500 and score = 0").count() == 3 * 2


def test_edges(spark):
    odd = [(20, None), (21, []), (22, [0.0, 0.0]), (23, [None, 1.0]), (24, [math.nan, 1.0]), (25, [math.inf, 1.0]), (30, [])]
    fine = [(10, [1.0, 0.0]), (None, [1.0, 0.0]), (None, [2.0, 0.0]), (11, [2.0, 0.0]), (40, [1.0, 2.0, 3.0]), (50, [3.0])]
    fine += [(60, [5.0]), (10, [1.0, 0.0])]
    df = spark.createDataFrame(odd + fine, KINDS).withColumns({"number": F.lit("x"), "file": F.lit(1)})
    got = permutation.search(df, F.expr(ASKED))
    assert rows(got) == rows(spark.createDataFrame(plain(fine, 10), "a long, b int, c long, d double"))
    assert permutation.search(df.limit(0), F.expr(ASKED)).count() == 0
    assert permutation.search(df.where("vec_id = 40"), F.expr(ASKED)).count() == 0
    assert permutation.search(df, F.lit(None).cast("boolean")).count() == 0


def test_footrule():
    r = np.random.default_rng(1)
    for size in (4, 9):
        lists = np.array([r.permutation(9)[:size] for _ in range(20)])
        place = permutation.positions(lists, 9)
        for mine in lists:
            got = permutation.footrule(place, mine)
            for other, n in zip(lists, got, strict=True):
                at = lambda x, p: list(x).index(p) if p in x else size
                assert n == sum(abs(at(mine, p) - at(other, p)) for p in range(9))
