import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from tests.llm.helpers import SF, components, rows
from voxloom.llm import catalog, pivots


def plain(vectors):
    """(id, links, component) of (id, vector) rows with distinct ids."""
    unit = {i: np.array(v) / np.linalg.norm(v) for i, v in vectors}
    links = [(a, b) for a, b in itertools.combinations(unit, 2) if unit[a] @ unit[b] >= 0.95]
    count = dict.fromkeys(unit, 0)
    for a, b in links:
        count[a] += 1
        count[b] += 1
    return {(i, count[i], c) for i, c in components(links, unit).items()}


def clustered(n, seed, noise):
    r = np.random.default_rng(seed)
    centers = r.normal(size=(12, 32))
    return [(k, (centers[k % 12] + noise * r.normal(size=32)).tolist()) for k in range(n)]


def test_query_equals_brute_force(spark):
    vectors = [(r.vec_id, r.embedding) for r in catalog.table(spark, SF, "embeddings").collect()]
    got = {(r.vec_id, r.n_links, r.component_id) for r in catalog.op4_embeddings(spark, SF).collect()}
    assert got == plain(vectors)


def test_recall_on_clusters(spark):
    vectors = clustered(600, 1, 0.15)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    want = plain([(i, np.array(v, dtype=np.float32).astype(float)) for i, v in vectors])
    links = sum(n for _, n, _ in want)
    assert links > 1000
    for chunk in (16, 2048):
        got = pivots.near_duplicates(df, chunk=chunk).collect()
        assert sum(r.n_links for r in got) >= 0.9 * links
        most = {i: n for i, n, _ in want}
        assert all(r.n_links <= most[r.vec_id] for r in got)


def test_units_count_each_pair_once(spark):
    vectors = clustered(300, 2, 0.02)
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    want = plain(vectors)
    for chunk in (5, 13, 2048):
        got = {(r.vec_id, r.n_links, r.component_id) for r in pivots.near_duplicates(df, chunk=chunk).collect()}
        assert got == want


def test_edges(spark):
    data = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.1]), (4, [1.0, 0.0, 0.0]), (5, None), (6, []), (7, [0.0, 0.0]),
        (8, [float("nan"), 1.0]), (9, [None, 1.0]), (10, [float("inf"), 1.0]), (None, [1.0, 0.0]), (1, [1.0, 0.0]),
    ]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumn("number", F.lit("x"))
    got = pivots.near_duplicates(df)
    want = {(1, 4, 1, True): 2, (2, 4, 1, False): 1, (3, 4, 1, False): 1, (None, 4, 1, False): 1}
    assert rows(got) == want | {(k, 0, k, True): 1 for k in (4, 5, 6, 7, 8, 9, 10)}
    assert pivots.near_duplicates(df.limit(0)).count() == 0
    assert pivots.near_duplicates(df.where("vec_id = 7")).count() == 1


def test_pivots_keep_apart():
    r = random.Random(1)
    sample = [np.array([1.0, r.random() / 9]) for _ in range(50)] + [np.array([0.0, 1.0])]
    assert len(pivots.choose_pivots(sample, 10)[2][1]) == 2
