import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, WORD
from voxloom.llm import catalog, mixing


def plain_targets(sizes, weights=(1, 2, 3), most=3.0):
    """Shares by weight; full sources leave, until none is above its limit."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    full, target = set(), {}
    while True:
        left = sum(sizes.values()) - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        for s in names:
            target[s] = most * sizes[s] if s in full else left * weight[s] / sum(weight[o] for o in open_)
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            return target
        full |= above


def test_query(spark):
    documents = {r.doc_id: r for r in catalog.table(spark, SF, "documents").collect()}
    got = catalog.op1_mixing(spark, SF).collect()
    assert len(got) == len(documents)
    sizes, taken, largest = defaultdict(int), defaultdict(int), defaultdict(int)
    for r in got:
        d = documents[r.doc_id]
        n = len(WORD.findall(d.text or ""))
        assert r["size"] == n and r.taken <= 3 * n and r.taken == r.copies * n
        sizes[d.source] += n
        taken[d.source] += r.taken
        largest[d.source] = max(largest[d.source], n)
    want = plain_targets(sizes)
    for r in got:
        s = documents[r.doc_id].source
        assert r.source_size == sizes[s] and r.target == pytest.approx(want[s])
        assert abs(taken[s] - want[s]) <= largest[s]
    assert {tuple(r) for r in catalog.op1_mixing(spark, SF).collect()} == {tuple(r) for r in got}


def test_targets_stop_at_the_limit(spark):
    sizes = {"a": 1000, "b": 1, "c": 10, None: 5, "é": 0}
    df = spark.createDataFrame([(s, n, n) for s, n in sizes.items()], "source string, source_size long, n long")
    got = {r.source: r.target for r in mixing.targets(df).collect()}
    assert got == pytest.approx(plain_targets(sizes))


def test_words_near_target_over_levels(spark):
    r = random.Random(4)
    data = [(k, "w " * r.randint(1, 9), "big" if k % 3 else "small") for k in range(3000)]
    df = spark.createDataFrame(data, "doc_id long, text string, source string")
    got = mixing.mix(df, group=8).join(df, "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target")
    )
    for x in got.collect():
        assert abs(x.taken - x.target) <= 9


def test_probabilities_are_kept(spark):
    """Over many draws a document is taken about as often as it should."""
    df = spark.range(4000).select(
        (F.col("id") % 500).alias("slot"), F.col("id"), (1.0 + F.col("id") % 7).alias("size"),
        F.lit(0.3).alias("p"), F.lit(8).cast("long").alias("n"),
    )
    got = mixing.rounded(df, 8).join(df.select("id", "size"), "id").groupBy("size").agg(
        F.avg(F.col("taken").cast("double")).alias("share")
    )
    assert all(abs(x.share - 0.3) < 0.08 for x in got.collect())


def test_edges(spark):
    data = [
        (1, None, "a"), (2, "", "a"), (None, "x y", None), (3, "x y z", None), (4, "q " * 50_000, "a"),
        (5, "w", "b"), (5, "w", "b"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, source string").withColumn("size", F.lit("n"))
    got = mixing.mix(df)
    assert got.count() == len(data)
    assert all(r.taken == 0 for r in got.collect() if r["size"] == 0)
    mixed = mixing.mixed_rows(df)
    assert mixed.columns == df.columns
    assert mixed.count() == got.agg(F.sum("copies")).first()[0]
    assert mixing.mix(df.limit(0)).count() == 0 and mixing.mixed_rows(df.limit(0)).count() == 0


def test_no_python_in_the_plan(spark):
    plan = catalog.op1_mixing(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
