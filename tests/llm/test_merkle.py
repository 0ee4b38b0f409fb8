import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, rows
from voxloom.llm import catalog, merkle


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*values):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(digests):
    """Root, and the siblings of each leaf level by level as (left, right)."""
    paths, level, at = [[] for _ in digests], list(digests), list(range(len(digests)))
    while len(level) > 1:
        for i, path in enumerate(paths):
            k = at[i] // 16 * 16
            path.append(("".join(level[k : at[i]]), "".join(level[at[i] + 1 : k + 16])))
        level = [H("".join(level[k : k + 16])) for k in range(0, len(level), 16)]
        at = [k // 16 for k in at]
    return level[0], paths


def plain(data):
    """(id, source, leaf, subroot, root, steps) of (doc_id, source, ...) rows."""
    first = lambda v: (v is not None, v if v is not None else 0)
    by_source = {}
    for r in data:
        by_source.setdefault(r[1], []).append((first(r[0]), leaf(*r), r))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([d for _, d, _ in sorted(by_source[s], key=lambda x: x[:2])]) for s in sources}
    root, paths = tree([trees[s][0] for s in sources])
    for s, upper in zip(sources, paths, strict=True):
        subroot, own = trees[s]
        for (_, d, r), path in zip(sorted(by_source[s], key=lambda x: x[:2]), own, strict=True):
            yield r[0], s, d, subroot, root, tuple(path + upper)


KINDS = "doc_id long, source string, text string"


def check(spark, data, **options):
    df = spark.createDataFrame(data, KINDS).repartition(3).withColumn("tree", F.lit("x"))
    got = merkle.witnesses(df, ["doc_id", "source", "text"], **options).collect()
    found = sorted((str(r.doc_id), str(r.source), r.leaf, r.subroot, r.root, tuple(tuple(s) for s in r.steps)) for r in got)
    assert found == sorted((str(a), str(b), *c) for a, b, *c in plain(data))


@pytest.mark.parametrize("sizes", [[1], [1, 1], [16, 17, 1], [256, 257, 300, 5]])
def test_trees_equal_plain_ones(spark, sizes):
    check(spark, [(k, f"s{j}", f"text {k}") for j, n in enumerate(sizes) for k in range(n)])


def test_many_sources_and_edges(spark):
    data = [(k, f"s{k}", None) for k in range(40)]
    data += [(None, None, "a"), (None, "", ""), (5, None, "b" * 100_000), (5, None, "c"), (5, "é", "\U0001f600"), (5, "z", "ß")]
    check(spark, data + data[-3:])


def test_blocks_of_several_rounds(spark):
    check(spark, [(k, f"s{j}", "x") for j, n in enumerate([300, 20, 1]) for k in range(n)], height=1)
    check(spark, [(k, f"s{k:03}", "x") for k in range(270)], height=1)


def test_empty(spark):
    df = spark.createDataFrame([], KINDS)
    assert merkle.witnesses(df, ["doc_id"]).count() == 0


def test_query_finds_tampered_rows(spark):
    documents = catalog.table(spark, SF, "documents").collect()
    got = {r.doc_id: r for r in catalog.op11_merkle(spark, SF).collect()}
    assert len(got) == len(documents)
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for d in documents:
        changed = zlib.crc32(str(d.doc_id).encode()) % 5 == 0 and d.text.translate(small) != d.text
        r = got[d.doc_id]
        assert r.verified == (not changed) == (r.folded_root == r.root)
    assert 0 < sum(not r.verified for r in got.values()) < len(got)


def test_folds(spark):
    df = spark.createDataFrame([(k, "a" if k % 3 else "b", str(k)) for k in range(50)], KINDS)
    got = merkle.witnesses(df, ["doc_id", "text"], carry={"twice": F.col("doc_id") * 2})
    right = got.where(merkle.fold(F.col("leaf"), F.col("steps")) == F.col("root")).where("twice = 2 * doc_id")
    assert rows(right.select("doc_id")) == rows(df.select("doc_id"))
    wrong = got.where(merkle.fold(F.sha2("leaf", 256), F.col("steps")) == F.col("root"))
    assert wrong.count() == 0
