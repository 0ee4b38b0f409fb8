import itertools
import random

import numpy as np
import xxhash

from tests.llm.helpers import SF, WORD, components, rows
from voxloom.llm import catalog, simhash


def plain(text):
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def expected(ids_and_texts):
    prints = {i: plain(t) for i, t in ids_and_texts}
    links = [
        (a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4
    ]
    return {(i, f"{prints[i]:016x}", c) for i, c in components(links, prints).items()}


def test_query_equals_brute_force(spark):
    documents = catalog.table(spark, SF, "documents").select("doc_id", "text").collect()
    got = {tuple(r) for r in catalog.op6_simhash(spark, SF).collect()}
    assert got == expected([tuple(r) for r in documents])


def test_links_survive_hot_keys(spark):
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(40)]
    codes = {b ^ sum(1 << k for k in r.sample(range(64), r.randint(0, 5))) for b in base for _ in range(30)}
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([(c,) for c in signed], "code long")
    a = np.array(signed).view(np.uint64)
    want = components(
        [(signed[i], signed[j]) for i in range(len(a)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4)],
        signed,
    )
    for chunk in (8, 10_000):
        links = [(x.a, x.b) for x in simhash.linked_codes(df, chunk=chunk).collect()]
        assert components(links, signed) == want


def test_edges(spark):
    data = [
        (1, None, "x"), (2, "", "y"), (3, " \n", "z"), (4, "one two", "a"), (5, "ONE two", "b"),
        (None, "one two", "c"), (6, "other words here now", "d"), (4, "one two", "a"),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, code string")
    got = simhash.near_duplicates(df)
    assert {(r.doc_id, r.component_id) for r in got.collect()} == {
        (1, 1), (2, 1), (3, 1), (4, 4), (5, 4), (None, 4), (6, 6),
    }
    assert got.count() == len(data)
    kept = simhash.keep_one(df)
    assert kept.columns == df.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 6]
    assert simhash.near_duplicates(df.limit(0)).count() == 0
    assert simhash.keep_one(df.limit(0)).count() == 0
    alone = spark.createDataFrame([(None, "a b"), (None, "c d")], "doc_id long, text string")
    assert rows(simhash.near_duplicates(alone).select("doc_id", "component_id")) == {(None, None): 2}
    assert simhash.keep_one(alone).count() == 2


def test_kept_rows_do_not_depend_on_order(spark):
    data = [(1, "a b c", k % 3, {"k": str(k % 3)}) for k in range(9)] + [(None, "d e", None, None), (None, "d e", 0, None)]
    df = spark.createDataFrame(data, "doc_id long, text string, n int, m map<string,string>")
    got = {str(sorted(map(str, simhash.keep_one(df.repartition(n)).collect()))) for n in (1, 3, 7)}
    assert len(got) == 1
    plan = simhash.keep_one(df)._jdf.queryExecution().executedPlan().toString()
    assert simhash.keep_one(df).count() == 2 and "ArrowEvalPython" not in plan


def test_long_text():
    text = " ".join(str(k % 9000) for k in range(150_000))
    assert simhash.fingerprint(text.encode()) % (1 << 64) == plain(text)
