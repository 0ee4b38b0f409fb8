import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from voxloom.llm import audit

KINDS = "text string, lang string, source string"


def plain(data, top=200):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in data:
        terms = re.findall(audit.TERM, (text or "").translate(small))
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    kept = {lang: {t for t, n in c.items() if n >= 3} for lang, c in docs.items()}
    groups = sorted(counts)

    def shares(terms, count):
        total = sum(count[t] for t in terms)
        return {t: 1 + 10**9 * (count[t] + 1) // (total + len(terms)) for t in terms}

    p = {g: shares(kept[g[0]], counts[g]) for g in groups}
    out = []

    def ranked(g, part, items):
        for k, (value, item) in enumerate(sorted(items, key=lambda x: (-x[0], x[1].encode())), 1):
            if part == "pair" or k <= top:
                out.append((*g, part, item, value, k))

    f = lambda p, q: (p - q) * (p - q) // q
    for g in groups:
        ranked(g, "pair", [(sum(f(p[g][t], p[h][t]) for t in p[g]), h[1]) for h in groups if h != g and h[0] == g[0]])
        whole = sum((counts[h] for h in groups if h[0] == g[0]), Counter())
        q = shares(kept[g[0]], whole)
        ranked(g, "term", [(f(p[g][t], q[t]), t) for t in q if counts[g][t] and p[g][t] > q[t]])
    return Counter(out)


def corpus(seed, sources, documents):
    r = random.Random(seed)
    words = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(300)] + ["É", "été", "ÉTÉ", "日本", "The", "don't"]
    return [(" ".join(r.choices(words[: r.randrange(20, 306)], k=r.randrange(60))), r.choice(["en", "fr"]), f"s{r.randrange(sources)}")
            for _ in range(documents)]


@pytest.mark.parametrize("sources, block", [(5, 8192), (70, 8192), (40, 37)])
def test_equals_plain_version(spark, sources, block):
    data = corpus(sources, sources, 400)
    df = spark.createDataFrame(data, KINDS).withColumn("number", F.lit(1)).withColumn("term", F.lit("x"))
    assert rows(audit.audit(df, term_block=block)) == plain(data)


def test_edges(spark):
    data = [(None, None, None), ("", "", ""), ("a b", None, "x"), ("a B a", "", "x"), ("A", "", None), ("a", None, "y")]
    data += [("rare", "de", "x"), ("words", "de", "y"), ("alone " * 50_000, "it", "x")]
    data += [("same same", "es", "x")] * 3 + [("same", "es", "y"), (None, "es", "z")]
    assert rows(audit.audit(spark.createDataFrame(data, KINDS))) == plain(data)
    assert audit.audit(spark.createDataFrame([], KINDS)).count() == 0


def test_only_the_first_terms(spark):
    data = corpus(9, 2, 300)
    got = audit.audit(spark.createDataFrame(data, KINDS), top_terms=7)
    assert rows(got) == plain(data, 7)


def test_large_counts(spark):
    n = 9 * 10**17
    df = spark.createDataFrame([(n, 9 * 10**18, 5)], "n long, total long, v long")
    assert df.select(audit.probability(F.col("n"), F.col("total"), F.col("v"))).first()[0] == 1 + 10**9 * (n + 1) // (9 * 10**18 + 5)
