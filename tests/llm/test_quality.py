import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from tests.compare import difference
from tests.llm.helpers import SF, WORD
from voxloom.llm import catalog, divergence


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    count, covered, seen, again = Counter(windows), set(), set(), 0
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, again, len(covered)


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in catalog.table(spark, SF, "documents").collect()}
    got = catalog.op7_quality(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = base(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert not (r.kept and r.base_failed)


def test_distances_equal_brute_force(spark):
    documents = catalog.table(spark, SF, "documents").collect()
    english = [(r.text or "").lower() for r in documents if r.lang == "en"]
    counts = Counter(w for t in english for w in WORD.findall("".join(c for c in t)))
    known = divergence.references(catalog.table(spark, SF, "documents"))["en"]
    top = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[: divergence.COMMON_WORDS]
    assert known.words[:-1].tolist() == [n for _, n in top]
    assert known.words.sum() == sum(counts.values())

    def distance(p, q):
        p, q = [x / sum(p) for x in p], [x / sum(q) for x in q]
        kl = lambda a, b: sum(x * math.log2(x / ((x + y) / 2)) for x, y in zip(a, b, strict=True) if x)
        return math.sqrt((kl(p, q) + kl(q, p)) / 2)

    words = WORD.findall(max(english, key=len))
    mine = [words.count(w) for w, _ in top]
    mine.append(len(words) - sum(mine))
    got = known.distances(np.ones(8) * 100, [w.encode() for w in words])[1]
    assert got == pytest.approx(distance(mine, known.words.tolist()))


def test_junk_goes_and_prose_stays(spark):
    r = random.Random(1)
    words = "the of and stone river walks under a bright early morning".split() + [f"{a}{b}" for a in "bdlm" for b in ("ane", "old", "int", "ush")]
    prose = lambda: " ".join(r.choices(words, k=300))
    data = [(k, prose() + f" end {k}.", "en") for k in range(30)]
    data += [(100, " ".join(f"{w}###" for w in prose().split()), "en"), (101, prose().upper(), "en")]
    got = divergence.quality(spark.createDataFrame(data, "doc_id long, text string, lang string"))
    failed = {x.doc_id for x in got.collect() if not x.base_failed and not x.kept}
    assert {100, 101} <= failed and not failed & set(range(30))


def test_small_languages_are_judged_too(spark, monkeypatch):
    r = random.Random(2)
    words = "the of and stone river walks under a bright early morning".split() + [f"{a}{b}" for a in "bdlm" for b in ("ane", "old", "int", "ush")]
    prose = lambda: " ".join(r.choices(words, k=300)) + "."
    data = [(k, prose(), lang) for k, lang in enumerate(["en"] * 80 + ["xx"] * 10 + [None] * 10)]
    data += [(k, prose().upper(), lang) for k, lang in ((100, "en"), (101, "xx"), (102, None))]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    want = {x.doc_id: (x.class_distance, x.word_distance, x.kept) for x in divergence.quality(df).collect()}
    assert {k for k, x in want.items() if not x[2]} >= {100, 101, 102}
    monkeypatch.setattr(divergence, "MIN_LANGUAGE_SHARE", 0.5)
    got = divergence.quality(df)
    assert got.columns[:3] == df.columns
    assert {x.doc_id: (x.class_distance, x.word_distance, x.kept) for x in got.collect()} == want
    kept = divergence.keep(df)
    assert kept.columns == df.columns and {x.doc_id for x in kept.collect()} == {k for k, x in want.items() if x[2]}


def test_edges(spark):
    data = [(1, None, "en"), (None, "", None), (3, "word " * 60, "xx"), (3, "word " * 60, "xx")]
    df = spark.createDataFrame(data, "doc_id long, text string, Kept string").withColumnRenamed("Kept", "lang")
    df = df.withColumn("n_words", df.doc_id)
    got = divergence.quality(df)
    assert sorted((r.n_words, r.base_failed) for r in got.collect()) == [(0, True), (0, True), (60, True), (60, True)]
    assert divergence.quality(df.limit(0)).count() == 0
    assert len(set(map(str.lower, got.columns))) == len(got.columns)


def test_repeated_words():
    for seed in range(50):
        r = random.Random(seed)
        text = " ".join(r.choices("abc", k=r.randint(0, 30)))
        assert divergence.repeated_words(text.encode().split()) == base(text)[4]
    assert divergence.repeated_words([b"x"] * 200_000) == 200_000


def test_sql_judges_small_and_null_languages(spark, tmp_path):
    r = random.Random(4)
    words = "the of and stone river walks under a bright early morning".split() + [f"{a}{b}" for a in "bdlm" for b in ("ane", "old", "int", "ush")]
    prose = lambda: " ".join(r.choices(words, k=300)) + "."
    data = [(k, prose() * (40 if lang == "en" else 1), lang) for k, lang in enumerate(["en"] * 80 + ["xx"] * 5 + [None] * 5)]
    data += [(k, prose().upper(), lang) for k, lang in ((100, "en"), (101, "xx"), (102, None))] + [(103, None, None), (104, "", "yy")]
    df = spark.createDataFrame(data, "doc_id long, text string, lang string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert difference(spark, con, catalog.op7_quality, catalog.SQL["op7_quality"], str(tmp_path)) is None
