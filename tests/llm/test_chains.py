import math
import random

import numpy as np
import pytest

from tests.llm.helpers import SF
from voxloom.llm import catalog, chains


def documents(n, seed):
    r = random.Random(seed)
    found = []
    for k in range(n):
        words = r.choices("river stone light under morning walks slowly the a of and over".split(), k=80)
        bad = k % 5 == 0
        if bad:
            for _ in range(3):
                words[r.randrange(80)] = r.choice(["vilehound", "scumlet"])
        found.append((k, " ".join(words), int(bad)))
    return found


def test_held_out_accuracy(spark):
    data = documents(400, 1)
    df = spark.createDataFrame([(k, t) for k, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in data if k < 200], "doc_id long, quality int, toxic int")
    chain = chains.fit(df, labels, catalog.CATEGORIES)
    got = {r.doc_id: r.toxic for r in chains.score(df, chain).collect()}
    assert all(got[k] == bool(y) for k, _, y in data)


def test_later_models_use_earlier_probabilities():
    rows = [chains.features_of(t.encode()) for _, t, _ in documents(200, 2)]
    y = np.array([y for *_, y in documents(200, 2)], dtype=float)
    models, held_out = chains.train_chain(rows, np.column_stack([y, y]))
    assert len(models[0].earlier) == 0 and len(models[1].earlier) == 1 and models[1].earlier[0] > 0
    assert held_out.shape == (200, 2)


def test_features_equal_a_plain_loop():
    for text in ["Ab ab, AB! cdefgh", "", "é-é x" * 9, "one two  three\nthree"]:
        slots, words = chains.slots_of(text.encode())
        plain = "".join(c if c.isalnum() or ord(c) > 127 else " " for c in text.lower()).split()
        grams = sum(max(0, len(w.encode()) - chains.GRAM + 1) for w in plain)
        assert words == len(plain) and len(slots) == len(plain) + grams
        by_word = {}
        for w, s in zip(plain, slots[: len(plain)].tolist(), strict=True):
            assert by_word.setdefault(w, s) == s


def test_edges(spark):
    df = spark.createDataFrame([(1, None, "x"), (None, "", "y"), (2, "a " * 9, "z")], "doc_id long, text string, toxic string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert chains.fit(df.drop("toxic"), none, catalog.CATEGORIES) is None
    got = chains.score(df, None)
    assert got.columns.count("toxic") == 1 and not any(r.toxic for r in got.collect())
    data = documents(60, 3)
    train = spark.createDataFrame([(k, t) for k, t, _ in data] * 2, "doc_id long, text string")
    labels = spark.createDataFrame([(k, None, y) for k, _, y in data] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    chain = chains.fit(train, labels, catalog.CATEGORIES)
    assert not any(r.toxic for r in chains.score(df, chain).collect())
    assert chains.score(df.limit(0), chain).count() == 0
    assert len(chain.probabilities(("word " * 100_000).encode())) == 2


def test_threshold():
    p, y = np.array([0.9, 0.8, 0.7, 0.2]), np.array([1.0, 1.0, 0.0, 0.0])
    assert chains.best_threshold(p, y) == 0.75


def test_query_equals_a_plain_chain(spark):
    """The query's chain by a loop over features, and its verdicts on labelled documents it was not trained on."""
    texts = {r.doc_id: (r.text or "") for r in catalog.table(spark, SF, "documents").collect()}
    got = {r.doc_id: r for r in catalog.op10_toxicity(spark, SF).collect()}
    assert set(got) == set(texts)
    documents, labels = (catalog.table(spark, SF, n) for n in ("documents", "labels"))
    chain = chains.fit(documents, labels, catalog.CATEGORIES)
    for k, text in texts.items():
        slots, words = chains.slots_of(text.encode())
        before = []
        for model in chain.models:
            total = model.constant + sum(w * p for w, p in zip(model.earlier, before, strict=True))
            for slot in set(slots.tolist()):
                total += model.weights[slot] * (slots.tolist().count(slot) / max(1, words)) ** 0.5
            before.append(1 / (1 + math.exp(-max(-30, min(30, total)))))
        assert [got[k].p_unsuitable, got[k].p_toxic] == pytest.approx(before, abs=1e-9)
        assert got[k].toxic == (bool(text.strip()) and got[k].p_toxic >= chain.threshold)


def test_held_out_documents_of_the_given_tables(spark):
    """Half of the labels train; of the other half 190 of 231 toxic and 1,799 of 1,814 clean documents were right."""
    documents, labels = (catalog.table(spark, "/root/testdata/sf0.1", n) for n in ("documents", "labels"))
    chain = chains.fit(documents, labels.where("doc_id % 2 = 0"), catalog.CATEGORIES)
    rest = documents.join(labels.where("doc_id % 2 = 1").withColumnRenamed("toxic", "is_toxic"), "doc_id")
    judged = chains.score(rest, chain).select("toxic", "is_toxic").collect()
    caught = [r.toxic for r in judged if r.is_toxic]
    clean = [not r.toxic for r in judged if not r.is_toxic]
    assert sum(caught) >= 0.75 * len(caught) > 0 and sum(clean) >= 0.98 * len(clean)


def test_fit_equals_training_on_whole_features(spark):
    """Slots chosen from Spark's counts, and features cut to them, train the chain of whole features."""
    data = documents(120, 5) * 2
    df = spark.createDataFrame([(k, t) for k, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 3 > 0, y) for k, _, y in data[:120]], "doc_id long, quality boolean, toxic int")
    categories = {"odd": "not quality", "toxic": "toxic = 1"}
    for max_rows in (4000, 20):  # the smaller sample is outgrown by the repeated ids
        chain = chains.fit(df, labels, categories, max_rows=max_rows)
        sample = chains.sample_of(labels, "doc_id", categories, max_rows)
        found = df.withColumnRenamed("doc_id", "id").join(sample, "id")
        found = found.withColumn("h", chains.id_hash("id", "text"))
        rows = found.orderBy("h", "odd", "toxic").limit(2 * max_rows).collect()
        whole = [chains.features_of(r.text.encode()) for r in rows]
        models, _ = chains.train_chain(whole, np.array([[r.odd, r.toxic] for r in rows], dtype=float))
        for got, wanted in zip(chain.models, models, strict=True):
            assert got.weights == pytest.approx(wanted.weights, abs=1e-4)
            assert [*got.earlier, got.constant] == pytest.approx([*wanted.earlier, wanted.constant], abs=1e-4)


def test_white_space_alone_is_not_toxic(spark):
    data = documents(60, 3)
    train = spark.createDataFrame([(k, t) for k, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, y) for k, _, y in data], "doc_id long, quality int, toxic int")
    chain = chains.fit(train, labels, catalog.CATEGORIES)
    chain.threshold = 0.0
    texts = spark.createDataFrame([("\t\n \x0b",), ("",), (None,), ("\t.\n",)], "text string")
    assert [r.toxic for r in chains.score(texts, chain).collect()] == [False, False, False, True]
