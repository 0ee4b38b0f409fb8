"""The corpus pipeline, stage by stage, against plain versions on the small tables."""

import hashlib
from collections import Counter

import corpus_pipeline
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.helpers import SF, WORD
from tests.llm.test_quality import base
from tests.llm.test_simhash import expected
from voxloom.llm import catalog, chains, divergence

STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows that each stage gets and gives."""
    docs, found = catalog.table(spark, SF, "documents"), {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, SF).write.parquet(path)
        after = spark.read.parquet(path)
        if name != "bpe":
            assert after.columns == docs.columns
        found[name] = (docs.collect(), after.collect())
        docs = after
    return found


def test_quality(spark, stages):
    before, after = stages["quality"]
    known = divergence.references(catalog.table(spark, SF, "documents"))
    want = set()
    for r in before:
        n = base(r.text)
        by_class, by_words = known[r.lang].distances(
            divergence.class_counts((r.text or "").encode()), (r.text or "").encode().lower().split()
        )
        near = (by_class or 0) <= divergence.MAX_CLASS_DISTANCE and (by_words or 0) <= divergence.MAX_WORD_DISTANCE
        if n[0] >= 50 and 100 * n[4] <= 50 * n[0] and near:
            want.add(r.doc_id)
    assert {r.doc_id for r in after} == want and len(after) == len(want)


def test_toxicity(spark, stages):
    before, after = stages["toxicity"]
    chain = chains.fit(catalog.table(spark, SF, "documents"), catalog.table(spark, SF, "labels"), catalog.CATEGORIES)
    want = {r.doc_id for r in before if chain.probabilities(r.text.encode())[-1] < chain.threshold}
    assert {r.doc_id for r in after} == want
    toxic = {r.doc_id for r in catalog.table(spark, SF, "labels").where("toxic = 1").collect()}
    assert len({r.doc_id for r in after} & toxic) <= 0.1 * len({r.doc_id for r in before} & toxic)


def test_near_duplicates(stages):
    before, after = stages["near_duplicates"]
    want = {c for _, _, c in expected([(r.doc_id, r.text) for r in before])}
    assert Counter(r.doc_id for r in after) == Counter(want)


def test_mixing(stages):
    before, after = stages["mixing"]
    copies = Counter(r.doc_id for r in after)
    assert set(copies) <= {r.doc_id for r in before} and max(copies.values()) <= 3
    words = sum(len(WORD.findall(r.text)) for r in before)
    assert sum(len(WORD.findall(r.text)) for r in after) == pytest.approx(words, rel=0.2)


def test_bpe(stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))

    def figures(r):
        ids = library.encode(r.text, add_special_tokens=False).ids
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        return r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(r.text)

    assert Counter(map(tuple, after)) == Counter(map(figures, before))


def test_run_equals_its_stages(spark, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, SF).collect())) == Counter(map(tuple, stages["bpe"][1]))


def test_stages_take_odd_tables(spark):
    schema = catalog.table(spark, SF, "documents").schema
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], schema)
    for docs in (odd, odd.limit(0)):
        for name, stage in STAGES.items():
            got = stage(spark, docs, SF)
            assert got.count() <= docs.count(), name
