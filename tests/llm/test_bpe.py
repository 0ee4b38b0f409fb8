import hashlib
import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.helpers import SF
from voxloom.llm import bpe, catalog

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary(PATH))


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def split(found):
    tokens, counts = (x.tolist() for x in found)
    rows, at = [], 0
    for n in counts:
        rows.append(tokens[at : at + n])
        at += n
    return rows


def both(encoder, library, texts):
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert split(encoder.encode(texts)) == want


def test_query_equals_the_library(spark, library):
    documents = {r.doc_id: r.text or "" for r in catalog.table(spark, SF, "documents").collect()}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    got = catalog.op3_bpe(spark, SF).collect()
    assert len(got) == len(documents)
    for r in got:
        ids = library.encode(documents[r.doc_id], add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(text))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=5))
def test_any_text(encoder, library, texts):
    both(encoder, library, texts)


def test_spaces_specials_and_long_words(encoder, library):
    r = random.Random(1)
    letters = [*" \t\n\r\x0b\x0c\x1c\x85\xa0\u3000'sdtreé中👍!?.,03", "<|endoftext|>", "'re", "'ll", "<|end"]
    both(encoder, library, ["".join(r.choices(letters, k=r.randint(0, 30))) for _ in range(3000)])
    both(encoder, library, ["a" * k for k in range(200)] + ["the" * 40_000, "é" * 999])


def test_memory_is_bounded(library):
    small = bpe.Encoder(bpe.Vocabulary(PATH), remembered=20)
    for k in range(5):
        both(small, library, [f"alpha{k} beta gamma {k}", "delta epsilon zeta eta theta " * 3])
        assert len(small.number) < 50


def test_edges(spark):
    df = spark.createDataFrame([(1, None), (None, ""), (2, "a<|endoftext|>é"), (2, "a<|endoftext|>é")], "ids long, text string")
    got = bpe.round_trip(df, "text", PATH)
    assert got.columns == ["text", "ids", "decoded"]
    assert [(len(r.ids), r.decoded) for r in got.collect()] == [(0, ""), (0, ""), (3, "a<|endoftext|>é"), (3, "a<|endoftext|>é")]
    assert bpe.round_trip(df.limit(0), "text", PATH).count() == 0
    ids = spark.createDataFrame([([447, 247],), ([447],), (None,), ([],)], "ids array<int>")
    assert [r.t for r in ids.select(bpe.decode(F.col("ids"), PATH).alias("t")).collect()] == ["’", "\ufffd", "", ""]
    with pytest.raises(Exception, match="vocabulary"):
        spark.createDataFrame([([60_000],)], "ids array<int>").select(bpe.decode(F.col("ids"), PATH)).collect()
