"""Text functions against plain Python on edge rows and random word lists."""

import random
import time

from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators.scoring import score_rows


def textbook_distance(a, b):
    previous = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, previous[j] + 1, previous[j - 1] + (x != y)))
        previous = row
    return previous[-1]


EDGE_TEXTS = [
    "",
    " ",
    " ",
    "\x1f",
    "\x0b\x85　",
    "a",
    " Äb\t\nC  d ",
    "\x1c x  y\x1f",
    "İstanbul ΟΔΟΣ ẞ",
    "a😀b",
    "​",
]


def test_has_text_and_normalize_match_python(spark):
    rows = spark.createDataFrame([(x,) for x in EDGE_TEXTS], "t string").select(
        "t",
        T.has_text(F.col("t")).alias("has"),
        T.normalize(F.col("t")).alias("norm"),
        T.strip(F.col("t")).alias("strip"),
        T.word_count(T.normalize(F.col("t"))).alias("n"),
    )
    for r in rows.collect():
        assert r.has == bool(r.t.strip()), repr(r.t)
        assert r.norm == " ".join(r.t.lower().split()), repr(r.t)
        assert r.strip == r.t.strip(), repr(r.t)
        assert r.n == len(r.t.lower().split())


def test_null_text(spark):
    row = (
        spark.createDataFrame([(None,)], "t string")
        .select(T.has_text(F.col("t")).alias("has"), T.normalize(F.col("t")).alias("norm"))
        .first()
    )
    assert (row.has, row.norm) == (False, "")


def test_edit_distances_match_textbook(spark):
    rng = random.Random(7)
    vocabulary = ["a", "b", "cc", "é", "😀", "the", "ab"]
    pairs = [("", ""), ("", "a b"), ("a b", ""), ("a b", "A  b"), ("a😀b", "ab")]
    for _ in range(300):
        pairs.append(
            tuple(" ".join(rng.choices(vocabulary, k=rng.randint(0, 14))) for _ in range(2))
        )
    df = spark.createDataFrame([(i, r, h) for i, (r, h) in enumerate(pairs)], "i int, r string, h string")
    r, h = T.normalize(F.col("r")), T.normalize(F.col("h"))
    got = df.select(
        "i", T.word_edits(r, h).alias("w"), T.char_edits(r, h).alias("c"), T.char_count(r).alias("n")
    ).collect()
    for row in got:
        a, b = (x.lower().split() for x in pairs[row.i])
        assert row.w == textbook_distance(a, b)
        assert row.c == textbook_distance("".join(a), "".join(b))
        assert row.n == len("".join(a))


def test_symbols_stay_distinct_around_the_surrogate_range(spark):
    positions = spark.range(0xD7E0, 0xD820)
    decoded = positions.select(
        F.decode(F.unhex(T.symbol_digits(F.col("id"), 1)), "UTF-32").alias("c")
    )
    assert decoded.where(F.length("c") == 1).distinct().count() == 0x40
    assert decoded.where(F.col("c").isin("?", "\ufffd")).count() == 0


def test_long_pairs_equal_the_textbook(spark):
    r = random.Random(5)
    pairs = []
    for size, edits in ((300, 3), (400, 40), (700, 300), (1500, 12), (1500, 1400)):
        left = [r.choice("abcdefgh") for _ in range(size)]
        right = list(left)
        for _ in range(edits):
            at = r.randrange(len(right))
            kind = r.randrange(3)
            right[at : at + (kind > 0)] = [r.choice("abcdefgh")] if kind < 2 else []
        pairs.append((" ".join(left), " ".join(right)))
    pairs += [("x" * 900, "y" * 5), ("z " * 400, ""), ("a" * 257, "a" * 256)]
    df = spark.createDataFrame(pairs, "reference string, prediction string")
    known = {}
    for beyond in (None, 0, 500):
        for row in score_rows(df, beyond=beyond).collect():
            left, right = row.reference.split(), row.prediction.split()
            if row.reference not in known:
                known[row.reference] = textbook_distance(left, right), textbook_distance("".join(left), "".join(right))
            assert (row.word_edits, row.char_edits) == known[row.reference]
            assert (row.word_total, row.char_total) == (len(left), sum(map(len, left)))


def test_an_hour_of_words_with_few_edits_is_quick(spark):
    r = random.Random(6)
    words = [r.choice("river stone light under morning walk slow over".split()) for _ in range(12_000)]
    other = [w if k % 400 else "changed" for k, w in enumerate(words)]
    df = spark.createDataFrame([(" ".join(words), " ".join(other)), (None, "x"), ("y", "y")], "reference string, prediction string")
    start = time.monotonic()
    rows = score_rows(df, beyond=2000).collect()
    # The whole table of characters has over three billion cells.
    assert rows[0].word_edits == 30 and 30 <= rows[0].char_edits <= 30 * 7 and time.monotonic() - start < 20
    assert [(r.word_edits, r.char_edits) for r in rows[1:]] == [(1, 1), (0, 0)]
