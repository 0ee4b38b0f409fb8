"""Quality rules: how far a document's histograms are from those of its language.

Two histograms per document, of character classes and of the language's most common
words, are compared with those of all documents of the language by Jensen-Shannon
distance. Documents too short for a histogram to mean anything are not judged by it.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.llm.common import checked, utf8, with_columns
from voxloom.session import as_lookup, cut_lineage

#: Base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
WINDOW = 3
#: Histograms: common words of a language, and what a document needs to be judged.
COMMON_WORDS = 50
MIN_CLASS_CHARS = 300
MIN_COMMON_WORDS = 150
#: Distances (0 to 1) above which a document is rejected.
MAX_CLASS_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.37
#: References of languages with this share of all words go to every task; those of all
#: others stay a table that rows are joined with. So there are at most as many of the
#: former as the share's inverse, which bounds what goes to the driver.
MIN_LANGUAGE_SHARE = 1e-4
#: Words counted side by side in a task before it passes them on.
HELD_WORDS = 100_000

SYMBOLS = b"#*$%&|<>"
PUNCTUATION = b".,;:!?'\"()[]{}-_/\\@^`~+="
CLASSES = ["lower", "upper", "digit", "space", "punctuation", "symbol", "control", "wide"]
_CONTINUATION = len(CLASSES)


def _class_of_byte() -> np.ndarray:
    kind = np.full(256, CLASSES.index("control"), dtype=np.uint8)
    kind[ord("a") : ord("z") + 1] = CLASSES.index("lower")
    kind[ord("A") : ord("Z") + 1] = CLASSES.index("upper")
    kind[ord("0") : ord("9") + 1] = CLASSES.index("digit")
    kind[list(b" \t\n\v\f\r")] = CLASSES.index("space")
    kind[list(PUNCTUATION)] = CLASSES.index("punctuation")
    kind[list(SYMBOLS)] = CLASSES.index("symbol")
    kind[0x80:0xC0] = _CONTINUATION
    kind[0xC0:] = CLASSES.index("wide")
    return kind


_KIND = _class_of_byte()


def class_counts(text: bytes) -> np.ndarray:
    """Code points of each class."""
    kinds = _KIND[np.frombuffer(text, dtype=np.uint8)]
    return np.bincount(kinds, minlength=_CONTINUATION + 1)[:_CONTINUATION]


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words that lie in a window found twice or more."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], dtype=np.int64)
    # Windows are numbered word by word, so that numbers stay within the text's length.
    window = ids[:n]
    for k in range(1, width):
        window = np.unique(window * len(number) + ids[k : k + n], return_inverse=True)[1]
    twice = np.bincount(window)[window] > 1
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    edge[:n] += twice
    edge[width : width + n] -= twice
    return int(np.count_nonzero(np.cumsum(edge)[:-1]))


def duplicate_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [line for line in text.split(b"\n") if line.split(None, 1)]
    return len(lines) - len(set(lines))


def distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance, to base 2, of two histograms with some count each."""
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        parts = [np.where(x > 0, x * np.log2(x / m), 0.0).sum() for x in (p, q)]
    return float(np.sqrt(max(0.0, sum(parts) / 2)))


class Reference:
    """Histograms of a language."""

    def __init__(self, classes: list[int], words: list[tuple[str, int]], all_words: int):
        self.classes = np.array(classes, dtype=float)
        self.at = {w.encode(): i for i, (w, _) in enumerate(words)}
        counts = [n for _, n in words]
        self.words = np.array([*counts, all_words - sum(counts)], dtype=float)

    def distances(self, classes: np.ndarray, words: list[bytes]) -> tuple[float | None, float | None]:
        by_class = distance(classes, self.classes) if classes.sum() >= MIN_CLASS_CHARS else None
        if len(words) < MIN_COMMON_WORDS:
            return by_class, None
        counts = np.zeros(len(self.words))
        for w, n in Counter(words).items():
            counts[self.at.get(w, -1)] += n
        return by_class, distance(counts, self.words)


_STATS = "language string, word string, count long, classes array<long>"


def _partial_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("language", pa.string()), ("word", pa.string()), ("count", pa.int64()), ("classes", pa.list_(pa.int64()))]
    )
    words: dict[str | None, Counter] = {}
    classes: dict[str | None, np.ndarray] = {}

    def flush() -> pa.RecordBatch:
        rows = [(k, w.decode(), n, None) for k, c in words.items() for w, n in c.items()]
        rows += [(k, None, None, c.tolist()) for k, c in classes.items()]
        words.clear()
        classes.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], type=f.type) for i, f in enumerate(schema)], schema=schema
        )

    for batch in batches:
        for language, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), strict=True):
            words.setdefault(language, Counter()).update(text.lower().split())
            classes[language] = classes.get(language, 0) + class_counts(text)
            if sum(map(len, words.values())) > HELD_WORDS:
                yield flush()
    yield flush()


def _all_references(df: DataFrame, text_column: str, language_column: str) -> tuple[DataFrame, int]:
    """A table of the reference of each language, from all rows, and the count of all words."""
    language = F.col(f"`{language_column}`").cast("string")
    stats = df.select(language, F.col(f"`{text_column}`")).mapInArrow(_partial_counts, _STATS)
    by_word = stats.groupBy("language", "word").agg(
        F.sum("count").alias("count"),
        *(F.sum(F.get("classes", F.lit(i))).alias(c) for i, c in enumerate(CLASSES)),
    )
    by_word = cut_lineage(df.sparkSession, by_word, "words")
    totals = by_word.groupBy("language").agg(
        F.coalesce(F.sum("count"), F.lit(0)).alias("words"), F.array(*(F.sum(c) for c in CLASSES)).alias("classes")
    )
    order = Window.partitionBy("language").orderBy(F.desc("count"), "word")
    top = by_word.where("word is not null").withColumn("rank", F.row_number().over(order))
    top = top.where(F.col("rank") <= COMMON_WORDS).groupBy("language").agg(
        F.sort_array(F.collect_list(F.struct("rank", "word", "count"))).alias("top")
    )
    found = totals.where("words > 0").join(
        top.withColumnRenamed("language", "of"), F.col("language").eqNullSafe(F.col("of"))
    )
    value = F.to_json(F.struct("classes", "top", "words"))
    found = cut_lineage(df.sparkSession, found.select("language", "words", value.alias("reference")), "references")
    return found, found.agg(F.sum("words")).first()[0] or 0


def _reference(value: str) -> Reference:
    r = json.loads(value)
    return Reference(r["classes"], [(x["word"], x["count"]) for x in r["top"]], r["words"])


def references(df: DataFrame, text_column: str = "text", language_column: str = "lang") -> dict:
    """Reference of each language with a large share of the words; null is a language of its own.

    Words are counted over the whole corpus by Spark; what reaches the driver is the
    common words of these languages.
    """
    return _large(*_all_references(df, text_column, language_column))


def _large(table: DataFrame, overall: int) -> dict:
    large = table.where(F.col("words") >= F.lit(MIN_LANGUAGE_SHARE * overall)).collect()
    return {r.language: _reference(r.reference) for r in large}


_RESULT = pa.struct(
    [
        *((n, pa.int64()) for n in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")),
        ("class_distance", pa.float64()),
        ("word_distance", pa.float64()),
    ]
)
_RESULT_DDL = (
    "struct<n_words: long, word_chars: long, n_symbols: long, n_dup_lines: long, n_repeat_words: long, "
    "class_distance: double, word_distance: double>"
)


def measure(text: bytes, reference: Reference | None) -> tuple:
    """The figures of a document, in the order of the result."""
    words = text.split()
    classes = class_counts(text)
    by_class = by_words = None
    if reference:
        by_class, by_words = reference.distances(classes, text.lower().split())
    return (
        len(words),
        int(classes.sum() - classes[CLASSES.index("space")]),
        int(classes[CLASSES.index("symbol")]),
        duplicate_lines(text),
        repeated_words(words),
        by_class,
        by_words,
    )


def quality(df: DataFrame, text_column: str = "text", language_column: str = "lang",
            max_class_distance: float = MAX_CLASS_DISTANCE,
            max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """Add the figures of each row, ``base_failed`` and ``kept``.

    A null text has no words. Documents under the minimum lengths have null distances
    and are judged by the base rules alone. Repeated rows are judged each for itself; an empty table stays empty.
    Columns of the input with the names of the results are replaced.
    """
    df, judged = _judged(df, text_column, language_column)
    df = df.withColumn("_llm_q", judged)
    new = {f.name: F.col(f"_llm_q.{f.name}") for f in _RESULT}
    verdict = _verdict(F.col("_llm_q"), max_class_distance, max_word_distance)
    return with_columns(df, new | verdict).drop("_llm_q", "_llm_language", "_llm_reference")


def keep(df: DataFrame, text_column: str = "text", language_column: str = "lang",
         max_class_distance: float = MAX_CLASS_DISTANCE,
         max_word_distance: float = MAX_WORD_DISTANCE) -> DataFrame:
    """The rows of ``df`` that ``quality`` keeps."""
    rows, judged = _judged(df, text_column, language_column)
    rows = rows.where(_verdict(judged, max_class_distance, max_word_distance)["kept"])
    return rows.drop("_llm_language", "_llm_reference")


def _judged(df: DataFrame, text_column: str, language_column: str) -> tuple[DataFrame, Column]:
    """Rows, beside the reference of their language if tasks do not have it, and their figures."""
    checked(df, text_column, language_column)
    table, overall = _all_references(df, text_column, language_column)
    known = _large(table, overall)
    small = table.where(F.col("words") < F.lit(MIN_LANGUAGE_SHARE * overall))
    joined = F.lit(None).cast("string")
    if not small.isEmpty():
        small = small.select(F.col("language").alias("_llm_language"), F.col("reference").alias("_llm_reference"))
        same = F.col(f"`{language_column}`").cast("string").eqNullSafe(F.col("_llm_language"))
        df, joined = df.join(as_lookup(small, "small-references"), same, "left"), F.col("_llm_reference")

    def apply(texts: pa.Array, languages: pa.Array, others: pa.Array) -> pa.Array:
        parsed = lru_cache(maxsize=256)(_reference)
        rows = zip(utf8(texts), languages.to_pylist(), others.to_pylist(), strict=True)
        found = [measure(t, known.get(k) if v is None else parsed(v)) for t, k, v in rows]
        columns = zip(*found, strict=True) if found else [[] for _ in _RESULT]
        return pa.StructArray.from_arrays(
            [pa.array(c, type=f.type) for c, f in zip(columns, _RESULT, strict=True)], fields=list(_RESULT)
        )

    apply.__annotations__ = {"texts": pa.Array, "languages": pa.Array, "others": pa.Array, "return": pa.Array}
    return df, F.arrow_udf(apply, _RESULT_DDL)(
        F.col(f"`{text_column}`"), F.col(f"`{language_column}`").cast("string"), joined
    )


def _verdict(q: Column, max_class_distance: float, max_word_distance: float) -> dict[str, Column]:
    failed = (q["n_words"] < MIN_WORDS) | (
        100 * q["n_repeat_words"] > MAX_REPEAT_PERCENT * q["n_words"]
    )
    near = (F.coalesce(q["class_distance"], F.lit(0.0)) <= max_class_distance) & (
        F.coalesce(q["word_distance"], F.lit(0.0)) <= max_word_distance
    )
    return {"base_failed": failed, "kept": ~failed & near}
