"""Text clean-up and edit distances as column expressions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, including U+001C..U+001F, which Java's own classes leave out.
WHITESPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)

_EMPTY_WORDS = "array<string>"
_FIRST_SHARED_SYMBOL = 3
_SURROGATE_START = 0xD800
_SURROGATE_COUNT = 0x800


def has_text(column: Column) -> Column:
    """True when the value has at least one non-white-space character; never null."""
    return F.coalesce(column.cast("string").rlike(f"[^{WHITESPACE}]"), F.lit(False))


def strip(column: Column) -> Column:
    """Remove Unicode white space from both ends."""
    return F.regexp_replace(column, f"^[{WHITESPACE}]+|[{WHITESPACE}]+$", "")


def normalize(column: Column) -> Column:
    """Lower-case, strip, and turn each white-space run into one space; null becomes ''."""
    lowered = F.lower(F.coalesce(column, F.lit("")))
    return F.trim(F.regexp_replace(lowered, f"[{WHITESPACE}]+", " "))


def words(normalized: Column) -> Column:
    """Words of a normalized text; the empty text has none."""
    return F.when(normalized == "", F.array().cast(_EMPTY_WORDS)).otherwise(
        F.split(normalized, " ")
    )


def word_count(normalized: Column) -> Column:
    return F.size(words(normalized)).cast("long")


def characters(normalized: Column) -> Column:
    """The text that character errors are counted on: no spaces."""
    return F.replace(normalized, F.lit(" "), F.lit(""))


def char_count(normalized: Column) -> Column:
    return F.length(characters(normalized)).cast("long")


def far_edits(left: Column, right: Column) -> Column:
    """Edit distance of long texts in Python, where whole columns of its table are single numbers.

    The built-in function takes time by the product of the lengths, with a threshold too.
    The arguments have to be plain columns; null gives null.
    """
    return F.pandas_udf(_distances, "long")(left, right)


def _distances(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for lefts, rights in parts:
        pairs = zip(lefts, rights)
        yield pd.Series([None if a is None or b is None else bit_distance(a, b) for a, b in pairs], dtype="Int64")


def bit_distance(left: str, right: str) -> int:
    """Edit distance with the steps down a column of the table as bits of two numbers."""
    if not left or not right:
        return len(left) + len(right)
    size = len(left)
    at: dict[str, int] = {}
    for i, symbol in enumerate(left):
        at[symbol] = at.get(symbol, 0) | 1 << i
    every, last = (1 << size) - 1, 1 << (size - 1)
    up, down, distance = every, 0, size
    for symbol in right:
        same = at.get(symbol, 0)
        level = same | down
        along = ((same & up) + up ^ up) | same
        more, less = down | every & ~(along | up), up & along
        distance += bool(more & last) - bool(less & last)
        more, less = (more << 1 | 1) & every, less << 1 & every
        up, down = less | every & ~(level | more), more & level
    return distance


def char_edits(reference: Column, hypothesis: Column) -> Column:
    """Edit distance over the code points of two normalized texts."""
    left, right = characters(reference), characters(hypothesis)
    return F.when(left == right, F.lit(0)).otherwise(F.levenshtein(left, right)).cast("long")


def symbol_digits(position: Column, unshared: int) -> Column:
    """UTF-32 hex digits of the symbol of the word at a 1-based vocabulary position.

    Position 0 stands for a word outside the vocabulary. The range reserved for
    surrogates is stepped over, because those code points cannot be decoded.
    """
    code = position + F.lit(_FIRST_SHARED_SYMBOL - 1)
    code = F.when(code >= _SURROGATE_START, code + _SURROGATE_COUNT).otherwise(code)
    code = F.when(position == 0, F.lit(unshared).cast("long")).otherwise(code)
    return F.lpad(F.hex(code), 8, "0")


def word_edits(reference: Column, hypothesis: Column) -> Column:
    """Edit distance over the words of two normalized texts, by the built-in ``levenshtein``."""
    distances = F.transform(
        _spelled_words(reference, hypothesis), lambda s: F.levenshtein(s["ref"], s["hyp"])
    )
    return (
        F.when(reference == hypothesis, F.lit(0)).otherwise(F.element_at(distances, 1)).cast("long")
    )


def word_symbols(reference: Column, hypothesis: Column) -> Column:
    """Struct of ``ref`` and ``hyp``: the two texts with a code point for each word."""
    return F.element_at(_spelled_words(reference, hypothesis), 1)


def _spelled_words(reference: Column, hypothesis: Column) -> Column:
    """Each word becomes one code point, so that a distance of texts counts words.

    Only a word found on both sides can ever match, hence only those get
    symbols of their own; the others share one symbol per side.
    """

    def spelled(tokens: Column, shared: Column, unshared: int) -> Column:
        positions = F.transform(tokens, lambda word: F.array_position(shared, word))
        symbols = F.transform(positions, lambda position: symbol_digits(position, unshared))
        return F.decode(F.unhex(F.concat_ws("", symbols)), "UTF-32")

    # The one-element array binds each side once, so no word list is rebuilt per word.
    sides = F.array(F.struct(words(reference).alias("ref"), words(hypothesis).alias("hyp")))
    with_shared = F.transform(
        sides,
        lambda s: F.struct(
            s["ref"].alias("ref"),
            s["hyp"].alias("hyp"),
            F.array_intersect(s["ref"], s["hyp"]).alias("shared"),
        ),
    )
    return F.transform(
        with_shared,
        lambda s: F.struct(
            spelled(s["ref"], s["shared"], 1).alias("ref"), spelled(s["hyp"], s["shared"], 2).alias("hyp")
        ),
    )
