"""Lenient number parsing, fixed-decimal text, labels and paths as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions.text import has_text

_SHARD_SPLIT = "|".join(C.SHARD_SPLITS)
# <language>-<split>-<digits>.parquet
SHARD_NAME = rf"^([A-Za-z0-9_\-]+)-({_SHARD_SPLIT})-(\d+)\.parquet$"


def lenient_double(column: Column) -> Column:
    """A double, or null when the text is no number."""
    return column.try_cast("double")


def lenient_long(column: Column) -> Column:
    """A whole number cut towards zero, or null when there is none."""
    return column.try_cast("double").try_cast("bigint")


def fixed_decimals(column: Column, decimals: int = 2) -> Column:
    """Text with a fixed number of decimals: '' for null, unparsable text unchanged.

    The binary value is rounded half to even, so 0.125 shows as 0.12.
    """
    number = lenient_double(column)
    shown = F.call_function("format_number", number, F.lit("0." + "0" * decimals))
    special = F.when(F.isnan(number), "nan").when(number > 0, "inf").otherwise("-inf")
    infinite = F.abs(number) == float("inf")
    return (
        F.when(column.isNull(), "")
        .when(number.isNull(), column.cast("string"))
        .when(F.isnan(number) | infinite, special)
        .otherwise(shown)
    )


def slug(column: Column) -> Column:
    """A name that is safe inside a file name."""
    return F.regexp_replace(column, "[^A-Za-z0-9_.-]+", "_")


def slug_text(text: str) -> str:
    """``slug`` of a Python string."""
    return re.sub("[^A-Za-z0-9_.-]+", "_", text)


def language_base(column: Column) -> Column:
    """The part of a language label before the first underscore."""
    return F.substring_index(column, "_", 1)


def script_label(column: Column) -> Column:
    """The script-qualified label of a known short code, else the code itself."""
    pairs = [F.lit(x) for item in C.SCRIPT_LABELS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), column), column)


def plain_path(column: Column) -> Column:
    """Local file URIs as plain absolute paths; other schemes stay as they are."""
    return F.regexp_replace(column, "^file:/+", "/")


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def parent(path: Column) -> Column:
    """The containing directory; '' above a top-level name."""
    return F.regexp_replace(path, "/[^/]*$", "")


def stem(path: Column, extension: str) -> Column:
    return F.regexp_extract(path, rf"([^/]+)\.{extension}$", 1)


def partition_value(path: Column, key: str) -> Column:
    """The value of ``key=value`` in a path, or null."""
    found = F.regexp_extract(path, rf"(?:^|/){key}=([^/]*)(?:/|$)", 1)
    return F.when(found != "", found)


def shard_part(name: Column, group: int) -> Column:
    """Language (1), split (2) or shard number (3) of a raw shard name, or null."""
    found = F.regexp_extract(name, SHARD_NAME, group)
    return F.when(found != "", found)


def is_absolute(path: Column) -> Column:
    return F.startswith(path, F.lit("/")) | path.rlike("^[A-Za-z][A-Za-z0-9+.-]*://")


def is_resolvable(path: Column) -> Column:
    """True for a relative, non-blank path; never null."""
    return F.coalesce(has_text(path) & ~is_absolute(path), F.lit(False))


def join_path(base: Column, relative: Column) -> Column:
    """``base/relative`` with '.', '..' and doubled slashes resolved by text alone."""
    scheme_and_host = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)"
    scheme = F.regexp_extract(base, scheme_and_host, 1)
    local = F.concat(F.regexp_replace(base, scheme_and_host, ""), F.lit("/"), relative)
    resolved = F.aggregate(
        F.split(local, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part.isin("", "."), done)
        .when(part == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(part))),
    )
    # Most paths have nothing to resolve.
    plain = F.when(
        local.rlike(r"/\.{0,2}(/|$)"), F.concat(F.lit("/"), F.array_join(resolved, "/"))
    ).otherwise(local)
    return F.concat(scheme, plain)
