"""Which rows of a corpus are usable."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom import constants as C
from voxloom.functions.text import has_text
from voxloom.operators.joins import RESERVED

KEEP = f"{RESERVED}keep"


#: For columns that only some rows have, as their files do, which rows those are.
Present = dict[str, Column]


def text_present(df: DataFrame, columns: list[str] = C.TEXT_COLUMNS, present: Present | None = None) -> Column:
    """Every text column that the table, or the row, has is non-blank."""
    return _all(_where_present(name, has_text(F.col(name)), present) for name in columns if name in df.columns)


def at_least(
    df: DataFrame, minimums: dict[str, float], strict: bool = False, present: Present | None = None
) -> Column:
    """Every listed numeric column that the table, or the row, has reaches its minimum.

    Null and NaN fail. ``strict`` raises on text that is no number; otherwise
    such a row fails the test.
    """

    def reached(name: str) -> Column:
        column = F.col(name)
        number = column.cast("double") if strict else column.try_cast("double")
        return F.coalesce(~F.isnan(number) & (number >= minimums[name]), F.lit(False))

    return _all(_where_present(name, reached(name), present) for name in minimums if name in df.columns)


def keep_condition(
    df: DataFrame,
    text_columns: list[str] = C.TEXT_COLUMNS,
    strict: bool = False,
    present: Present | None = None,
) -> Column:
    """Text, duration and frame tests together; true when no such column exists."""
    return (
        text_present(df, text_columns, present)
        & at_least(df, C.DURATION_MINIMUMS, strict, present)
        & at_least(df, C.FRAME_MINIMUMS, strict, present)
    )


def mark_usable(
    df: DataFrame,
    text_columns: list[str] = C.TEXT_COLUMNS,
    strict: bool = False,
    present: Present | None = None,
) -> DataFrame:
    """Add the never-null flag ``KEEP``; one scan then serves counting and filtering."""
    return df.withColumn(KEEP, keep_condition(df, text_columns, strict, present))


def sanitize(
    df: DataFrame, text_columns: list[str] = C.TEXT_COLUMNS, strict: bool = False
) -> DataFrame:
    return df.where(keep_condition(df, text_columns, strict))


def drop_language_columns(df: DataFrame) -> DataFrame:
    """Drop in-file language columns so the partition key is the only language."""
    return df.drop(*C.LANGUAGE_COLUMNS)


def _where_present(name: str, test: Column, present: Present | None) -> Column:
    return F.when(present[name], test).otherwise(F.lit(True)) if present and name in present else test


def _all(conditions) -> Column:
    return reduce(and_, conditions, F.lit(True))
