"""What the operators of this package share."""

from __future__ import annotations

import sys
from collections.abc import Callable
from types import ModuleType
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Helper columns carry this prefix, so that they clash with no input column.
RESERVED = "_llm_"

#: The characters that separate words, as a class for regular expressions.
SPACE = r"\x20\x09-\x0D"


def checked(df: DataFrame, *names: str) -> DataFrame:
    """Fail early, naming the columns that are not there."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    reserved = [n for n in df.columns if n.startswith(RESERVED)]
    if reserved:
        raise ValueError(f"columns may not begin with {RESERVED}: {', '.join(reserved)}")
    return df


def with_columns(df: DataFrame, new: dict[str, Column]) -> DataFrame:
    """Add columns; those of the input with such a name (in any case) give way."""
    names = {n.lower() for n in new}
    kept = [F.col(f"`{n}`") for n in df.columns if n.lower() not in names]
    return df.select(*kept, *(c.alias(n) for n, c in new.items()))


def utf8(texts: pa.Array) -> list[bytes]:
    """The texts as UTF-8; null is the empty text."""
    return [b"" if t is None else t for t in texts.cast(pa.large_binary()).to_pylist()]


def text_udf(f: Callable[[bytes], object], kind: pa.DataType, returns: str):
    """An Arrow function of one text column that calls ``f`` with each text as UTF-8."""

    def apply(texts: pa.Array) -> pa.Array:
        return pa.array([f(t) for t in utf8(texts)], type=kind)

    apply.__annotations__ = {"texts": pa.Array, "return": pa.Array}
    return F.arrow_udf(apply, returns)


def id_hash(*columns: str) -> Column:
    """A number from columns that may be null, the same on every run."""
    return F.xxhash64(*(F.col(f"`{c}`") for c in columns))


def kept_by_worker(key: str, make: Callable[[], Any]) -> Any:
    """An object that a Python worker makes once and keeps from task to task.

    Functions travel to the workers by value, and their globals with them, so a global
    of this package would be new in every task.
    """
    memory = sys.modules.setdefault("_llm_worker_memory", ModuleType("_llm_worker_memory"))
    if not hasattr(memory, key):
        setattr(memory, key, make())
    return getattr(memory, key)
