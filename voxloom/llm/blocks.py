"""Comparing the members of large blocks without ever holding one block whole.

A block is all rows with one key. Blocks above a size are dealt into chunks, and
each pair of chunks becomes a unit of its own, so every two rows of a block meet in
some unit while no unit exceeds two chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.session import as_lookup

_UNIT = ["_llm_key", "_llm_i", "_llm_j"]


def dealt(rows: DataFrame, key: Column, salt: Column, chunk: int) -> DataFrame:
    """Rows with columns ``_llm_key``, ``_llm_i``, ``_llm_j`` naming their unit.

    ``_llm_own`` is the chunk of the row, which is one of the unit's two.

    ``key`` is the block, a long; ``salt`` a number that spreads its rows.
    """
    rows = rows.withColumn("_llm_key", key)
    sizes = rows.groupBy("_llm_key").agg(F.count(F.lit(1)).alias("_llm_size"))
    hot = sizes.where(F.col("_llm_size") > chunk).select(
        "_llm_key", F.ceil(F.col("_llm_size") / chunk).cast("int").alias("_llm_chunks")
    )
    rows = rows.join(as_lookup(hot, "hot_blocks"), "_llm_key", "left")
    chunks = F.coalesce("_llm_chunks", F.lit(1))
    rows = rows.withColumn("_llm_own", F.pmod(salt, chunks).cast("int"))
    # With n chunks a row meets the n - 1 other chunks; its own is there each time.
    others = F.when(chunks == 1, F.array(F.lit(0))).otherwise(
        F.filter(F.sequence(F.lit(0), chunks - 1), lambda x: x != F.col("_llm_own"))
    )
    rows = rows.withColumn("_llm_other", F.explode(others))
    return rows.withColumns(
        {"_llm_i": F.least("_llm_own", "_llm_other"), "_llm_j": F.greatest("_llm_own", "_llm_other")}
    ).drop("_llm_other", "_llm_chunks")


def by_unit(
    rows: DataFrame, f: Callable[[pa.Table], Iterator[pa.RecordBatch]], schema: str, order: str
) -> DataFrame:
    """Apply ``f`` to tables that hold whole units, each unit's rows side by side.

    A task reads its units in order and holds one at a time besides the batch at hand.
    """

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            last = _last_unit(batch)
            if last == 0 and rest and _same_unit(rest[-1], batch):
                rest.append(batch)
                continue
            if rest and not _same_unit(rest[-1], batch):
                yield from f(pa.Table.from_batches(rest))
                rest = []
            if last:
                yield from f(pa.Table.from_batches([*rest, batch.slice(0, last)]))
                rest = []
            rest.append(batch.slice(last))
        if rest:
            yield from f(pa.Table.from_batches(rest))

    rows = rows.repartition(*_UNIT).sortWithinPartitions(*_UNIT, order)
    return rows.mapInArrow(apply, schema)


def _unit_at(batch: pa.RecordBatch, i: int) -> tuple:
    return tuple(batch.column(c)[i].as_py() for c in _UNIT)


def _same_unit(a: pa.RecordBatch, b: pa.RecordBatch) -> bool:
    return _unit_at(a, a.num_rows - 1) == _unit_at(b, 0)


def _starts(table: pa.Table | pa.RecordBatch) -> np.ndarray:
    """Where units begin, and the number of rows at the end."""
    changed = np.zeros(max(0, table.num_rows - 1), dtype=bool)
    for c in _UNIT:
        values = np.asarray(table.column(c))
        changed |= values[1:] != values[:-1]
    return np.concatenate([[0], np.flatnonzero(changed) + 1, [table.num_rows]])


def _last_unit(batch: pa.RecordBatch) -> int:
    return int(_starts(batch)[-2])


def units(table: pa.Table) -> list[tuple[int, int]]:
    """Begin and end of each unit of more than one row."""
    at = _starts(table)
    return [(int(s), int(e)) for s, e in zip(at[:-1], at[1:], strict=True) if e - s > 1]
