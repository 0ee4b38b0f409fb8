"""Near-duplicate documents by SimHash fingerprints.

Fingerprints that differ in at most ``max_bits`` bits are linked. Pigeonhole: cut a
fingerprint into ``blocks`` blocks; the differing bits spoil at most ``max_bits`` of
them, so two linked fingerprints agree on some choice of ``blocks - max_bits``
blocks. Each choice is a join key; fingerprints that share a key are compared.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxloom.llm.blocks import by_unit, dealt, units
from voxloom.llm.common import RESERVED, checked, text_udf, with_columns
from voxloom.llm.components import connected_components
from voxloom.session import cut_lineage

WIDTH = 4
SEED = 42
BITS = 64
MAX_BITS = 4
#: More blocks make keys longer and blocks of rows smaller, but the keys more numerous.
BLOCKS = 6
#: Fingerprints of one key that a unit takes from each of two chunks.
CHUNK = 8192
#: Up to here all pairs of a unit are compared at once, above it by search.
SMALL = 32


def fingerprint(text: bytes, width: int = WIDTH, seed: int = SEED) -> int:
    """Fingerprint of a UTF-8 text as a signed long; zero without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - width + 1)
    starts, ends = starts[:n].tolist(), ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, 65_536):
        part = zip(starts[at : at + 65_536], ends[at : at + 65_536], strict=True)
        hashes = np.array([digest(joined[s:e], seed) for s, e in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprint_column(text: Column) -> Column:
    return text_udf(fingerprint, pa.int64(), "long")(text)


def masks(blocks: int = BLOCKS, max_bits: int = MAX_BITS) -> list[int]:
    """A mask of the bits of every choice of ``blocks - max_bits`` blocks."""
    edges = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << e) - 1) ^ ((1 << s) - 1) for s, e in itertools.pairwise(edges)]
    return [sum(c) for c in itertools.combinations(block, blocks - max_bits)]


def _signed(x: int) -> int:
    return x - (1 << BITS) if x >> (BITS - 1) else x


def spanning(codes: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is linked within ``codes``: (least of a component, member).

    A search drops each code as it is reached, so a dense group costs little more
    than its size; only codes without links are compared with all others.
    """
    rest, roots, members = np.sort(codes), [], []
    while len(rest) > 1:
        root, todo, rest = rest[0], [rest[0]], rest[1:]
        while todo and len(rest):
            near = np.bitwise_count(rest ^ todo.pop()) <= max_bits
            if near.any():
                found = rest[near]
                rest = rest[~near]
                todo.extend(found)
                members.append(found)
                roots.append(np.full(len(found), root))
    none = np.empty(0, dtype=codes.dtype)
    return np.concatenate([none, *roots]), np.concatenate([none, *members])


def linked_codes(codes: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
                 chunk: int = CHUNK) -> DataFrame:
    """Links (``a``, ``b``) that join all distinct ``code`` values linked to each other.

    Not every pair: within a key's unit a star or the pairs of a small unit, which
    have the same components as all pairs.
    """
    choices = masks(blocks, max_bits)
    rows = codes.select(
        "code", F.posexplode(F.array(*(F.lit(_signed(m)) for m in choices))).alias("pick", "mask")
    )
    key = F.xxhash64(F.col("pick"), F.col("code").bitwiseAND(F.col("mask")))
    rows = dealt(rows.select("code", key.alias("k")), F.col("k"), F.xxhash64("code"), chunk)

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        code = table.column("code").to_numpy().view(np.uint64)
        a, b = [], []
        unit = np.full(len(code), -1)
        for i, (s, e) in enumerate(units(table)):
            if e - s <= SMALL:
                unit[s:e] = i
            else:
                roots, members = spanning(np.unique(code[s:e]), max_bits)
                a.append(roots)
                b.append(members)
        for lag in range(1, SMALL):
            at = np.flatnonzero((unit[lag:] == unit[:-lag]) & (unit[lag:] >= 0))
            if not len(at):
                break
            at = at[np.bitwise_count(code[at] ^ code[at + lag]) <= max_bits]
            a.append(code[at])
            b.append(code[at + lag])
        if any(map(len, a)):
            found = [np.concatenate(x).view(np.int64) for x in (a, b)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["a", "b"])

    rows = rows.select("code", "_llm_key", "_llm_i", "_llm_j")
    return by_unit(rows, compare, "a long, b long", "code")


def classes(prints: DataFrame, max_bits: int = MAX_BITS, blocks: int = BLOCKS,
            chunk: int = CHUNK) -> DataFrame:
    """``code``, ``component_id`` and ``component_code`` from (``id``, ``code``) rows.

    ``component_id`` is the least id linked to the code, and ``component_code`` the
    least code that this id has in the component. Null ids count as the largest.
    """
    spark = prints.sparkSession
    first = F.min(F.struct(F.col("id").isNull().alias("n"), F.col("id"), F.col("code")))
    codes = cut_lineage(spark, prints.groupBy("code").agg(first.alias("first")), "codes")
    links = linked_codes(codes, max_bits, blocks, chunk)
    nodes = cut_lineage(spark, connected_components(links), "components")
    rooted = codes.join(nodes, codes.code == nodes.node, "left").select(
        "code", "first", F.coalesce("component", "code").alias("component")
    )
    rooted = cut_lineage(spark, rooted, "rooted")
    least = rooted.groupBy("component").agg(F.min("first").alias("least"))
    least = cut_lineage(spark, least, "least_of_component")
    found = rooted.join(least, "component").select(
        "code", F.col("least.id").alias("component_id"), F.col("least.code").alias("component_code")
    )
    return cut_lineage(spark, found, "classes")


def near_duplicates(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
                    **options: int) -> DataFrame:
    """``id_column``, ``fingerprint`` (16 hexadecimal digits) and ``component_id`` per row.

    Rows with one fingerprint are one class, and only classes are compared, so copies
    cost nothing more. Null and empty texts have fingerprint zero and link like any
    other. Null ids are the largest: a component has a null id only if all its rows
    do. Repeated rows and ids are kept. Other columns are not returned.
    """
    checked(df, id_column, text_column)
    prints = df.select(F.col(f"`{id_column}`").alias("id"),
                       fingerprint_column(F.col(f"`{text_column}`")).alias("code"))
    prints = cut_lineage(df.sparkSession, prints, "fingerprints")
    labels = classes(prints, **options).select("code", "component_id")
    digits = F.lower(F.lpad(F.hex("code"), 16, "0"))
    return prints.join(labels, "code", "left").select(
        F.col("id").alias(id_column), digits.alias("fingerprint"), "component_id"
    )


def keep_one(df: DataFrame, id_column: str = "doc_id", text_column: str = "text",
             **options: int) -> DataFrame:
    """One row of each group of near duplicates: that with the smallest id.

    All columns stay. Of rows with that id and fingerprint, the one whose columns hash
    least is kept, so reruns agree. Null ids are the largest; null and empty texts are
    one group. Texts go through Python once: rows are told apart by hashes of their
    columns, and those of the chosen rows select them.
    """
    checked(df, id_column, text_column)
    told_apart = _row_hashes(df)
    prints = df.select(F.col(f"`{id_column}`").alias("id"),
                       fingerprint_column(F.col(f"`{text_column}`")).alias("code"),
                       F.struct(*told_apart).alias("row"))
    prints = cut_lineage(df.sparkSession, prints, "fingerprints")
    kept = classes(prints, **options).where("code = component_code")
    kept = kept.select("code", F.col("component_id").alias("id"))
    same = (prints["code"] == kept["code"]) & prints["id"].eqNullSafe(kept["id"])
    counted = prints.join(kept, same, "left_semi").groupBy("code", "id", "row")
    counted = counted.agg(F.count(F.lit(1)).alias("copies"))
    rows = counted.groupBy("code", "id").agg(F.min(F.struct("row", "copies")).alias("least"))
    key = [f"{RESERVED}row{i}" for i in range(len(told_apart))]
    rows = rows.select(*(F.col(f"least.row.h{i}").alias(k) for i, k in enumerate(key)), "least.copies")
    rows = cut_lineage(df.sparkSession, rows, "kept_rows")
    marked = with_columns(df, dict(zip(key, told_apart, strict=True)))
    single, repeated = (rows.where(c).drop("copies") for c in ("copies = 1", "copies > 1"))
    found = marked.join(single, key, "left_semi")
    # Only rows that are there several times have to meet; the texts of others stay where they are.
    if not repeated.isEmpty():
        found = found.unionByName(marked.join(repeated, key, "left_semi").dropDuplicates(key))
    return found.drop(*key)


def _row_hashes(df: DataFrame) -> list[Column]:
    """Two hashes of all columns that can be hashed, and of which of them are null."""
    columns = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    nulls = F.concat(*(F.when(c.isNull(), "1").otherwise("0") for c in columns))
    return [F.xxhash64(F.lit(i), nulls, *columns).alias(f"h{i}") for i in range(2)]
