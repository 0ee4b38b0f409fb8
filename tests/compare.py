"""Run queries and their SQL forms side by side and compare all values."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(columns), sorted(plain, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def difference(spark, con, query, sql, sf_dir):
    """None when equal, else a short description."""
    df = query(spark, sf_dir)
    got_columns, got = sorted_rows(df.columns, df.collect())
    result = con.sql(sql)
    want_columns, want = sorted_rows(result.columns, result.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{a} != {b}"
    kinds = {n.lower(): t for n, t in df.dtypes}
    for name, kind in zip(result.columns, result.types):
        same = {
            "bigint": "BIGINT",
            "int": "INTEGER",
            "double": "DOUBLE",
            "float": "FLOAT",
            "string": "VARCHAR",
            "boolean": "BOOLEAN",
        }
        if str(kind) != same[kinds[name.lower()]]:
            return f"type of {name}: {kinds[name.lower()]} != {kind}"
    return None


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry
    from pyspark.sql import SparkSession

    sf_dir = sys.argv[1]
    spark = SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
    spark = spark.config("spark.sql.shuffle.partitions", "8").getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    sql = entry.oracle_sql()
    for name, query in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            found = difference(spark, con, query, sql[name], sf_dir)
        except Exception as error:
            found = f"{type(error).__name__}: {str(error)[:600]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.1f}s {found or ''}"[:900], flush=True)
