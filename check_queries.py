"""Compare registered queries with their SQL in DuckDB: ``python check_queries.py [name ...]``."""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

from tidemark.catalog import ENTRIES
from tidemark.session import get_session

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return db


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    return value


def rows_of(columns: list[str], rows) -> list[str]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr(tuple(plain(row[i]) for i in order)) for row in rows)


def compare(columns, rows, sql_columns, sql_rows) -> str | None:
    """What differs, or None."""
    if sorted(columns) != sorted(sql_columns):
        return f"columns {sorted(columns)} != {sorted(sql_columns)}"
    got, want = rows_of(columns, rows), rows_of(sql_columns, sql_rows)
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(got, want):
        if a != b:
            return f"{sum(x != y for x, y in zip(got, want))} rows differ, first {a} != {b}"
    return None


def check(db, entry, df) -> tuple[str, int]:
    rows = df.collect()
    if entry.sql is None:
        return "no SQL", len(rows)
    relation = db.sql(entry.sql)
    return compare(df.columns, rows, relation.columns, relation.fetchall()) or "ok", len(rows)


def main(names: list[str]) -> int:
    folder = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = get_session("check", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": os.environ.get("CHECK_PARTITIONS", "8"), "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
    })
    spark.sparkContext.setLogLevel("ERROR")
    db = connect(folder)
    failed = 0
    for name, entry in ENTRIES.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            verdict, count = check(db, entry, entry.run(spark, folder))
        except Exception as error:  # report every query, then fail
            verdict, count = f"error {type(error).__name__}: {str(error)[:600]}", 0
        failed += verdict not in ("ok", "no SQL")
        print(f"{name:40s} {time.time() - start:6.2f}s {count:7d} rows  {verdict}", flush=True)
    return failed


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
