"""Run one query in Spark and its SQL in DuckDB and compare the rows as multisets."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def oracle(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    return tuple(value) if isinstance(value, list) else value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(row[n]) for n in names) for row in df.collect())


def oracle_rows(db, sql: str) -> tuple[list[str], Counter]:
    result = db.execute(sql)
    columns = [column[0] for column in result.description]
    order = sorted(range(len(columns)), key=columns.__getitem__)
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in result.fetchall())
    return sorted(columns), rows
