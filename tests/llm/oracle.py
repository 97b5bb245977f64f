"""Rows of Spark and of DuckDB in a form that can be compared."""

from __future__ import annotations

from collections import Counter

import duckdb

TABLES = ("documents", "benchmark", "labels", "pages", "conversations", "embeddings")


def tables(folder: str):
    db = duckdb.connect()
    for table in TABLES:
        db.execute(f"create view {table} as select * from '{folder}/{table}.parquet'")
    return db


def rows_of_sql(db, sql: str):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(row[i] for i in order) for row in result.fetchall())


def rows_of(df):
    names = sorted(df.columns)
    return names, Counter(tuple(row) for row in df.select(*names).collect())
