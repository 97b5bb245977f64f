"""Every registered query against its SQL, over the whole given tables."""

from __future__ import annotations

import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_points
from creditledger import Graduation
from creditledger.sources import derived
from ledger_oracle.ledger_sql import expected

FOLDER = os.environ.get("LEDGER_SF_DIR", "/root/testdata/sf0.01")
QUERIES = {name: entry_points.queries()[name] for name in entry_points.QUERIES}


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in ("customer", "orders", "lineitem"):
        connection.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return connection


def rows_of(db, sql: str):
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), Counter(tuple(r[i] for i in order) for r in result.fetchall())


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, Counter(tuple(r) for r in df.select(*names).collect())


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_sql(spark, db, name):
    got = rows_of_spark(QUERIES[name](spark, FOLDER))
    want = rows_of(db, entry_points.oracle_sql()[name])
    assert got[0] == want[0]
    assert sum(got[1].values()) > 0
    assert got[1] == want[1]


def test_second_half_of_the_year(spark, db):
    steps = Graduation(derived.inputs(spark, FOLDER), derived.YEAR, 1)
    sql = expected(mid_year=1)
    final = steps.final_of(steps.graded_table)
    assert rows_of_spark(final) == rows_of(db, sql["final_status"])
    codes = steps.graded_table.select("studentID", "subject", "subjOnTrack")
    assert rows_of_spark(codes) == rows_of(db, sql["subject_status"])


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
