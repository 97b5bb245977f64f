"""Registered queries against their SQL, over the whole given tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry_points
from creditledger.llm import registry
from oracle import rows_of, rows_of_sql, tables

FOLDER = os.environ.get("TEXT_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def db():
    return tables(FOLDER)


def test_one_query_per_operator():
    names = [name for name in entry_points.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, len(registry.QUERIES) + 1))
    assert "pipeline" in entry_points.queries()


@pytest.mark.parametrize("name", list(registry.ORACLE_SQL))
def test_query_matches_sql(spark, db, name):
    got = rows_of(registry.QUERIES[name](spark, FOLDER))
    want = rows_of_sql(db, entry_points.oracle_sql()[name])
    assert got[0] == want[0]
    assert sum(got[1].values()) > 0
    assert got[1] == want[1]
