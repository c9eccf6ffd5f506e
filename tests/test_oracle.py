"""Every registered query against its SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from siltstone.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="no test tables here")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def plain(value):
    return float(value) if type(value).__name__ == "Decimal" else value


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sql, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    got = sorted(repr([plain(r[c]) for c in columns]) for r in found.collect())
    if name not in ORACLES:
        assert got
        return
    cursor = sql.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = sorted(repr([plain(r[i]) for i in order]) for r in cursor.fetchall())
    assert got == want


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 19
    assert {"PASS", "FAIL"} == {r["status"] for r in rows}
