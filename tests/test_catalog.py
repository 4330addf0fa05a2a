"""Every named query against its SQL on the small test tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from symbolweave.catalog import ORACLES, QUERIES

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are not here")

TYPES = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for name in os.listdir(FOLDER):
        connection.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{FOLDER}/{name}')")
    return connection


def _ordered(records, picks):
    return sorted((tuple(r[p] for p in picks) for r in records), key=lambda r: tuple((v is not None, str(v)) for v in r))


def test_every_query_states_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_its_sql(spark, oracle, name):
    frame = QUERIES[name](spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    stated = oracle.execute(ORACLES[name])
    columns = [d[0] for d in stated.description]
    types = {d[0]: str(d[1]) for d in stated.description}
    assert {c: TYPES[t] for c, t in frame.dtypes} == types
    names = sorted(columns)
    expected = _ordered(stated.fetchall(), [columns.index(c) for c in names])
    assert _ordered(frame.collect(), names) == expected


def test_entry_gives_rows(spark):
    assert contract.entry(spark).count() > 0
