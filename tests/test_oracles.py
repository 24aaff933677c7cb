"""Every registered query against its DuckDB oracle (the driver's gate),
on the smallest tables; rows-only queries must run and return rows."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from oracle_harness import compare, duck

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF001)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con, name, QUERIES[name], ORACLES[name], SF001)
    assert r["ok"], r.get("why")
    assert not r.get("types"), r.get("types")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_query_runs(spark, name):
    assert QUERIES[name](spark, SF001).count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert [f.name for f in df.schema.fields] == ["model", "split", "metric", "value"]
    assert len(rows) == 14
