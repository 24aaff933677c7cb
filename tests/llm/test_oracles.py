import pytest
from oracle_harness import compare, duck

from propensity.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    sf = "/root/testdata/sf0.01"
    r = compare(spark, duck(sf), name, QUERIES[name], ORACLES[name], sf)
    assert r["ok"], r
