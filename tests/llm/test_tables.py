import pytest
from pyspark.sql import functions as F

from propensity.llm import tables


@pytest.mark.parametrize("n", [1, 2000, 2001, 10 ** 6, 3 * 10 ** 9, 10 ** 13, 10 ** 15])
def test_expected_sample_is_the_bound_at_any_size(n):
    share = (tables.highest_kept(2000, n) + 1 + (1 << 63)) / (1 << 64)
    assert share * n == pytest.approx(min(n, 2000), rel=1e-6)


def test_large_stratum_keeps_its_sample(spark, monkeypatch):
    """Counts stubbed as if a stratum had more than a million times the bound."""
    rows = spark.range(16_000_000).select("id", (F.col("id") % 2).alias("lang"))
    monkeypatch.setattr(tables, "_sizes", lambda *_: {0: 2_000_000 * 7, 1: 800_000 * 7})
    got = {r.lang: r["count"] for r in tables.bounded_sample(rows, F.col("id"), "lang", 7, 3).groupBy("lang").count().collect()}
    assert 1 <= got[0] <= 14 and 2 <= got[1] <= 24  # 4 and 10 expected


def test_small_strata_are_taken_whole(spark):
    rows = spark.createDataFrame([(i, "a" if i < 50 else None if i < 60 else "b") for i in range(3000)], "id int, lang string")
    got = {r.lang: r["count"] for r in tables.bounded_sample(rows, F.col("id"), "lang", 100, 3).groupBy("lang").count().collect()}
    assert got["a"] == 50 and got[None] == 10 and 60 <= got["b"] <= 140
    again = tables.bounded_sample(rows.repartition(5), F.col("id"), "lang", 100, 3).count()
    assert again == sum(got.values())
