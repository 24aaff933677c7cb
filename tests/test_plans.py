"""Physical-plan checks: the null profile is one aggregate job, no Python
evaluation anywhere, column pruning reaches the parquet scan."""

import pytest

import __spark_entry__ as E
from conftest import SF001
from propensity.fixtures import ctr_frame
from propensity.operators import profile as PR

CHEAP = ["null_profile", "class_balance", "rate_by_missing", "split_stratified_hash", "split_stratified_exact",
         "folds_stratified", "threshold_sweep", "confusion_matrix", "train_test_report", "hash_features_signed_vector",
         "clean_engineer", "feature_hasher_invariants", "assemble_features"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHEAP)
def test_no_python_in_plan(spark, name):
    p = plan(E.queries()[name](spark, SF001))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_null_profile_single_aggregate(spark):
    p = plan(PR.null_profile(ctr_frame(spark, SF001), ["int_0", "int_3", "cat_2"]))
    assert p.count("HashAggregate") <= 2  # partial + final of one aggregate
    assert "Window" not in p


def test_scan_is_pruned(spark):
    import re
    df = ctr_frame(spark, SF001).select("row_id", "int_0")
    p = plan(df)
    schemas = re.findall(r"ReadSchema: (struct<[^>]*>)", p)
    assert schemas, p
    assert all("props" not in s and "c_mktsegment" not in s and "event_type" not in s for s in schemas)


def test_broadcast_only_under_bound(spark):
    from pyspark.sql import functions as F
    from propensity.session import broadcast_if_bounded
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(1000).withColumn("k", F.col("id") % 10)
        small = spark.range(10).withColumnRenamed("id", "k")
        hinted = big.join(broadcast_if_bounded(small, 100, bound=10), "k")
        plain = big.join(broadcast_if_bounded(small, 5, bound=10), "k")
        assert "BroadcastHashJoin" in plan(hinted)
        assert "BroadcastHashJoin" not in plan(plain)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sketches_are_merged_in_groups(spark):
    """No task reads all partitions' sketches: of 60 partitions in 8 groups, at most 8 a group."""
    from pyspark.sql import functions as F
    from propensity.operators import quantiles as Q
    df = spark.range(6000, numPartitions=60).select(F.col("id").cast("double").alias("x"))
    merged = Q.merged_sketches(df, [F.col("x")], groups=8)
    p = plan(merged)
    assert p.count("Exchange") == 2 and p.count("kll_merge_agg_double") == 2 and p.count("kll_sketch_agg_double") == 2
    per_group = df.groupBy((F.spark_partition_id() % 8).alias("g")).agg(F.count_distinct(F.spark_partition_id()).alias("n")).collect()
    assert len(per_group) == 8 and max(r.n for r in per_group) <= 8
    n, q = merged.select(F.kll_sketch_get_n_double("s0"), F.kll_sketch_get_quantile_double("s0", F.lit(0.5))).first()
    assert n == 6000 and abs(q - 3000) < 30
    assert Q.GROUPS <= 700


def test_class_rank_reads_its_source_once(spark, monkeypatch):
    """One scan of events goes into the written table; ranks are worked out from that."""
    from propensity.operators import split as SP
    written = []
    keep = SP.cut_lineage
    monkeypatch.setattr(SP, "cut_lineage", lambda df: (written.append(plan(df)), keep(df))[1])
    out = SP.assign_folds(ctr_frame(spark, SF001), 2, 42, "row_id", target="target", stratified=True)
    scans = [p.count("events.parquet") for p in written]
    assert scans == [1] and "events.parquet" not in plan(out) and "BroadcastHashJoin" in plan(out)
    assert out.groupBy("target", "fold").count().count() == 4


def test_sorted_table_streams_a_long_curve(spark, tmp_path):
    """A curve of 1e6 distinct scores is written and read in order by range, never collected whole."""
    from pyspark.sql import functions as F
    from propensity.operators import metrics as M
    from propensity.sources import io
    n = 1_000_000
    scored = spark.range(n).select((F.col("id") / n).alias("prob"), (F.xxhash64("id") % 3 == 0).cast("int").alias("target"))
    path = io.write_sorted(M.roc_curve(scored, "target", "prob"), str(tmp_path / "curve"), ["fpr", "tpr"])
    table = spark.read.parquet(path)
    assert table.count() == n + 1
    ranges = sorted((tuple(r.lo), tuple(r.hi)) for r in table.groupBy(F.input_file_name()).agg(
        F.min(F.struct("fpr", "tpr")).alias("lo"), F.max(F.struct("fpr", "tpr")).alias("hi")).collect())
    assert len(ranges) > 1 and all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    import itertools
    rows = [(r.fpr, r.tpr) for r in itertools.islice(io.stream_sorted(spark, path, ["fpr", "tpr"]), 2000)]
    assert rows[0] == (0.0, 0.0) and rows == sorted(rows) and len(rows) == 2000


def test_signed_vector_memory_follows_its_entries(spark):
    """2^24 buckets: a dense row would be 128 MB."""
    from pyspark.ml.linalg import SparseVector
    from propensity.operators import features as FE
    df = FE.signed_hash_vector(ctr_frame(spark, SF001), ["cat_0", "cat_1", "cat_3"], 1 << 24)
    v = df.select("signed_features").first()[0]
    assert isinstance(v, SparseVector) and v.size == 1 << 24 and v.numNonzeros() <= 3
    assert df.schema["signed_features"].metadata["ml_attr"]["num_attrs"] == 1 << 24
    p = plan(df)
    assert "Exchange hashpartitioning" not in p and "Python" not in p
