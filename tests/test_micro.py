
import math

import duckdb
import pytest
from pyspark.ml import Pipeline
from pyspark.sql import functions as F

from propensity.functions import clean as X
from propensity.operators import features as FE
from propensity.operators import metrics as M
from propensity.operators import profile as PR
from propensity.operators.quantiles import exact_quantiles
from propensity.spec import LR_GRID, GridSpec

NAN = float("nan")


@pytest.fixture(scope="module")
def nums(spark):
    return spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,), (None,), (NAN,)], "x double")


def test_imputer_fills_lower_median(nums):
    out = FE.median_imputer(["x"]).fit(nums).transform(nums).select("x_imp").collect()
    assert [r.x_imp for r in out] == [1.0, 2.0, 3.0, 10.0, 2.0, 2.0]


def test_exact_and_lower_median(nums):
    assert exact_quantiles(nums, ["x"], [0.5])[("x", 0.5)] == 2.5
    assert exact_quantiles(nums, ["x"], [0.5], interpolation="lower")[("x", 0.5)] == 2.0
    meds = FE.fit_medians(nums, ["x"])
    assert [r.x_imp for r in FE.impute(nums, meds).collect()][-2:] == [2.5, 2.5]


def test_exact_quantiles_many_passes(spark):
    import random
    rnd = random.Random(7)
    vals = [rnd.choice([rnd.random() * 1e6, 5.0, -3.25]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [0.1, 0.5, 0.75, 0.99]
    got = exact_quantiles(df, ["x"], probs, margin=0.05, collect_limit=3)
    s = sorted(vals)
    for p in probs:
        pos = p * (len(s) - 1)
        lo, hi = math.floor(pos), math.ceil(pos)
        assert got[("x", p)] == pytest.approx(s[lo] + (pos - lo) * (s[hi] - s[lo]), rel=1e-12)


def test_all_null_column_fallback(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert FE.fit_medians(df, ["x"]) == {"x": 0.0}
    with pytest.raises(Exception):
        FE.median_imputer(["x"]).fit(df)


def test_clip_log1p(spark):
    df = spark.createDataFrame([(-2.0,), (0.0,), (None,), (NAN,)], "x double")
    out = [r.y for r in df.select(X.clip_log1p("x").alias("y")).collect()]
    assert out[:3] == [0.0, 0.0, None] and math.isnan(out[3])


def test_null_is_not_nan(nums):
    r = PR.null_profile(nums, ["x"]).first()
    assert r.n_null == 1
    assert nums.where(F.isnan("x")).count() == 1


def test_empty_table_null_pct(spark):
    df = spark.createDataFrame([], "x double")
    r = PR.null_profile(df, ["x"]).first()
    assert r.n_null == 0 and r.pct_null is None


@pytest.mark.parametrize("n_null, n, pct", [(1, 800, 0.12), (3, 800, 0.38), (107, 4000, 2.67), (4000, 4000, 100.0)])
def test_null_pct_rounds_the_binary_value(spark, n_null, n, pct):
    """1 of 800 is a true tie (0.125 %, to the even digit); 2.675 % is a double below the tie."""
    assert round(100 * n_null / n, 2) == pct
    df = spark.range(n).select(F.lit(1).alias("target"), F.when(F.col("id") >= n_null, 1.0).alias("x"))
    assert [tuple(r) for r in PR.null_profile(df, ["x"]).collect()] == [("x", n_null, pct)]
    prof = PR.profile_summary(df, "target", ["x"], ["x"])
    assert [tuple(r) for r in prof["null_profile"].collect()] == [("x", n_null, pct)]
    from propensity.plans.job import eda_document
    from propensity.spec import FeatureSpec
    assert eda_document(prof, FeatureSpec(target="target", int_cols=("x",), cat_cols=()))["null_pct"] == {"x": pct}


def test_no_registered_profile_reads_an_id_subset():
    from propensity.plans import ORACLES, QUERIES
    assert "null_profile" in QUERIES and not [n for n, sql in ORACLES.items() if "WHERE row_id <" in sql]


def test_scaler_no_centring(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    sc = FE.ColumnScaler.fit(df, ["a", "b"], ddof=1)
    assert sc.stds["a"] == pytest.approx(1.41421356, abs=1e-8)
    rows = sc.transform(df).collect()
    assert [round(r.a, 8) for r in rows] == [0.70710678, 2.12132034] and [r.b for r in rows] == [0.0, 0.0]
    pop = FE.ColumnScaler.fit(df, ["a", "b"], ddof=0).transform(df).collect()
    assert [r.b for r in pop] == [5.0, 5.0] and [r.a for r in pop] == [1.0, 3.0]
    from pyspark.ml.feature import VectorAssembler
    v = VectorAssembler(inputCols=["a", "b"], outputCol="raw_features").transform(df)
    out = FE.unit_variance_scaler().fit(v).transform(v).collect()
    assert [round(x, 8) for x in out[1].features.toArray()] == [2.12132034, 0.0]


def test_feature_hasher_fixture(spark):
    df = spark.createDataFrame([("a", "b"), ("missing", None), ("05db9164", "zz")], "c0 string, c1 string")
    got = [sorted(r.cat_features.indices.tolist()) for r in FE.feature_hasher(["c0", "c1"], 128).transform(df).collect()]
    assert got == [[44, 79], [11], [70, 81]]
    one = [r.cat_features.toArray().tolist() for r in FE.feature_hasher(["c0", "c1"], 1).transform(df).collect()]
    assert one == [[2.0], [1.0], [2.0]]


def test_sample_by_null_and_unknown_targets(spark):
    df = spark.createDataFrame([(None,), (0,), (5,)], "target int")
    from propensity.operators.split import tag_stratified_split
    df = df.withColumn("_row_id", F.monotonically_increasing_id())
    t = tag_stratified_split(df, "target", {0: 1.0, 1: 1.0}, 42, "_row_id").collect()
    assert {(r.target, r.split) for r in t} == {(None, "test"), (0, "train"), (5, "test")}
    kept = df.sampleBy("target", {0: 1.0, 1: 1.0}, 42).collect()
    assert [r.target for r in kept] == [0]


def test_explicit_schema_keeps_ids(spark, tmp_path):
    from propensity.sources.io import read_impressions
    from propensity.spec import FeatureSpec
    spec = FeatureSpec(target="target", int_cols=("n",), cat_cols=("c",))
    p = tmp_path / "t.csv"
    p.write_text("target,n,c\n1,1.5,05000000\n0,abc,12345678\nx,NaN,1e5\n")
    rows = read_impressions(spark, str(p), spec).collect()
    assert [r.c for r in rows] == ["05000000", "12345678", "1e5"]
    assert rows[1].n is None and rows[2].n is None and rows[2].target is None


def test_param_grid_order():
    assert LR_GRID.combos() == [
        {"regParam": 0.0, "elasticNetParam": 0.0}, {"regParam": 0.0, "elasticNetParam": 1.0},
        {"regParam": 0.1, "elasticNetParam": 0.0}, {"regParam": 0.1, "elasticNetParam": 1.0}]
    assert GridSpec({}).combos() == [{}]


def test_mllib_grid_matches_spec_order():
    from pyspark.ml.classification import LogisticRegression
    from propensity.operators.tuning import param_grid
    clf = LogisticRegression()
    maps = param_grid(clf, LR_GRID)
    got = [(m[clf.regParam], m[clf.elasticNetParam]) for m in maps]
    assert got == [(0.0, 0.0), (0.0, 1.0), (0.1, 0.0), (0.1, 1.0)]


def test_try_cast(spark):
    df = spark.createDataFrame([("abc",)], "s string")
    assert df.select(F.col("s").try_cast("int").alias("v")).first().v is None


def test_auc_one_class_is_zero(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.7)], "target int, score double")
    r = M.ranking_metrics(df, "target", "score").first()
    assert r.auc_roc == 0.0 and r.auc_pr == 0.0


def test_null_labels_dropped_before_fit(spark):
    from propensity.operators.models import count_null_labels, prepare_training
    df = spark.createDataFrame([(None, 1.0), (1, 2.0), (0, 3.0)], "target int, x double")
    assert count_null_labels(df, "target") == 1
    assert prepare_training(df, "target").count() == 2


def test_unknown_model_kind():
    from propensity.operators.models import make_classifier
    from propensity.plans.job import parse_models
    with pytest.raises(ValueError):
        make_classifier("svm", "target")
    assert parse_models("lr, ,gbt,") == ["lr", "gbt"]
    with pytest.raises(ValueError):
        parse_models("lr,xgb")


def test_unseen_category_at_scoring(spark):
    from propensity.operators.models import make_classifier
    train = spark.createDataFrame([("a", 1), ("b", 0), ("a", 1), ("b", 0)], "c string, target int")
    model = Pipeline(stages=FE.index_one_hot("c", "features") + [make_classifier("lr", "target", maxIter=5)]).fit(train)
    out = model.transform(spark.createDataFrame([("zzz", 0)], "c string, target int")).collect()
    assert len(out) == 1


def test_sizing():
    from propensity.session import sizing
    big = sizing(100 * 2 ** 40, 8000)
    assert int(big["spark.sql.shuffle.partitions"]) == 409600
    small = sizing(1000, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_anti_join_keeps_duplicate_rows(spark):
    from propensity.operators.split import anti_join_split, attach_row_id
    df = spark.createDataFrame([(1, "a")] * 4 + [(0, "b")] * 2, "target int, c string")
    with_id = attach_row_id(df, None, "_row_id").persist()
    train = with_id.where(F.col("_row_id") % 2 == 0)
    test = anti_join_split(with_id, train, "_row_id")
    assert train.count() + test.count() == 6
    # joining on all columns instead would drop every duplicate of a row seen in train
    assert with_id.drop("_row_id").join(train.drop("_row_id"), ["target", "c"], "left_anti").count() == 0


def test_exact_quantiles_with_infinities_wide_spans_and_ties(spark):
    import numpy as np
    inf = float("inf")
    rng = np.random.default_rng(0)
    xs = [inf, -inf, 1.5e308, -1.5e308, 0.0, 0.0, 0.0, 5e-324] + (10.0 ** rng.uniform(-300, 300, 200)).tolist() + [7.0] * 300
    df = spark.createDataFrame([(x,) for x in xs] + [(None,), (float("nan"),)], "x double").repartition(3)
    probs = [0.0, 0.1, 0.5, 0.77, 1.0]
    for kw in ({}, {"margin": 0.05, "collect_limit": 3}):
        got = exact_quantiles(df, ["x"], probs, interpolation="lower", **kw)
        ys = sorted(xs)
        assert [got[("x", p)] for p in probs] == [ys[max(int(np.ceil(p * len(ys))) - 1, 0)] for p in probs]
    two = spark.createDataFrame([(-1.5e308,), (1.5e308,)], "x double")
    assert exact_quantiles(two, ["x"], [0.5])[("x", 0.5)] == 0.0
    assert exact_quantiles(df.where("x = double('Infinity')"), ["x"], [0.5])[("x", 0.5)] == inf


def test_exact_quantiles_when_sketches_mislead(spark, monkeypatch):
    """Sketches only propose brackets: wrong ones cost a round, not the result."""
    from propensity.operators import quantiles as Q
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).cast("double").alias("x")).repartition(4)
    honest, calls = Q.sketch_quantiles, []

    def misled(*a):
        calls.append(1)
        return [[-5.0, 2.0] * (len(q) // 2) for q in honest(*a)] if len(calls) < 3 else honest(*a)
    monkeypatch.setattr(Q, "sketch_quantiles", misled)
    got = exact_quantiles(df, ["x"], [0.25, 0.5, 0.9], interpolation="lower", collect_limit=50)
    assert [got[("x", p)] for p in (0.25, 0.5, 0.9)] == [1249.0, 2499.0, 4499.0] and len(calls) >= 3


def test_first_brackets_hold_their_ranks(spark):
    from propensity.operators.quantiles import first_brackets
    df = spark.range(200_000).select(F.sqrt("id").alias("x"), F.lit(None).cast("double").alias("y"), F.lit(3.0).alias("z")).repartition(20)
    ends = first_brackets(df, ["x", "y", "z"], [0.5, 0.999])
    assert ends["y"] == [] and ends["z"] == [3.0] * 4
    a, b, c, d = (v * v / 200_000 for v in ends["x"])
    assert 0.49 < a < 0.5 < b < 0.51 and 0.99 < c < 0.999 < d <= 1.0


def test_spread_bounds_the_rows_of_a_partition(spark):
    """Enough partitions, but one of them holds every row: they are dealt out by their number."""
    from propensity import session as S
    df = spark.range(0, 48_000, 1, 16).where("id < 3000")
    assert df.rdd.getNumPartitions() == 16
    row = S.PARTITION_BYTES // 100
    for spread in (S.checkpoint_spread, S.persist_spread):
        got = spread(df, 4, row)
        sizes = [r["count"] for r in got.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert sum(sizes) == 3000 and got.distinct().count() == 3000 and max(sizes) <= 120 and got.rdd.getNumPartitions() == 30
        assert spread(df, 4).rdd.getNumPartitions() == 16 and spread(df, 20).rdd.getNumPartitions() == 20
        assert spread(df.limit(0), 4, row).count() == 0
        got.unpersist()
