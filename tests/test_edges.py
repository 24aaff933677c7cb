
import pytest
from pyspark.sql import functions as F

from propensity.operators import metrics as M
from propensity.operators import profile as PR
from propensity.operators import split as SP

SCHEMA = "row_id bigint, target int, x double, c string, score double"


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def with_nulls(spark):
    rows = [(i, (None if i % 7 == 0 else i % 2), float(i) if i % 3 else None, None if i % 5 == 0 else "v",
             (i * 37 % 11) / 11.0) for i in range(60)]
    return spark.createDataFrame(rows, SCHEMA)


def test_empty_profile(empty):
    out = PR.profile_summary(empty, "target", ["x", "c"], ["x"])
    assert out["shape"].first().n_rows == 0
    assert out["positive_rate"].first().positive_rate == -1.0
    assert [r.pct_null for r in out["null_profile"].collect()] == [None, None]
    assert PR.numeric_profile(empty, ["x"]).first().median is None
    assert PR.class_balance(empty, "target").count() == 0


def test_empty_split_and_rank(empty):
    assert SP.tag_exact_stratified_split(empty, "target", 0.8, 42, "row_id").count() == 0
    assert SP.class_rank(empty, "target", 42, "row_id").count() == 0


def test_empty_metrics(empty):
    assert M.ranking_metrics(empty, "target", "score").count() == 0
    ev = M.evaluate(empty.withColumn("prediction", F.lit(0.0)), "target", "score")
    assert ev["report"].count() == 0 and ev["sweep"].count() == 0
    assert M.threshold_sweep(empty, "target", "score").count() == 11


def test_null_targets_go_to_test(with_nulls):
    t = SP.tag_exact_stratified_split(with_nulls, "target", 0.8, 42, "row_id")
    assert t.where("target IS NULL AND split = 'train'").count() == 0
    assert t.count() == 60
    for cls in (0, 1):
        n = with_nulls.where(F.col("target") == cls).count()
        assert t.where((F.col("target") == cls) & (F.col("split") == "train")).count() == int(0.8 * n + 0.5)


def test_null_targets_ignored_by_ranking(with_nulls):
    a = M.ranking_metrics(with_nulls, "target", "score").first()
    b = M.ranking_metrics(with_nulls.where("target IS NOT NULL"), "target", "score").first()
    assert a.auc_roc == b.auc_roc and a.n_pos + a.n_neg == 51  # 9 of 60 targets are null


def test_one_class_everywhere(spark):
    df = spark.createDataFrame([(i, 1, i / 10.0) for i in range(10)], "row_id bigint, target int, score double")
    r = M.ranking_metrics(df, "target", "score").first()
    assert r.auc_roc == 0.0 and r.n_neg == 0
    ev = M.evaluate(df.withColumn("prediction", (F.col("score") >= 0.5).cast("double")), "target", "score")
    w = ev["weighted"].first()
    assert w.accuracy == 0.5 and w.weighted_recall == 0.5
    assert all(r.fpr == 0.0 for r in ev["sweep"].collect())


def test_all_null_column_numeric_profile(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    r = PR.numeric_profile(df, ["x"]).first()
    assert r.n == 0 and r.median is None and r.mean is None


def test_nan_and_null_scores_with_buckets(spark, monkeypatch):
    import random
    rnd = random.Random(3)
    rows = [(rnd.randint(0, 1), rnd.choice([rnd.random(), float("nan"), None, 0.5])) for _ in range(400)]
    df = spark.createDataFrame(rows, "target int, score double")
    base = M.ranking_metrics(df, "target", "score").first()
    monkeypatch.setattr(M, "POINTS_PER_BUCKET", 5)
    many = M.ranking_metrics(df, "target", "score").first()
    assert many.auc_roc == base.auc_roc
    assert many.n_pos + many.n_neg == sum(1 for t, s in rows if s is not None)


def test_positive_rate_by_value_with_null_targets(with_nulls):
    r = PR.positive_rate(with_nulls, "target").first()
    assert r.n_pos == with_nulls.where("target = 1").count()
    assert r.positive_rate == pytest.approx(r.n_pos / 60)


def test_importance_error_recorded_not_raised(spark):
    from propensity.operators import models as MO
    from pyspark.ml.feature import VectorAssembler
    df = spark.createDataFrame([(0, 1.0), (1, 2.0), (0, 0.5), (1, 3.0)], "target int, x double")
    x = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    from pyspark.ml import PipelineModel
    model = PipelineModel([MO.make_classifier("lr", "target", maxIter=5).fit(x)])
    r = MO.feature_importances(spark, model, model_name="lr").collect()
    assert len(r) == 1 and r[0].error


def test_fused_class_balance(with_nulls, spark):
    fused = PR.profile_summary(with_nulls, "target", ["x"])["class_balance"]
    direct = PR.class_balance(with_nulls, "target")
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, fused.collect()), key=key) == sorted(map(tuple, direct.collect()), key=key)
    other = spark.createDataFrame([(0,), (2,), (2,)], "target int")
    got = {r.target: r.n for r in PR.profile_summary(other, "target", [])["class_balance"].collect()}
    assert got == {0: 1, 2: 2}
