"""Invariants: splits partition the table, sweeps are monotone, AUC is
symmetric, forced multi-bucket ranking equals single-bucket ranking, ranks
computed in buckets equal one global row_number, save/load keeps scores."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from propensity.functions.hashing import md5_u32
from propensity.operators import metrics as M
from propensity.operators import split as SP


def test_split_disjoint_and_complete(ctr01):
    for tagged in (SP.tag_stratified_split(ctr01, "target", {0: .8, 1: .8}, 42, "row_id"),
                   SP.tag_exact_stratified_split(ctr01, "target", 0.8, 42, "row_id"),
                   SP.tag_random_split(ctr01, 0.8, 42, "row_id")):
        train, test = SP.split_parts(tagged)
        assert train.count() + test.count() == 10000
        assert train.join(test, "row_id").count() == 0


def test_seeded_split_disjoint_and_complete(ctr01):
    train, test = SP.stratified_split(ctr01, "target", 0.8, 42, "seeded", "row_id")
    a, b = train.count(), test.count()
    assert a + b == 10000 and train.join(test, "row_id").count() == 0
    assert 0.75 < a / 10000 < 0.85


def test_class_rank_matches_global_row_number(ctr01):
    got = SP.class_rank(ctr01, "target", 42, "row_id", partitions=8).select("row_id", "_rank")
    w = Window.partitionBy("target").orderBy(md5_u32("row_id", 42), "row_id")
    want = ctr01.select("row_id", (F.row_number().over(w) - 1).alias("want"))
    assert got.join(want, "row_id").where(F.col("_rank") != F.col("want")).count() == 0


def test_stratified_folds_balanced(ctr01):
    f = SP.assign_folds(ctr01, 2, 42, "row_id", target="target", stratified=True)
    counts = {(r.target, r.fold): r.n for r in f.groupBy("target", "fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert abs(counts[(0, 0)] - counts[(0, 1)]) <= 1 and abs(counts[(1, 0)] - counts[(1, 1)]) <= 1


def test_sweep_monotone(ctr01):
    rows = M.threshold_sweep(ctr01, "target", "score").orderBy("threshold").collect()
    assert rows[0].tpr == 1.0 and rows[0].fpr == 1.0
    for a, b in zip(rows, rows[1:]):
        assert b.tpr <= a.tpr and b.fpr <= a.fpr


def test_auc_symmetry_and_buckets(ctr01, monkeypatch):
    base = M.ranking_metrics(ctr01, "target", "score").first()
    neg = M.ranking_metrics(ctr01.withColumn("score", -F.col("score")), "target", "score").first()
    assert base.auc_roc + neg.auc_roc == pytest.approx(1.0, abs=1e-12)
    monkeypatch.setattr(M, "POINTS_PER_BUCKET", 7)
    many = M.ranking_metrics(ctr01, "target", "score").first()
    assert many.auc_roc == pytest.approx(base.auc_roc, abs=1e-15)
    assert many.auc_pr == pytest.approx(base.auc_pr, abs=1e-12)
    assert many.avg_precision == pytest.approx(base.avg_precision, abs=1e-12)
    a = M.roc_curve(ctr01, "target", "score", drop_collinear=True).collect()
    monkeypatch.setattr(M, "POINTS_PER_BUCKET", 200000)
    b = M.roc_curve(ctr01, "target", "score", drop_collinear=True).collect()
    assert sorted(map(tuple, a), key=str) == sorted(map(tuple, b), key=str)


def test_auc_matches_mllib_evaluator(ctr01):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = ctr01.select(F.col("target").cast("double").alias("label"), F.col("score").alias("raw"))
    for metric, col in (("areaUnderROC", "auc_roc"), ("areaUnderPR", "auc_pr")):
        ev = BinaryClassificationEvaluator(labelCol="label", rawPredictionCol="raw", metricName=metric, numBins=0)
        ours = M.ranking_metrics(ctr01, "target", "score").first()[col]
        assert ours == pytest.approx(ev.evaluate(df), abs=1e-12)


def test_weighted_recall_equals_accuracy(ctr01):
    scored = ctr01.withColumn("prediction", (F.col("score") >= 0.4).cast("double"))
    r = M.weighted_metrics(M.confusion_matrix(scored, "target"), "target").first()
    assert r.weighted_recall == pytest.approx(r.accuracy, abs=1e-15)


def test_weighted_metrics_match_mllib(ctr01):
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    scored = ctr01.withColumn("prediction", (F.col("score") >= 0.4).cast("double")) \
                  .withColumn("label", F.col("target").cast("double"))
    r = M.weighted_metrics(M.confusion_matrix(scored, "target"), "target").first()
    for name, col in (("accuracy", "accuracy"), ("f1", "f1"), ("weightedPrecision", "weighted_precision")):
        ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction", metricName=name)
        assert r[col] == pytest.approx(ev.evaluate(scored), abs=1e-12)


def test_hashed_row_sum_is_token_count(ctr01):
    from pyspark.ml.functions import vector_to_array
    from propensity.operators.features import feature_hasher
    cats = ["cat_0", "cat_1", "cat_2", "cat_3"]
    out = feature_hasher(cats, 16).transform(ctr01)
    s = F.aggregate(vector_to_array("cat_features"), F.lit(0.0), lambda a, x: a + x)
    n = sum(F.col(c).isNotNull().cast("double") for c in cats)
    assert out.where(s != n).count() == 0


def test_importances_sum_to_one_and_topk_ties(spark, ctr01):
    from propensity.fixtures import CTR_SPEC
    from propensity.operators import models as MO
    from propensity.operators.clean import clean
    from propensity.operators.report import top_importances
    df = clean(ctr01, CTR_SPEC)
    model = MO.fit(MO.build_pipeline(CTR_SPEC, "rf", numTrees=3, maxDepth=3), df, "target")
    imp = model.stages[-1].featureImportances.toArray()
    assert imp.sum() == pytest.approx(1.0, abs=1e-9)
    names = MO.feature_names(model, df)
    assert names[0] == "int_0_imp" and len(names) == 4 + 128
    t = top_importances(spark, [0.1, 0.3, 0.3, 0.0, 0.3], None, 3).collect()
    assert [r.idx for r in t] == [1, 2, 4]


def test_save_load_same_scores(spark, ctr01, tmp_path):
    from propensity.fixtures import CTR_SPEC
    from propensity.operators import models as MO
    from propensity.sources import io
    model = MO.fit(MO.build_pipeline(CTR_SPEC, "lr", maxIter=10), ctr01, "target")
    path = io.save_model(model, str(tmp_path / "m"))
    a = M.ranking_metrics(MO.score(model, ctr01, "target"), "target", "prob").first().auc_roc
    b = M.ranking_metrics(MO.score(io.load_model(path), ctr01, "target"), "target", "prob").first().auc_roc
    assert a == b


def test_fused_evaluate_matches_separate_operators(ctr01):
    scored = ctr01.select("target", "score", (F.col("score") >= 0.45).cast("double").alias("prediction"),
                          F.when(F.col("row_id") % 3 == 0, "a").otherwise("b").alias("g"))
    ev = M.evaluate(scored, "target", "score", "prediction", ["g"])
    conf = M.confusion_matrix(scored, "target", "prediction", ["g"])
    a = sorted(map(tuple, ev["confusion"].collect()))
    b = sorted(map(tuple, conf.select("g", "target", "prediction", "n").collect()))
    assert a == b
    wa = {r.g: r for r in ev["weighted"].collect()}
    for r in M.weighted_metrics(conf, "target", ["g"]).collect():
        for k in ("accuracy", "weighted_precision", "weighted_recall", "f1"):
            assert wa[r.g][k] == pytest.approx(r[k], abs=1e-12)
    sa = sorted(map(tuple, ev["sweep"].collect()))
    sb = sorted(map(tuple, M.threshold_sweep(scored, "target", "score", groups=["g"]).collect()))
    assert sa == sb
    ra = {r.g: r for r in ev["ranking"].collect()}
    for r in M.ranking_metrics(scored, "target", "score", ["g"]).collect():
        assert ra[r.g].auc_roc == r.auc_roc and ra[r.g].auc_pr == pytest.approx(r.auc_pr, abs=1e-12)


def test_score_saved_helper(spark, ctr01, tmp_path):
    from propensity.fixtures import CTR_SPEC
    from propensity.operators import models as MO
    from propensity.sources import io
    model = MO.fit(MO.build_pipeline(CTR_SPEC, "lr", maxIter=5), ctr01, "target")
    path = io.save_model(model, str(tmp_path / "m"))
    a = io.score_saved(path, ctr01).select("row_id", "prediction").orderBy("row_id").limit(50).collect()
    b = model.transform(ctr01).select("row_id", "prediction").orderBy("row_id").limit(50).collect()
    assert a == b
