"""The shared-preprocessing search equals MLlib's CrossValidator around the
whole pipeline; GBT prefix scoring equals a shorter fit."""

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import functions as F

from propensity.fixtures import CTR_SPEC
from propensity.operators import metrics as M
from propensity.operators import models as MO
from propensity.operators import tuning as TU
from propensity.operators.clean import clean
from propensity.operators.split import assign_folds
from propensity.spec import FoldSpec, GridSpec


def test_search_equals_crossvalidator(ctr01):
    df = clean(ctr01, CTR_SPEC)
    grid = GridSpec({"regParam": [0.0, 0.1]})
    ours = TU.cross_validate(df, CTR_SPEC, "lr", grid, FoldSpec(2, 42), {"maxIter": 15}, relative_error=0.0,
                             key="row_id", dedupe=False)
    pipe = MO.build_pipeline(CTR_SPEC, "lr", relative_error=0.0, maxIter=15)
    clf = pipe.getStages()[-1]
    folded = assign_folds(df, 2, 42, "row_id", "hash", col="fold")
    ev = BinaryClassificationEvaluator(labelCol="target", metricName="areaUnderROC", numBins=0)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=TU.param_grid(clf, grid), evaluator=ev,
                        foldCol="fold", numFolds=2).fit(folded)
    assert ours.avg_metrics == pytest.approx(list(cv.avgMetrics), abs=1e-9)


def test_gbt_prefix_equals_short_fit(ctr01):
    df = clean(ctr01, CTR_SPEC).limit(3000)
    from pyspark.ml import Pipeline
    from propensity.operators.features import preprocessing_stages
    prep = Pipeline(stages=preprocessing_stages(CTR_SPEC)).fit(df)
    x = prep.transform(df).select("target", "features").persist()
    long = MO.make_classifier("gbt", "target", maxIter=6, maxDepth=3).fit(x)
    short = MO.make_classifier("gbt", "target", maxIter=3, maxDepth=3).fit(x)
    cut = TU.truncated_gbt(long, 3)
    assert cut.getNumTrees == 3
    a = cut.transform(x).select(vector_to_array("probability")[1].alias("prob")).collect()
    b = short.transform(x).select(vector_to_array("probability")[1].alias("prob")).collect()
    assert [r.prob for r in a] == pytest.approx([r.prob for r in b], abs=1e-12)


def test_dedupe_copies_equivalent_points(ctr01):
    df = clean(ctr01, CTR_SPEC)
    res = TU.cross_validate(df, CTR_SPEC, "lr", GridSpec({"regParam": [0.0], "elasticNetParam": [0.0, 1.0]}),
                            FoldSpec(2, 42), {"maxIter": 5}, key="row_id")
    assert res.avg_metrics[0] == res.avg_metrics[1]
    assert res.n_fits == 2 + 2 + 1


def test_twin_stages_match_native_operators(spark, ctr01, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    from propensity.operators import features as FE
    from propensity.operators.twin import twin_preprocessing_stages
    df = clean(ctr01, CTR_SPEC, indicators=True)
    prep = Pipeline(stages=twin_preprocessing_stages(CTR_SPEC)).fit(df)
    out = prep.transform(df)
    ints = list(CTR_SPEC.int_cols)
    meds = FE.fit_medians(df, ints)
    native = FE.impute(df, meds)
    scaler = FE.ColumnScaler.fit(native, list(CTR_SPEC.imputed_cols), ddof=0)
    want = {r.row_id: r for r in scaler.transform(native).select("row_id", *CTR_SPEC.imputed_cols).collect()}
    arr = vector_to_array("features")
    got = out.select("row_id", *[arr[i].alias(f"f{i}") for i in range(len(ints))]).collect()
    for r in got[:500]:
        for i, c in enumerate(CTR_SPEC.imputed_cols):
            assert r[f"f{i}"] == pytest.approx(want[r.row_id][c], rel=1e-9)
    hashed = FE.signed_hash_vector(df, list(CTR_SPEC.cat_cols), 128).select("row_id", "signed_features")
    a = {r.row_id: r.signed_features.toArray().tolist() for r in hashed.limit(200).collect()}
    b = {r.row_id: r.cat_features.toArray().tolist() for r in out.where(F.col("row_id").isin(list(a))).collect()}
    assert a == b
    path = str(tmp_path / "twin")
    prep.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df).select("row_id", "features").collect()
    first = {r.row_id: r.features for r in out.select("row_id", "features").collect()}
    assert all(first[r.row_id] == r.features for r in again)
