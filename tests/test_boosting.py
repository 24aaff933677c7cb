"""The boosted trees grown from compact rows are MLlib's; a forest's upper
levels are a shallower forest."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, SparseVector, VectorUDT
from pyspark.sql import functions as F

from propensity.operators import boosting as B
from propensity.operators import models as MO
from propensity.operators import tuning as TU
from propensity.spec import FeatureSpec, FoldSpec, GridSpec


def rows(spark, n, values):
    """Label and twelve columns: ten mostly zero, one dense and negative, one constant."""
    cols = [F.when(F.xxhash64("id", F.lit(c)) % 5 == 0, F.pmod(F.xxhash64("id", F.lit(-c)), F.lit(values)) + 1.0).otherwise(0.0).alias(f"f{c}") for c in range(1, 11)]
    df = spark.range(n).select("id", *cols, (F.pmod(F.xxhash64("id", F.lit(99)), F.lit(values)) - 2.5).alias("f11"), F.lit(3.0).alias("f12"))
    y = (F.col("f11") + 2 * F.col("f1") - 3 * F.col("f2") * F.col("f11") + F.pmod(F.xxhash64("id", F.lit(7)), F.lit(60)) / 10 > 2).cast("int")
    return df.withColumn("target", y).repartition(3, "id").persist()


def assembled(df):
    return Pipeline(stages=[VectorAssembler(inputCols=[f"f{i}" for i in range(1, 13)], outputCol="features")]).fit(df)


def probabilities(model, data):
    return np.array([r[0] for r in model.transform(data).orderBy("id").select(vector_to_array("probability")[1]).collect()])


# sums are added in another order than MLlib's, so exact ties, as in nodes of few rows, may be decided otherwise
@pytest.mark.parametrize("n, values", [(2000, 5), (8000, 40), (15000, 5)])
def test_trees_are_mllibs(spark, tmp_path, n, values):
    df = rows(spark, n, values)
    prep = assembled(df)
    clf = MO.make_classifier("gbt", "target", maxIter=11, maxDepth=3)
    data = prep.transform(df)
    ours, theirs = B.fit_boosted(clf, df, prep), clf.fit(data)
    assert probabilities(ours, data) == pytest.approx(probabilities(theirs, data), abs=1e-9)
    assert ours.featureImportances.toArray() == pytest.approx(theirs.featureImportances.toArray(), abs=1e-9)
    assert (ours.getNumTrees, ours.numFeatures, ours.getLabelCol()) == (11, 12, "target")
    ours.write().overwrite().save(str(tmp_path / "m"))
    assert probabilities(GBTClassificationModel.load(str(tmp_path / "m")), data) == pytest.approx(probabilities(ours, data), abs=1e-12)


def test_a_row_keeps_its_entries_only(spark, monkeypatch):
    """Of 1,000 hashed slots a row with three values keeps three small integers, and MLlib's learner is not called."""
    df = spark.range(3000).select("id", (F.col("id") % 3 == 0).cast("int").alias("target"), *[
        F.concat(F.lit(f"{c}"), F.xxhash64("id", F.lit(c)) % 50).alias(f"c{c}") for c in range(3)]).persist()
    from propensity.operators.features import feature_hasher
    prep = Pipeline(stages=[feature_hasher(["c0", "c1", "c2"], 1000, "features")]).fit(df)
    monkeypatch.setattr(MO.GBTClassifier, "_fit", lambda *a: pytest.fail("all slots of all rows kept"))
    sizes = []
    coded = B.coded_blocks
    monkeypatch.setattr(B, "coded_blocks", lambda *a: (b := coded(*a), sizes.extend(b.map(lambda x: x[0].nbytes / x[0].shape[1]).collect()))[0])
    model = B.fit_boosted(MO.make_classifier("gbt", "target", maxIter=2, maxDepth=2), df, prep)
    assert model.getNumTrees == 2 and max(sizes) <= 3 * 2


def test_vectors_of_both_forms(spark):
    """Dense, sparse, all-zero and negative vectors give the same codes as a dense count of bins."""
    vectors = [DenseVector([0.0, -1.0, 2.0]), SparseVector(3, [1, 2], [4.0, 0.0]), SparseVector(3, [], []), DenseVector([9.0, 0.0, 0.0])]
    from pyspark.sql import types as T
    df = spark.createDataFrame([(float(i % 2), v) for i, v in enumerate(vectors)], T.StructType([T.StructField("y", T.DoubleType()), T.StructField("x", VectorUDT())])).coalesce(1)
    bins = B.Bins([np.array([1.0]), np.array([-0.5, 3.0]), np.empty(0)])
    (codes, y, margin), = B.coded_blocks(df, "y", "x", bins).collect()
    assert [sorted(c for c in row if c < bins.size) for row in codes.T.tolist()] == [[2], [4], [], [1]]
    assert y.tolist() == [-1, 1, -1, 1] and not margin.any()


def test_other_parameters_and_labels(spark):
    df = rows(spark, 600, 5)
    prep = assembled(df)
    data = prep.transform(df)
    for params in ({"minInstancesPerNode": 50}, {"subsamplingRate": 0.5}):  # left to MLlib
        clf = MO.make_classifier("gbt", "target", maxIter=2, maxDepth=2, **params)
        assert probabilities(B.fit_boosted(clf, df, prep), data) == pytest.approx(probabilities(clf.fit(data), data), abs=1e-9)
    clf = MO.make_classifier("gbt", "target", maxIter=2, maxDepth=2)
    one = df.withColumn("target", F.lit(1))
    assert probabilities(B.fit_boosted(clf, one, prep), data) == pytest.approx(probabilities(clf.fit(prep.transform(one)), data), abs=1e-9)
    with pytest.raises(Exception, match="labels 0 and 1"):
        B.fit_boosted(clf, df.withColumn("target", F.lit(2)), prep)
    with pytest.raises(Exception):
        B.fit_boosted(clf, df.where("false"), prep)


def test_shallow_forest_is_the_top_of_a_deep_one(spark):
    df = rows(spark, 3000, 5)
    data = assembled(df).transform(df).persist()
    deep, shallow = (MO.make_classifier("rf", "target", numTrees=7, maxDepth=d).fit(data) for d in (8, 3))
    cut = TU.truncated_forest(deep, 3)
    assert cut.toDebugString.split("\n")[1:] == shallow.toDebugString.split("\n")[1:]
    assert (probabilities(cut, data) == probabilities(shallow, data)).all()


def test_search_fits_a_forest_grid_over_depths_once(spark):
    df = rows(spark, 1500, 5)
    spec = FeatureSpec(target="target", int_cols=tuple(f"f{i}" for i in range(1, 12)), cat_cols=(), id_col="id")
    grid = GridSpec({"maxDepth": [2, 6], "numTrees": [5]})
    once, each = (TU.cross_validate(df, spec, "rf", grid, FoldSpec(2, 42), {"seed": 42}, key="id", dedupe=d) for d in (True, False))
    assert once.avg_metrics == pytest.approx(each.avg_metrics, abs=1e-12) and once.best_params == each.best_params
    assert (once.n_fits, each.n_fits) == (2 + 2 + 1, 2 + 4 + 1)
    assert not TU._whole_levels(20, 1000, {}) and TU._whole_levels(5, 132, {"numTrees": 50})


def test_package_is_shipped_once_by_threads():
    """Both folds' threads ship the package; a file added twice is refused by Spark."""
    import time
    from concurrent.futures import ThreadPoolExecutor
    from types import SimpleNamespace
    from propensity.session import ship_package
    added = []
    fake = SimpleNamespace(sparkContext=SimpleNamespace(applicationId=f"fake-{id(added)}", addPyFile=lambda f: (time.sleep(0.2), added.append(f))))
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(ship_package, [fake] * 4))
    assert len(added) == 1
