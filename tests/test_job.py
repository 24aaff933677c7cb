"""The end-to-end job on a CSV written from the fixture view."""

import json
import os

from propensity.fixtures import CTR_SPEC, ctr_frame
from propensity.plans.job import JobConfig, run_job
from propensity.spec import GridSpec
from conftest import SF001


def test_job_writes_reports(spark, tmp_path):
    src = str(tmp_path / "in")
    ctr_frame(spark, SF001).drop("score").write.option("header", True).csv(src)
    out = str(tmp_path / "out")
    cfg = JobConfig(output=out, input=src, spec=CTR_SPEC, models=("lr", "gbt"),
                    grids={"lr": GridSpec({"regParam": [0.0, 0.1]}), "gbt": GridSpec({"maxIter": [2, 3]})},
                    params={"lr": {"maxIter": 10}, "gbt": {"maxDepth": 2}})
    res = run_job(spark, cfg)
    for kind in ("lr", "gbt"):
        doc = res["models"][kind]["doc"]
        assert set(doc["test_metrics"]) == {"AUC_ROC", "AUC_PR", "Accuracy", "F1", "Weighted_Precision",
                                            "Weighted_Recall"}
        assert len(doc["roc_points"]) == 11 and len(doc["cv_avg_auc_by_param_combo"]) == 2
        assert os.path.exists(os.path.join(out, f"{kind}_best_pipeline", "metadata"))
        text = spark.read.text(os.path.join(out, f"metrics_{kind}")).collect()
        assert json.loads("\n".join(r.value for r in text))["fit_time_sec"] >= 0
    assert "top_20_feature_importance_indices" in res["models"]["gbt"]["doc"]
    eda = json.loads("\n".join(r.value for r in spark.read.text(os.path.join(out, "eda_summary")).collect()))
    assert eda["n_rows"] == 1000 and eda["n_features"] == 8 and eda["null_counts"]["int_0"] == 429
    rep = spark.read.json(os.path.join(out, "report"))
    assert rep.select("model").distinct().count() == 2
    from propensity.sources.io import read_metrics
    assert read_metrics(spark, os.path.join(out, "report"), ["lr", "rf"]).select("model").distinct().count() == 1


def test_presets_and_c_conversion(spark, tmp_path):
    from propensity.plans.job import preset
    from propensity.spec import c_to_reg_param
    assert c_to_reg_param(10, 800_000) == 1.0 / 8_000_000
    legacy = preset("legacy", str(tmp_path))
    assert legacy.spec.num_hash_features == 16384 and legacy.models == ("lr", "rf")
    assert not legacy.split.stratified and legacy.params["lr"]["maxIter"] == 50
    twin = preset("twin", str(tmp_path))
    assert twin.indicators and twin.split.exact and twin.folds.stratified
    assert "intCol_1" in twin.spec.skewed and twin.grids["lr"].params["C"] == [1e6, 10.0]
    assert twin.params["lr"] == {"maxIter": 300, "tol": 1e-3}


def test_twin_preset_runs_on_fixture(spark, tmp_path):
    from propensity.plans.job import preset, run_job
    from propensity.spec import GridSpec
    cfg = preset("twin", str(tmp_path / "out"), spec=CTR_SPEC, models=("lr",),
                 grids={"lr": GridSpec({"regParam": [0.0]})}, params={"lr": {"maxIter": 5}})
    res = run_job(spark, cfg, df=ctr_frame(spark, SF001).drop("score"))
    doc = res["models"]["lr"]["doc"]
    assert 0.0 <= doc["test_metrics"]["AUC_ROC"] <= 1.0 and "roc_points" not in doc
    from propensity.operators import report as RP
    from propensity.sources import io
    docs = io.read_metrics_documents(spark, str(tmp_path / "out"))
    series = RP.stored_roc_series(docs).collect()
    curve = list(io.stream_sorted(spark, doc["roc_curve"], ["fpr", "tpr"]))
    assert len(series) == len(curve) > 11 and {r.model for r in series} == {"lr"}
    assert (curve[0].fpr, curve[0].tpr, curve[-1].fpr, curve[-1].tpr) == (0.0, 0.0, 1.0, 1.0)


def test_job_without_row_key_and_sampled(spark, tmp_path):
    from propensity.plans.job import run_job
    spec = CTR_SPEC.with_(id_col=None)
    df = ctr_frame(spark, SF001).drop("score", "row_id")
    cfg = JobConfig(output=str(tmp_path / "o"), spec=spec, models=("lr",), sample_frac=0.5,
                    grids={"lr": GridSpec({"regParam": [0.0]})}, params={"lr": {"maxIter": 5}})
    res = run_job(spark, cfg, df=df)
    n = res["profile"]["shape"].first().n_rows
    assert 350 < n < 650
    assert res["models"]["lr"]["doc"]["test_metrics"]["Accuracy"] > 0


def test_job_writes_tables(spark, tmp_path):
    from propensity.plans.job import run_job
    out = str(tmp_path / "o")
    cfg = JobConfig(output=out, spec=CTR_SPEC, models=("gbt",), grids={"gbt": GridSpec({"maxIter": [2]})},
                    params={"gbt": {"maxDepth": 2}})
    run_job(spark, cfg, df=ctr_frame(spark, SF001).drop("score"))
    for t in ("report", "confusion", "roc_points", "cv", "importances"):
        assert spark.read.json(os.path.join(out, t)).where("model = 'gbt'").count() > 0
    imp = spark.read.json(os.path.join(out, "importances"))
    assert abs(imp.agg({"importance": "sum"}).first()[0] - 1.0) < 1e-9
