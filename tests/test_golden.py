"""The reference's committed confusion matrices reproduce its committed
metrics (accuracy = weighted recall, weighted precision, weighted F1, and
the sweep row at 0.5)."""

import pytest

from propensity.operators import metrics as M

# fixed values: committed confusion matrices and metrics of the reference run
GOLDEN = {
    "gbt": ((141710, 39179, 7269, 11555), 0.7674262566783334, 0.740333349489783, 0.7253282948384063,
            0.22775653407970986, 0.04879211163989555),
    "lr": ((141723, 40326, 7256, 10408), 0.7617481085357488, 0.7304078045516464, 0.7160522588585869,
           0.20514842117711987, 0.048704851019271175),
    "rf": ((146189, 44938, 2790, 5796), 0.7610170594803544, 0.7420598320436084, 0.690924181818037,
           0.11424291402215477, 0.018727471657079185),
}


@pytest.mark.parametrize("model", sorted(GOLDEN))
def test_weighted_metrics_from_committed_matrix(spark, model):
    (n00, n10, n01, n11), acc, wp, f1, tpr, fpr = GOLDEN[model]
    conf = spark.createDataFrame([(0, 0.0, n00), (1, 0.0, n10), (0, 1.0, n01), (1, 1.0, n11)],
                                 "target int, prediction double, n bigint")
    r = M.weighted_metrics(conf, "target").first()
    assert r.accuracy == pytest.approx(acc, abs=1e-12)
    assert r.weighted_recall == pytest.approx(acc, abs=1e-12)
    assert r.weighted_precision == pytest.approx(wp, abs=1e-12)
    assert r.f1 == pytest.approx(f1, abs=1e-12)
    assert n11 / (n11 + n10) == pytest.approx(tpr, abs=1e-15)
    assert n01 / (n01 + n00) == pytest.approx(fpr, abs=1e-15)


def test_never_predicted_class_has_zero_precision(spark):
    conf = spark.createDataFrame([(0, 0.0, 8), (1, 0.0, 2)], "target int, prediction double, n bigint")
    r = M.weighted_metrics(conf, "target").first()
    assert r.accuracy == 0.8 and r.weighted_precision == pytest.approx(0.8 * 0.8)


def test_stored_documents_of_every_layout(spark, tmp_path):
    import json

    from propensity.operators import report as RP
    from propensity.sources import io
    (n00, n10, n01, n11), acc, _wp, f1, _tpr, _fpr = GOLDEN["gbt"]
    nested = {"test_metrics": {"AUC_ROC": 0.7392066589477656, "AUC_PR": 0.5026847030514175, "Accuracy": acc, "F1": f1},
              "confusion_matrix": {"0.0": {"0": n00, "1": n10}, "1.0": {"0": n01, "1": n11}},
              "roc_points": [{"threshold": 0.0, "tpr": 1.0, "fpr": 1.0}, {"threshold": 0.1, "tpr": 0.9769188315528048, "fpr": 0.8639472677357212}]}
    flat = {"AUC_ROC": 0.7, "AUC_PR": 0.4, "Accuracy": 0.8, "F1": 0.6, "confusion_matrix": [[5, 1], [2, 0]],
            "roc_points": [{"fpr": 0.0, "tpr": 0.0}, {"fpr": 1.0, "tpr": 1.0}]}
    (tmp_path / "metrics_gbt.json").write_text(json.dumps(nested, indent=2))
    (tmp_path / "metrics_lr.json").write_text(json.dumps(flat))
    (tmp_path / "metrics_rf.json").write_text(json.dumps({"AUC_ROC": 0.5}))  # no points, no matrix
    docs = io.read_metrics_documents(spark, str(tmp_path), ["lr", "rf", "gbt", "absent"])
    roc = sorted(map(tuple, RP.stored_roc_series(docs).fillna(-1.0).collect()))
    assert roc == [("gbt", 0.0, 1.0, 1.0, 0.7392066589477656), ("gbt", 0.1, 0.8639472677357212, 0.9769188315528048, 0.7392066589477656),
                   ("lr", -1.0, 0.0, 0.0, 0.7), ("lr", -1.0, 1.0, 1.0, 0.7)]
    cells = {(r.model, r.target, r.prediction): r.n for r in RP.stored_confusion(docs).collect()}
    assert cells == {("gbt", 0, 0.0): n00, ("gbt", 1, 0.0): n10, ("gbt", 0, 1.0): n01, ("gbt", 1, 1.0): n11,
                     ("lr", 0, 0.0): 5, ("lr", 0, 1.0): 1, ("lr", 1, 0.0): 2, ("lr", 1, 1.0): 0}
    assert {r.model: (r.AUC_ROC, r.F1) for r in RP.stored_comparison(docs).collect()} == {
        "gbt": (0.7392066589477656, f1), "lr": (0.7, 0.6), "rf": (0.5, None)}
    assert io.read_metrics_documents(spark, str(tmp_path / "none")).count() == 0
