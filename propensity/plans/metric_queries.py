"""Registered queries: evaluation and report tables on planted scores
(A10, A11, V1-V9, O3, R1-R3).

Two deterministic "models" score the fixture view: ``planted`` (the view's
score column) and ``segment_rate`` (target rate of the row's market segment,
computed by Spark from the same table). Rows are split by the md5
stratified split, so every metric can be checked exactly in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import ctr_frame
from ..operators import metrics as M
from ..operators import report as RP
from ..operators.split import tag_stratified_split
from ..session import broadcast_if_bounded, BROADCAST_MAX_ROWS, scratch_path
from ..sources import io
from .catalog import EIGHTY, H_SPLIT, ORACLES, query, rounded

THRESHOLDS = [i / 10.0 for i in range(11)]


def planted(spark, sf_dir):
    ctr = ctr_frame(spark, sf_dir)
    return ctr.select("target", "score", (F.col("score") >= 0.5).cast("double").alias("prediction"))


def fixture_scored(spark, sf_dir):
    """(model, split, target, score, prediction) for the two fixture models."""
    ctr = ctr_frame(spark, sf_dir)
    tagged = tag_stratified_split(ctr, "target", {0: 0.8, 1: 0.8}, 42, "row_id")
    rates = ctr.groupBy("cat_0").agg(F.avg(F.col("target").cast("double")).alias("seg_rate"))
    rates = broadcast_if_bounded(rates, BROADCAST_MAX_ROWS)
    a = tagged.select(F.lit("planted").alias("model"), "split", "target", "score")
    b = tagged.join(rates, "cat_0").select(F.lit("segment_rate").alias("model"), "split", "target",
                                           F.col("seg_rate").alias("score"))
    return a.unionByName(b).withColumn("prediction", (F.col("score") >= 0.5).cast("double"))


SCORED_SQL = f"""
SELECT 'planted' AS model, split, target, score FROM tagged
UNION ALL
SELECT 'segment_rate' AS model, split, target, avg(target) OVER (PARTITION BY cat_0) AS score FROM tagged"""
TAGGED_SQL = f"""SELECT *, CASE WHEN target IN (0, 1) AND {H_SPLIT} < {EIGHTY} THEN 'train' ELSE 'test' END AS split
FROM ctr"""


def _rank_sql(src: str, groups: list[str]) -> str:
    """Per-group exact AUC-ROC / AUC-PR / average precision in SQL."""
    g = ", ".join(groups)
    gsel = f"{g}, " if groups else ""
    part = f"PARTITION BY {g}" if groups else ""
    gb = f"GROUP BY {g}" if groups else ""
    return f"""
pts AS (SELECT {gsel}score, count(*) FILTER (WHERE target = 1) AS pos,
               count(*) FILTER (WHERE target = 0) AS neg FROM {src} {"GROUP BY " + g + ", score" if groups else "GROUP BY score"}),
cum AS (SELECT *, sum(pos) OVER ({part} ORDER BY score DESC) AS tp, sum(neg) OVER ({part} ORDER BY score DESC) AS fp,
               sum(pos) OVER ({part}) AS P, sum(neg) OVER ({part}) AS N FROM pts),
rk AS (SELECT {gsel}
         CASE WHEN max(P) = 0 OR max(N) = 0 THEN 0.0
              ELSE sum(neg * (2 * (tp - pos) + pos)) / (2.0 * max(P) * max(N)) END AS auc_roc,
         CASE WHEN max(P) = 0 THEN 0.0 ELSE sum((tp / P - (tp - pos) / P)
              * (tp / (tp + fp) + CASE WHEN tp - pos + fp - neg = 0 THEN tp / (tp + fp)
                                       ELSE (tp - pos) / (tp - pos + fp - neg) END) / 2) END AS auc_pr,
         CASE WHEN max(P) = 0 THEN 0.0 ELSE sum(pos / P * tp / (tp + fp)) END AS avg_precision,
         CAST(max(P) AS BIGINT) AS n_pos, CAST(max(N) AS BIGINT) AS n_neg
       FROM cum {gb})"""


def _weighted_sql(src: str, groups: list[str]) -> str:
    g = ", ".join(groups)
    gsel = f"{g}, " if groups else ""
    using = ", ".join(groups + ["lab"])
    return f"""
conf AS (SELECT {gsel}CAST(target AS DOUBLE) AS lab, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END AS pred,
                count(*) AS n FROM {src} GROUP BY ALL),
tr AS (SELECT {gsel}lab, sum(n) AS t, sum(CASE WHEN lab = pred THEN n ELSE 0 END) AS tpc FROM conf GROUP BY ALL),
pr AS (SELECT {gsel}pred AS lab, sum(n) AS p FROM conf GROUP BY ALL),
m AS (SELECT tr.*, coalesce(tr.tpc / pr.p, 0.0) AS prec, tr.tpc / tr.t AS rec
      FROM tr LEFT JOIN pr USING ({using}) WHERE tr.t > 0),
wm AS (SELECT {gsel}sum(tpc) / sum(t) AS accuracy, sum(prec * t) / sum(t) AS weighted_precision,
              sum(rec * t) / sum(t) AS weighted_recall,
              sum(CASE WHEN prec + rec = 0 THEN 0.0 ELSE 2 * prec * rec / (prec + rec) END * t) / sum(t) AS f1
       FROM m GROUP BY ALL)"""


REPORT_METRICS = {"AUC_ROC": "auc_roc", "AUC_PR": "auc_pr", "Accuracy": "accuracy", "F1": "f1",
                  "Weighted_Precision": "weighted_precision", "Weighted_Recall": "weighted_recall",
                  "Average_Precision": "avg_precision"}

REPORT_SQL = (f"tagged AS ({TAGGED_SQL}),\nscored AS ({SCORED_SQL}),"
              + _rank_sql("scored", ["model", "split"]) + ","
              + _weighted_sql("scored", ["model", "split"]) + ",\n"
              + "rep AS (SELECT * FROM rk JOIN wm USING (model, split))\n")


# ------------------------------------------------------------------ A10/A11
@query("confusion_matrix", sql="""
SELECT coalesce(g.target, c.target) AS target, coalesce(g.prediction, c.prediction) AS prediction,
       coalesce(c.n, 0) AS n
FROM (VALUES (0, 0.0::DOUBLE), (0, 1.0::DOUBLE), (1, 0.0::DOUBLE), (1, 1.0::DOUBLE)) g(target, prediction)
FULL OUTER JOIN (SELECT target, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction,
                        count(*) AS n FROM ctr GROUP BY ALL) c
  ON g.target = c.target AND g.prediction = c.prediction""")
def confusion_matrix(spark, sf_dir):
    return M.confusion_matrix(planted(spark, sf_dir), "target", "prediction")


@query("threshold_sweep", sql="\nUNION ALL\n".join(
    f"""SELECT {t}::DOUBLE AS threshold, count(*) FILTER (WHERE score >= {t} AND target = 1) AS tp,
       count(*) FILTER (WHERE score >= {t} AND target = 0) AS fp,
       round(CASE WHEN count(*) FILTER (WHERE target = 1) > 0 THEN (count(*) FILTER (WHERE score >= {t} AND target = 1))
             / (count(*) FILTER (WHERE target = 1)) ELSE 0.0 END, 6) AS tpr,
       round(CASE WHEN count(*) FILTER (WHERE target = 0) > 0 THEN (count(*) FILTER (WHERE score >= {t} AND target = 0))
             / (count(*) FILTER (WHERE target = 0)) ELSE 0.0 END, 6) AS fpr FROM ctr""" for t in THRESHOLDS))
def threshold_sweep(spark, sf_dir):
    return rounded(M.threshold_sweep(planted(spark, sf_dir), "target", "score", THRESHOLDS))


# ------------------------------------------------------------------ V1-V3, V9
@query("roc_curve", sql="""
pts AS (SELECT score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg
        FROM ctr GROUP BY score),
cum AS (SELECT score, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N FROM pts)
SELECT round(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr FROM cum
UNION ALL SELECT NULL::DOUBLE, 0::BIGINT, 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_curve(spark, sf_dir):
    return rounded(M.roc_curve(planted(spark, sf_dir), "target", "score"))


@query("roc_curve_dropped", sql="""
pts AS (SELECT score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg
        FROM ctr GROUP BY score),
cum AS (SELECT score, pos, neg, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N,
               lead(pos) OVER (ORDER BY score DESC) AS npos, lead(neg) OVER (ORDER BY score DESC) AS nneg,
               row_number() OVER (ORDER BY score DESC) AS k FROM pts)
SELECT round(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       round(tp / P, 6) AS tpr, round(fp / N, 6) AS fpr FROM cum
WHERE k = 1 OR npos IS NULL OR npos <> pos OR nneg <> neg
UNION ALL SELECT NULL::DOUBLE, 0::BIGINT, 0::BIGINT, 0.0::DOUBLE, 0.0::DOUBLE""")
def roc_curve_dropped(spark, sf_dir):
    """V9 with collinear points dropped (the single-machine twin's curve)."""
    return rounded(M.roc_curve(planted(spark, sf_dir), "target", "score", drop_collinear=True))


_RANK_ALL = _rank_sql("ctr", [])


@query("auc_roc", sql=_RANK_ALL.lstrip() + "\nSELECT round(auc_roc, 6) AS auc_roc FROM rk")
def auc_roc(spark, sf_dir):
    return rounded(M.ranking_metrics(planted(spark, sf_dir), "target", "score").select("auc_roc"))


@query("auc_pr", sql=_RANK_ALL.lstrip() + "\nSELECT round(auc_pr, 6) AS auc_pr FROM rk")
def auc_pr(spark, sf_dir):
    return rounded(M.ranking_metrics(planted(spark, sf_dir), "target", "score").select("auc_pr"))


@query("avg_precision", sql=_RANK_ALL.lstrip() + "\nSELECT round(avg_precision, 6) AS avg_precision FROM rk")
def avg_precision(spark, sf_dir):
    return rounded(M.ranking_metrics(planted(spark, sf_dir), "target", "score").select("avg_precision"))


@query("ranking_by_model_split", sql=REPORT_SQL.replace("rep AS (SELECT * FROM rk JOIN wm USING (model, split))\n",
                                                        "x AS (SELECT 1)\n")
       + "SELECT model, split, round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr, "
         "round(avg_precision, 6) AS avg_precision, n_pos, n_neg FROM rk")
def ranking_by_model_split(spark, sf_dir):
    """V1-V3 per (model, split) in one pass of the bucketed ranking."""
    return rounded(M.ranking_metrics(fixture_scored(spark, sf_dir), "target", "score", ["model", "split"]))


@query("weighted_metrics", sql=_weighted_sql("ctr", []).lstrip()
       + "\nSELECT round(accuracy, 6) AS accuracy, round(weighted_precision, 6) AS weighted_precision, "
         "round(weighted_recall, 6) AS weighted_recall, round(f1, 6) AS f1 FROM wm")
def weighted_metrics(spark, sf_dir):
    conf = M.confusion_matrix(planted(spark, sf_dir), "target", "prediction")
    return rounded(M.weighted_metrics(conf, "target"))


# ------------------------------------------------------------------ V8, R1-R3
@query("train_test_report", sql=REPORT_SQL + "\nUNION ALL\n".join(
    f"SELECT model, split, '{k}' AS metric, round({v}, 6) AS value FROM rep" for k, v in REPORT_METRICS.items()))
def train_test_report(spark, sf_dir):
    return rounded(M.classification_report(fixture_scored(spark, sf_dir), "target", "score",
                                           "prediction", ["model", "split"]))


@query("roc_series", sql=f"tagged AS ({TAGGED_SQL}),\nscored AS ({SCORED_SQL}),"
       + _rank_sql("(SELECT * FROM scored WHERE split = 'test')", ["model"]) + "\n"
       + "\nUNION ALL\n".join(
           f"""SELECT s.model, {t}::DOUBLE AS threshold,
       round(CASE WHEN count(*) FILTER (WHERE target = 0) > 0 THEN (count(*) FILTER (WHERE score >= {t} AND target = 0))
             / (count(*) FILTER (WHERE target = 0)) ELSE 0.0 END, 6) AS fpr,
       round(CASE WHEN count(*) FILTER (WHERE target = 1) > 0 THEN (count(*) FILTER (WHERE score >= {t} AND target = 1))
             / (count(*) FILTER (WHERE target = 1)) ELSE 0.0 END, 6) AS tpr,
       round(max(rk.auc_roc), 6) AS auc_roc
FROM scored s JOIN rk ON s.model = rk.model WHERE split = 'test' GROUP BY s.model""" for t in THRESHOLDS))
def roc_series(spark, sf_dir):
    """R1 (+O3): per model, the sweep points ordered by fpr, with the AUC for
    the legend."""
    test = fixture_scored(spark, sf_dir).where(F.col("split") == "test")
    return rounded(RP.roc_series(test, "target", "score", ["model"], THRESHOLDS))


@query("confusion_grid", sql=f"""tagged AS ({TAGGED_SQL}),
scored AS ({SCORED_SQL}),
grid AS (SELECT m.model, g.target, g.prediction FROM (SELECT DISTINCT model FROM scored WHERE split = 'test') m,
         (VALUES (0, 0.0::DOUBLE), (0, 1.0::DOUBLE), (1, 0.0::DOUBLE), (1, 1.0::DOUBLE)) g(target, prediction)),
c AS (SELECT model, target, CASE WHEN score >= 0.5 THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction, count(*) AS n
      FROM scored WHERE split = 'test' GROUP BY ALL)
SELECT coalesce(grid.model, c.model) AS model, coalesce(grid.target, c.target) AS target,
       coalesce(grid.prediction, c.prediction) AS prediction, coalesce(c.n, 0) AS n
FROM grid FULL OUTER JOIN c ON grid.model = c.model AND grid.target = c.target AND grid.prediction = c.prediction""")
def confusion_grid(spark, sf_dir):
    """R2: dense (model, true, predicted, n) on the test split."""
    test = fixture_scored(spark, sf_dir).where(F.col("split") == "test")
    return M.confusion_matrix(test, "target", "prediction", ["model"])


@query("model_comparison", sql=REPORT_SQL + """
SELECT model, round(auc_roc, 6) AS AUC_ROC, round(auc_pr, 6) AS AUC_PR, round(accuracy, 6) AS Accuracy,
       round(f1, 6) AS F1 FROM rep WHERE split = 'test'""")
def model_comparison(spark, sf_dir):
    """One row per model with the four compared metrics (test split)."""
    rep = M.classification_report(fixture_scored(spark, sf_dir), "target", "score",
                                  "prediction", ["model", "split"])
    return rounded(RP.model_comparison(rep))


@query("confusion_wide", sql="""
SELECT target, count(*) FILTER (WHERE score < 0.5) AS pred_0, count(*) FILTER (WHERE score >= 0.5) AS pred_1
FROM ctr GROUP BY target""")
def confusion_wide(spark, sf_dir):
    """A10 in the reference's pivoted shape (one row per true class)."""
    conf = M.confusion_matrix(planted(spark, sf_dir), "target", "prediction")
    return RP.confusion_wide(conf, "target")


@query("metrics_sink_roundtrip", sql=REPORT_SQL + "\nUNION ALL\n".join(
    f"SELECT model, split, '{k}' AS metric, round({v}, 6) AS value FROM rep" for k, v in REPORT_METRICS.items()))
def metrics_sink_roundtrip(spark, sf_dir):
    """S4 + S6: the report written as JSON partitioned by model into the
    shared folder, read back for the listed models (a missing one is
    skipped)."""
    from ..session import scratch_path
    from ..sources import io
    rep = M.classification_report(fixture_scored(spark, sf_dir), "target", "score", "prediction",
                                  ["model", "split"])
    path = io.write_metrics(rep, scratch_path(spark, "report"))
    back = io.read_metrics(spark, path, ["planted", "segment_rate", "not_trained"])
    return rounded(back.select("model", "split", "metric", "value"))


def _stored(spark, sf_dir):
    """The test split's documents of the planted models, written by the job's
    own document writer and read back."""
    from . import job
    path = scratch_path(spark, "documents")
    scored = fixture_scored(spark, sf_dir)
    models = sorted(r[0] for r in scored.select("model").distinct().collect())
    for m in models:
        one = scored.where(F.col("model") == m)
        ev = M.evaluate(one, "target", "score", "prediction", ["split"])
        test = F.col("split") == "test"
        tables = {"report": ev["report"], "confusion": ev["confusion"].where(test), "roc_points": ev["sweep"].where(test)}
        job.write_json_doc(spark, job.metrics_document(m, tables, 0.0), f"{path}/metrics_{m}")
    return io.read_metrics_documents(spark, path, [*models, "absent"])


@query("stored_roc_series")
def stored_roc_series(spark, sf_dir):
    """S6 + R1: the curve's points from written metrics documents."""
    return rounded(RP.stored_roc_series(_stored(spark, sf_dir)))


@query("stored_confusion_grid")
def stored_confusion_grid(spark, sf_dir):
    """S6 + R2 from written metrics documents."""
    return RP.stored_confusion(_stored(spark, sf_dir))


@query("stored_model_comparison")
def stored_model_comparison(spark, sf_dir):
    """S6 + R3 from written metrics documents."""
    return rounded(RP.stored_comparison(_stored(spark, sf_dir)))


@query("ranking_null_group", sql=_rank_sql("(SELECT *, CASE WHEN row_id % 3 = 0 THEN NULL ELSE 'a' END AS grp FROM ctr)", ["grp"])
       + "\nSELECT grp, round(auc_roc, 6) AS auc_roc, round(auc_pr, 6) AS auc_pr, round(avg_precision, 6) AS avg_precision FROM rk")
def ranking_null_group(spark, sf_dir):
    """V1-V3 where a group's key is null: it is a group like any other."""
    df = ctr_frame(spark, sf_dir).withColumn("grp", F.when(F.col("row_id") % 3 != 0, "a"))
    return rounded(M.ranking_metrics(df, "target", "score", ["grp"]).select("grp", "auc_roc", "auc_pr", "avg_precision"))


for _name in ("roc_series", "confusion_grid", "model_comparison"):
    ORACLES[f"stored_{_name}"] = ORACLES[_name]  # stored or not, the same table
