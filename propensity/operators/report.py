"""Report tables (R1-R3, O2) built from the evaluation tables.

The reference turns its metrics JSON into three charts; the data behind
each chart is a table here, so charts can be drawn by any tool.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import metrics as M

COMPARED = ["AUC_ROC", "AUC_PR", "Accuracy", "F1"]


def roc_series(scored: DataFrame, label: str, score: str, groups=("model",),
               thresholds=M.DEFAULT_THRESHOLDS) -> DataFrame:
    """R1 + O3: per model, ``(threshold, fpr, tpr, auc_roc)`` sorted by fpr
    then tpr, with the model's exact AUC for the legend. Models lacking
    points are absent by construction."""
    groups = list(groups)
    sweep = M.threshold_sweep(scored, label, score, thresholds, groups)
    auc = M.ranking_metrics(scored, label, score, groups).select(*groups, "auc_roc")
    return (sweep.join(auc, groups, "inner")
                 .select(*groups, "threshold", "fpr", "tpr", "auc_roc")
                 .orderBy(*groups, "fpr", "tpr"))


def confusion_wide(confusion: DataFrame, label: str, groups=(), classes=(0.0, 1.0)) -> DataFrame:
    """A10 in the reference's pivoted shape: one row per true class, one
    column per predicted class (``pred_0``, ``pred_1``)."""
    groups = list(groups)
    wide = (confusion.groupBy(*groups, label)
                     .pivot("prediction", [float(c) for c in classes]).agg(F.first("n")))
    return wide.select(*groups, label, *[F.coalesce(F.col(f"`{float(c)}`"), F.lit(0)).alias(f"pred_{int(c)}")
                                         for c in classes])


def model_comparison(report: DataFrame, split: str = "test", metrics=COMPARED) -> DataFrame:
    """One row per model, one column per compared metric."""
    return (report.where(F.col("split") == split)
                  .groupBy("model").pivot("metric", list(metrics)).agg(F.first("value")))


def top_importances(spark: SparkSession, importances, names=None, k: int = 20,
                    model: str | None = None) -> DataFrame:
    """O2: top-k features by importance, descending, ties by lower index
    (the reference's stable sort). ``importances`` is a fitted model's vector
    (one value per feature, held by the driver like the model itself)."""
    vals = [float(v) for v in importances]
    names = list(names) if names is not None else [f"f{i}" for i in range(len(vals))]
    order = sorted(range(len(vals)), key=lambda i: (-vals[i], i))[:k]
    rows = [(model, r + 1, i, names[i], vals[i]) for r, i in enumerate(order)]
    return spark.createDataFrame(rows, "model string, rank int, idx int, name string, importance double")


# -------------------------------------------- from stored metrics documents
def _stored_metric(name: str) -> Column:
    """A test metric of a nested document, else the flat one."""
    return F.coalesce(F.col("doc.test_metrics")[name], F.col(f"doc.{name}"))


def stored_roc_series(documents: DataFrame) -> DataFrame:
    """R1 from ``io.read_metrics_documents``: ``(model, threshold, fpr, tpr,
    auc_roc)``; a model without points is left out. A document that names the
    folder of its whole curve has its points read from that table."""
    out = (documents.where(F.size("doc.roc_points") > 0)
           .select("model", _stored_metric("AUC_ROC").alias("auc_roc"), F.explode("doc.roc_points").alias("p"))
           .select("model", "p.threshold", "p.fpr", "p.tpr", "auc_roc"))
    spark = documents.sparkSession
    whole = documents.where("doc.roc_curve IS NOT NULL").select("model", "doc.roc_curve", _stored_metric("AUC_ROC").alias("auc")).collect()
    for r in whole:  # one row a model
        curve = spark.read.parquet(r["roc_curve"])
        out = out.unionByName(curve.select(F.lit(r["model"]).alias("model"), "threshold", "fpr", "tpr", F.lit(r["auc"]).cast("double").alias("auc_roc")))
    return out


def stored_confusion(documents: DataFrame, classes=(0, 1)) -> DataFrame:
    """R2 from stored documents: dense ``(model, target, prediction, n)``; a
    model without a matrix is left out. Counts are stored by prediction and
    then label, or as a list of rows, one per true class."""
    text = F.col("doc.confusion_matrix")
    by_prediction = F.from_json(text, "map<string,map<string,bigint>>")
    rows = F.from_json(text, "array<array<bigint>>")
    have = documents.where(text.isNotNull()).withColumn("list", F.startswith(F.trim(text), F.lit("[")))
    maps = (have.where(~F.col("list")).select("model", F.explode(by_prediction).alias("p", "m"))
            .select("model", F.col("p").cast("double").alias("prediction"), F.explode("m").alias("t", "n"))
            .select("model", F.col("t").cast("double").cast("int").alias("target"), "prediction", "n"))
    lists = (have.where("list").select("model", F.posexplode(rows).alias("target", "r"))
             .select("model", "target", F.posexplode("r").alias("prediction", "n"))
             .select("model", "target", F.col("prediction").cast("double").alias("prediction"), "n"))
    grid = have.select("model", F.explode(F.array(*[F.lit(int(c)) for c in classes])).alias("target")).withColumn(
        "prediction", F.explode(F.array(*[F.lit(float(c)) for c in classes])))
    # an empty cell is not stored: it counts 0
    filled = grid.withColumn("n", F.lit(0).cast("bigint")).unionByName(maps.unionByName(lists))
    return filled.groupBy("model", "target", "prediction").agg(F.sum("n").alias("n"))


def stored_comparison(documents: DataFrame, metrics=COMPARED) -> DataFrame:
    """R3 from stored documents: one row per model."""
    return documents.select("model", *[_stored_metric(m).alias(m) for m in metrics])
