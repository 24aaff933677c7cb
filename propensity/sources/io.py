"""Sources and sinks.

S1 reads the impression table as text by column name (no inference pass, no
``05000000`` -> ``5000000.0`` surprise); S2 conforms types in one
projection with ``try_cast`` (Spark 4 runs ANSI mode, where ``cast('abc' as
int)`` raises) and turns NaN into null so later stages see one kind of
missing. Sinks write through Spark's writers into the output folder, which
must be shared storage on a cluster.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.clean import nan_to_null
from ..spec import FeatureSpec


def read_impressions(spark: SparkSession, path: str, spec: FeatureSpec,
                     fmt: str | None = None) -> DataFrame:
    """Header CSV or Parquet -> conformed table.

    A CSV's columns are taken by the names in its header, in any order, as
    text (no inference pass); ``conform`` does the typing. A table without
    the target column is refused."""
    fmt = fmt or ("parquet" if path.rstrip("/").endswith(".parquet") else "csv")
    if fmt == "csv":
        df = (spark.read.option("header", True).option("inferSchema", False)
                   .option("enforceSchema", False).option("mode", "PERMISSIVE").csv(path))
    else:
        df = spark.read.parquet(path)
    if spec.target not in df.columns:
        raise ValueError(f"no column {spec.target!r} in {path}; it has {df.columns}")
    return conform(df, spec)


def conform(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Target -> int, numerics -> double (NaN -> null), categoricals ->
    string; columns absent from the table are skipped; one projection.
    Unparseable text becomes null (``try_cast``). The row key keeps its type,
    and a null key raises: such a row could not be assigned to a part."""
    present = set(df.columns)
    out = {}
    if spec.id_col and spec.id_col in present:
        key = F.col(spec.id_col)
        out[spec.id_col] = F.when(key.isNull(), F.raise_error(F.lit(f"null row key in {spec.id_col}"))).otherwise(key)
    if spec.target in present:
        tgt = F.col(spec.target)
        # "1.0" in text form is a valid label too
        out[spec.target] = F.coalesce(tgt.try_cast("int"), tgt.try_cast("double").try_cast("int"))
    for c in spec.int_cols:
        if c in present:
            out[c] = nan_to_null(F.col(c).try_cast("double"))
    for c in spec.cat_cols:
        if c in present:
            out[c] = F.col(c).cast("string")
    return df.withColumns(out)


def write_table(df: DataFrame, path: str, fmt: str = "json", mode: str = "overwrite",
                partition_by=()) -> str:
    w = df.write.mode(mode)
    if partition_by:
        # overwrite only the partitions being written (one model at a time)
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.format(fmt).save(path)
    return path


def write_profile(profile: DataFrame, path: str) -> str:
    """S3: the profile tables (long form) as JSON lines."""
    return write_table(profile, path, "json")


def write_metrics(report: DataFrame, path: str) -> str:
    """The metrics report, one folder per model."""
    return write_table(report, path, "json", partition_by=("model",))


def write_sorted(df: DataFrame, path: str, by) -> str:
    """A table in the order of ``by`` across its files (range partitions,
    each sorted), written by tasks however long it is."""
    by = list(by)
    df.repartitionByRange(*by).sortWithinPartitions(*by).write.mode("overwrite").parquet(path)
    return path


def stream_sorted(spark: SparkSession, path: str, by) -> Iterator:
    """Rows of a ``write_sorted`` table in order, one file's rows in the
    driver's memory at a time."""
    by = list(by)
    files = sorted(spark.read.parquet(path).inputFiles())  # part numbers follow the ranges
    for f in files:
        yield from spark.read.parquet(f).orderBy(*by).toLocalIterator()


def read_metrics(spark: SparkSession, path: str, models=None) -> DataFrame:
    """Read a metrics report; models whose folder is missing are skipped."""
    if models is not None:
        parts = [os.path.join(path, f"model={m}") for m in models]
        existing = [p for p in parts if _exists(spark, p)]
        if not existing:
            return spark.createDataFrame([], "model string, split string, metric string, value double")
        return spark.read.option("basePath", path).json(existing)
    return spark.read.json(path)


#: Metrics documents (JSON): metrics under ``test_metrics`` / ``training_metrics`` or flat, confusion
#: counts keyed by prediction and label or as rows of true classes, curve points with or without thresholds,
#: or the folder of the whole curve as a sorted table.
_DOCUMENT = """training_metrics map<string,double>, test_metrics map<string,double>,
AUC_ROC double, AUC_PR double, Accuracy double, F1 double, Weighted_Precision double, Weighted_Recall double,
fit_time_sec double, confusion_matrix string, roc_points array<struct<threshold:double,fpr:double,tpr:double>>,
roc_curve string"""


def read_metrics_documents(spark: SparkSession, path: str, models=("lr", "rf", "gbt")) -> DataFrame:
    """One row per stored document ``metrics_<model>.json`` or folder
    ``metrics_<model>`` (as the job writes): (model, doc struct). A model
    without a document is skipped."""
    out = None
    for m in models:
        found = [p for p in (os.path.join(path, f"metrics_{m}.json"), os.path.join(path, f"metrics_{m}")) if _exists(spark, p)]
        if found:
            one = spark.read.text(found[0], wholetext=True).where(F.length(F.trim("value")) > 0)
            one = one.select(F.lit(m).alias("model"), F.from_json("value", _DOCUMENT).alias("doc"))
            out = one if out is None else out.unionByName(one)
    if out is None:
        out = spark.sql("SELECT '' AS model, '' AS value").where("false").select("model", F.from_json("value", _DOCUMENT).alias("doc"))
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(jpath)


def save_model(model: PipelineModel, path: str) -> str:
    """Save a fitted pipeline, overwriting."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score_saved(path: str, df: DataFrame) -> DataFrame:
    """Score a table with a saved pipeline."""
    return load_model(path).transform(df)
