"""Helpers shared by the operators: table access, folds, written
intermediates and bounded samples of labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n`` (a null id counts as the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder, deleted when the driver's JVM ends."""
    path = scratch_path(spark, name)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared checkpoint folder
    and read back: lineage ends there, so a lost executor costs only the
    tasks it held, and expensive stages run once however often the result is
    read. Deleted when the driver's JVM ends."""
    spark = df.sparkSession
    ship_package(spark)
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def labelled(labels: DataFrame, label: str, id_col: str = "doc_id") -> DataFrame:
    """(id, y) with one row per non-null id that has a non-null ``label``;
    repeated rows are merged by majority, a tie counts as 1."""
    return (labels.where(F.col(id_col).isNotNull() & F.col(label).isNotNull())
            .groupBy(F.col(id_col).alias(id_col))
            .agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y")))


def _sizes(rows: DataFrame, stratum: str, size: Column | None = None) -> dict:
    n = F.count(F.lit(1)) if size is None else F.coalesce(F.sum(size), F.lit(0)).cast("bigint")
    return {r[0]: r[1] for r in rows.groupBy(stratum).agg(n).collect()}


def highest_kept(bound: int, n: int) -> int:
    """The highest of the signed 64-bit hashes that a sample of ``bound`` of
    ``n`` rows takes: a share of bound / n of them, however small."""
    return (1 << 63) - 1 if n <= bound else (bound << 64) // n - (1 << 63) - 1


def bounded_sample(rows: DataFrame, key: Column, stratum: str, bound: int, seed: int, size: Column | None = None) -> DataFrame:
    """A seeded sample of about ``bound`` rows of each value of ``stratum``
    (all of them where there are fewer). The sampling rate comes from the
    stratum's row count, so the expected size never exceeds the bound; the
    choice depends only on the key, so reruns agree. With ``size`` the bound is on
    the sum of the rows' sizes (characters, say) instead of on their number.
    ``stratum`` must have few values (classes, languages)."""
    h, keep = F.xxhash64(key, F.lit(seed)), F.lit(False)
    for value, n in _sizes(rows, *([stratum] if size is None else [stratum, size])).items():
        keep = F.when(F.col(stratum).eqNullSafe(F.lit(value)), h <= F.lit(highest_kept(bound, n)).cast("bigint")).otherwise(keep)
    return rows.where(keep)
