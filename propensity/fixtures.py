"""The ``ctr`` fixture view over the driver's tables.

The reference's click data is not available, so tests and registered queries
run on ``events JOIN customer JOIN nation``, with nulls, sentinels and a
planted score made by arithmetic on ``event_id``. ``CTR_VIEW_SQL`` is the
same text in Spark and DuckDB; ``ctr_frame`` is its DataFrame form.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .spec import FeatureSpec

CTR_VIEW_SQL = """
SELECT
  e.event_id AS row_id,
  CASE WHEN e.event_type = 'click' THEN 1 ELSE 0 END AS target,
  CASE WHEN e.event_id % 7 < 3 THEN NULL ELSE CAST(floor(e.value) AS DOUBLE) END AS int_0,
  CAST((e.event_id % 5) - 2 AS DOUBLE) AS int_1,
  cu.c_acctbal AS int_2,
  CASE WHEN e.event_id % 13 < 10 THEN NULL ELSE CAST(floor(e.value) AS DOUBLE) * 10 END AS int_3,
  cu.c_mktsegment AS cat_0,
  n.n_name AS cat_1,
  CASE WHEN e.event_id % 2 = 0 THEN NULL ELSE substr(md5(CAST(e.user_id AS VARCHAR)), 1, 8) END AS cat_2,
  CASE WHEN e.event_id % 28 = 0 THEN NULL ELSE e.props END AS cat_3,
  CAST((e.event_id * 7919) % 101 + CASE WHEN e.event_type = 'click' THEN 20 ELSE 0 END AS DOUBLE)
    / CAST(121 AS DOUBLE) AS score
FROM events e
JOIN customer cu ON e.user_id = cu.c_custkey
JOIN nation n ON cu.c_nationkey = n.n_nationkey
"""

CTR_SPEC = FeatureSpec(
    target="target",
    int_cols=("int_0", "int_1", "int_2", "int_3"),
    cat_cols=("cat_0", "cat_1", "cat_2", "cat_3"),
    skewed=("int_0", "int_1", "int_3"),
    flag_cols=("int_0", "int_3"),
    sentinel_col="int_1",
    sentinels=(-1.0, -2.0),
    id_col="row_id",
    num_hash_features=128,
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ctr_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DataFrame form of ``CTR_VIEW_SQL``.

    customer and nation are dimension tables joined on their keys; the
    planner broadcasts them when its size estimate allows, else shuffles."""
    e = read_table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "props")
    cu = read_table(spark, sf_dir, "customer").select(
        "c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    eid = F.col("event_id")
    click = F.col("event_type") == F.lit("click")
    floor_value = F.floor("value").cast("double")

    def null_when(cond: Column, value: Column) -> Column:
        return F.when(cond, F.lit(None)).otherwise(value)

    j = (e.join(cu, e.user_id == cu.c_custkey)
          .join(n, cu.c_nationkey == n.n_nationkey))
    return j.select(
        eid.alias("row_id"),
        F.when(click, 1).otherwise(0).alias("target"),
        null_when(eid % 7 < 3, floor_value).cast("double").alias("int_0"),
        ((eid % 5) - 2).cast("double").alias("int_1"),
        F.col("c_acctbal").cast("double").alias("int_2"),
        null_when(eid % 13 < 10, floor_value * 10).cast("double").alias("int_3"),
        F.col("c_mktsegment").alias("cat_0"),
        F.col("n_name").alias("cat_1"),
        null_when(eid % 2 == 0,
                  F.substring(F.md5(F.col("user_id").cast("string")), 1, 8)).alias("cat_2"),
        null_when(eid % 28 == 0, F.col("props")).alias("cat_3"),
        ((((eid * 7919) % 101) + F.when(click, 20).otherwise(0)).cast("double")
         / F.lit(121.0)).alias("score"),
    )


def with_ctr(sql: str) -> str:
    """Prefix an oracle query with the fixture view as a CTE; a query that
    starts with more CTEs (``name AS (...)``) continues the WITH list."""
    body = sql.lstrip()
    sep = "\n" if body[:6].upper() == "SELECT" else ",\n"
    return f"WITH ctr AS ({CTR_VIEW_SQL}){sep}{body}"
