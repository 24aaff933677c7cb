"""Registered queries: sampling, splits, folds and the anti join."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import CTR_SPEC, ctr_frame
from ..functions.hashing import md5_u32_sql
from ..operators import split as SP
from ..sources import io
from .catalog import EIGHTY, HALF, H_FOLD, H_SAMPLE, H_SPLIT, query, union_sql

TRAIN = {0: 0.8, 1: 0.8}


@query("sample_hash", sql=f"SELECT row_id, target FROM ctr WHERE {H_SAMPLE} < {HALF}")
def sample_hash(spark, sf_dir):
    """X1, hash form: Bernoulli half of the rows."""
    return SP.sample(ctr_frame(spark, sf_dir), 0.5, 42, "hash", "row_id").select("row_id", "target")


@query("sample_seeded")
def sample_seeded(spark, sf_dir):
    """X1, Spark-seeded form (rows-only check)."""
    return SP.sample(ctr_frame(spark, sf_dir), 0.5, 42, "seeded").select("row_id", "target")


@query("split_random_hash", sql=f"""
SELECT row_id, CASE WHEN {H_SPLIT} < {EIGHTY} THEN 'train' ELSE 'test' END AS split FROM ctr""")
def split_random_hash(spark, sf_dir):
    """X2, hash form."""
    return SP.tag_random_split(ctr_frame(spark, sf_dir), 0.8, 42, "row_id").select("row_id", "split")


@query("split_stratified_hash", sql=f"""
SELECT row_id, target,
       CASE WHEN target IN (0, 1) AND {H_SPLIT} < {EIGHTY} THEN 'train' ELSE 'test' END AS split
FROM ctr""")
def split_stratified_hash(spark, sf_dir):
    """X3, hash form (per-class Bernoulli, tagged in one projection)."""
    df = SP.tag_stratified_split(ctr_frame(spark, sf_dir), "target", TRAIN, 42, "row_id")
    return df.select("row_id", "target", "split")


@query("split_stratified_seeded")
def split_stratified_seeded(spark, sf_dir):
    """X3, the reference's form: ``sampleBy`` + anti join on the row id
    (rows-only check: Spark's sampler has no SQL twin)."""
    train, test = SP.stratified_split(ctr_frame(spark, sf_dir), "target", 0.8, 42, "seeded", "row_id")
    return (train.select("row_id", "target", F.lit("train").alias("split"))
                 .unionByName(test.select("row_id", "target", F.lit("test").alias("split"))))


@query("split_stratified_exact", sql=f"""
SELECT row_id, target,
       CASE WHEN row_number() OVER (PARTITION BY target ORDER BY {H_SPLIT}, row_id)
                 <= floor(count(*) OVER (PARTITION BY target) * 0.8 + 0.5)
            THEN 'train' ELSE 'test' END AS split
FROM ctr""")
def split_stratified_exact(spark, sf_dir):
    """Exactly round(0.8 n) rows of each class in train."""
    df = SP.tag_exact_stratified_split(ctr_frame(spark, sf_dir), "target", 0.8, 42, "row_id")
    return df.select("row_id", "target", "split")


@query("split_anti_join", sql=f"""
SELECT row_id, target FROM ctr
WHERE row_id NOT IN (SELECT row_id FROM ctr WHERE target IN (0, 1) AND {H_SPLIT} < {EIGHTY})""")
def split_anti_join(spark, sf_dir):
    """test = rows whose id is not among the train ids."""
    ctr = ctr_frame(spark, sf_dir)
    train, _ = SP.split_parts(SP.tag_stratified_split(ctr, "target", TRAIN, 42, "row_id"))
    return SP.anti_join_split(ctr, train, "row_id").select("row_id", "target")


@query("row_ids", sql="SELECT count(*) AS n_rows, count(DISTINCT row_id) AS n_ids FROM ctr")
def row_ids(spark, sf_dir):
    """P5: generated ids are unique (``monotonically_increasing_id`` over a
    table without a natural key)."""
    df = SP.attach_row_id(ctr_frame(spark, sf_dir).drop("row_id"), None, "_row_id")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_row_id").alias("n_ids"))


@query("folds_hash", sql=f"SELECT row_id, CAST({H_FOLD} % 2 AS INTEGER) AS fold FROM ctr")
def folds_hash(spark, sf_dir):
    """Unstratified 2 folds, md5 mod k."""
    return SP.assign_folds(ctr_frame(spark, sf_dir), 2, 42, "row_id", "hash").select("row_id", "fold")


@query("folds_stratified", sql=f"""
SELECT row_id, target,
       CAST((row_number() OVER (PARTITION BY target ORDER BY {H_FOLD}, row_id) - 1) % 2 AS INTEGER) AS fold
FROM ctr""")
def folds_stratified(spark, sf_dir):
    """Stratified 2 folds, rank inside the class mod k."""
    df = SP.assign_folds(ctr_frame(spark, sf_dir), 2, 42, "row_id", target="target", stratified=True)
    return df.select("row_id", "target", "fold")


@query("split_random_seeded")
def split_random_seeded(spark, sf_dir):
    """X2, the older script's form: ``randomSplit([0.8, 0.2], 42)`` (rows-only
    check)."""
    train, test = SP.random_split(ctr_frame(spark, sf_dir), 0.8, 42, "seeded")
    return (train.select("row_id", F.lit("train").alias("split"))
                 .unionByName(test.select("row_id", F.lit("test").alias("split"))))


_EVERY = f"""
SELECT row_id, CASE WHEN {H_SPLIT} < {EIGHTY} THEN 'train' ELSE 'test' END AS split
FROM ctr WHERE {H_SAMPLE} < {HALF}"""


@query("sample_then_split", sql=_EVERY)
def sample_then_split(spark, sf_dir):
    """X1 then X2 on the same key: the two decisions are independent."""
    half = SP.sample(ctr_frame(spark, sf_dir), 0.5, 42, "hash", "row_id")
    return SP.tag_random_split(half, 0.8, 42, "row_id").select("row_id", "split")


@query("split_small_fraction", sql=f"""
SELECT row_id, CASE WHEN {H_SPLIT} < {SP.hash_limit(0.0004)} THEN 'train' ELSE 'test' END AS split FROM ctr""")
def split_small_fraction(spark, sf_dir):
    """X2 with a fraction below a thousandth."""
    return SP.tag_random_split(ctr_frame(spark, sf_dir), 0.0004, 42, "row_id").select("row_id", "split")


@query("split_text_key", sql=f"""
SELECT 'u-' || CAST(row_id AS VARCHAR) AS row_key,
       CASE WHEN {md5_u32_sql("'u-' || CAST(row_id AS VARCHAR)", "42:split")} < {EIGHTY} THEN 'train' ELSE 'test' END AS split
FROM ctr""")
def split_text_key(spark, sf_dir):
    """X2 on a table whose row key is text, after ``conform``."""
    df = ctr_frame(spark, sf_dir).withColumn("row_key", F.concat(F.lit("u-"), F.col("row_id").cast("string")))
    df = io.conform(df, CTR_SPEC.with_(id_col="row_key"))
    return SP.tag_random_split(df, 0.8, 42, "row_key").select("row_key", "split")


@query("folds_null_class", sql=f"""
SELECT row_id, CAST((row_number() OVER (PARTITION BY cls ORDER BY {H_FOLD}, row_id) - 1) % 3 AS INTEGER) AS fold
FROM (SELECT *, CASE WHEN row_id % 3 = 0 THEN NULL ELSE target END AS cls FROM ctr)""")
def folds_null_class(spark, sf_dir):
    """X6 where some rows have no class: they are dealt to folds too."""
    df = ctr_frame(spark, sf_dir).withColumn("cls", F.when(F.col("row_id") % 3 != 0, F.col("target")))
    return SP.assign_folds(df, 3, 42, "row_id", target="cls", stratified=True).select("row_id", "fold")


@query("seeded_parts", sql=union_sql("""
SELECT '{c}' AS method, count(*) AS n_rows, count(*) AS n_in_parts, 0::BIGINT AS n_twice, true AS near_share FROM ctr""",
                                     ["sample", "random", "stratified"]))
def seeded_parts(spark, sf_dir):
    """X1-X3, seeded forms: the parts are disjoint, together they are the
    table, and the first has its share within five standard deviations."""
    ctr = ctr_frame(spark, sf_dir).select("row_id", "target")
    half = SP.sample(ctr, 0.5, 42, "seeded")
    cases = [("sample", half, SP.anti_join_split(ctr, half, "row_id"), 0.5),
             ("random", *SP.random_split(ctr, 0.8, 42, "seeded"), 0.8),
             ("stratified", *SP.stratified_split(ctr, "target", 0.8, 42, "seeded", "row_id"), 0.8)]
    n = F.count(F.lit(1))
    out = None
    for name, first, second, share in cases:
        both = first.select("row_id", F.lit(1).alias("a")).unionByName(second.select("row_id", F.lit(0).alias("a")))
        per_row = ctr.join(both, "row_id", "left").groupBy("row_id").agg(F.count("a").alias("k"), F.sum("a").alias("a"))
        one = per_row.agg(n.alias("n_rows"), F.sum("k").alias("n_in_parts"), F.count_if(F.col("k") > 1).alias("n_twice"),
                          (F.abs(F.sum("a") - share * n) <= 5 * F.sqrt(share * (1 - share) * n)).alias("near_share"))
        one = one.select(F.lit(name).alias("method"), "*")
        out = one if out is None else out.unionByName(one)
    return out
