"""Registered queries: sources, profiling and cleaning (S1, S2, A1-A9,
A13-A15, P1-P4, P9)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..fixtures import ctr_frame
from ..operators import clean as C
from ..operators import profile as PR
from ..operators.quantiles import exact_quantiles
from ..session import scratch_path
from ..sources import io
from .catalog import CATS, FEATURES, INTS, S, query, rounded, union_sql

CTR_COLS = ["row_id", "target"] + FEATURES


def _key_as_number(df):
    """A text table's row key stays text; the oracle's is a number."""
    return df.withColumn("row_id", F.col("row_id").cast("bigint")).select(*CTR_COLS)


@query("conform_schema", sql=f"SELECT {', '.join(CTR_COLS)} FROM ctr")
def conform_schema(spark, sf_dir):
    """Every column as text, then conformed back to typed columns."""
    raw = ctr_frame(spark, sf_dir).select(*[F.col(c).cast("string").alias(c) for c in CTR_COLS])
    return _key_as_number(io.conform(raw, S))


@query("csv_roundtrip", sql=f"SELECT {', '.join(CTR_COLS)} FROM ctr")
def csv_roundtrip(spark, sf_dir):
    """Written as header CSV into the shared scratch folder, read back
    by column name and conformed."""
    path = scratch_path(spark, "ctr-csv")
    ctr_frame(spark, sf_dir).select(*CTR_COLS).write.option("header", True).csv(path)
    return _key_as_number(io.read_impressions(spark, path, S, fmt="csv"))


@query("csv_reordered", sql=f"SELECT {', '.join(CTR_COLS)} FROM ctr")
def csv_reordered(spark, sf_dir):
    """A CSV whose columns stand in another order is read by name."""
    path = scratch_path(spark, "ctr-csv-reordered")
    ctr_frame(spark, sf_dir).select(*reversed(CTR_COLS)).write.option("header", True).csv(path)
    return _key_as_number(io.read_impressions(spark, path, S, fmt="csv"))


@query("dataset_shape", sql="SELECT count(*) AS n_rows, 11 AS n_columns FROM ctr")
def dataset_shape(spark, sf_dir):
    return PR.dataset_shape(ctr_frame(spark, sf_dir))


@query("class_balance", sql="SELECT target, count(*) AS n FROM ctr GROUP BY target")
def class_balance(spark, sf_dir):
    return PR.class_balance(ctr_frame(spark, sf_dir), "target")


@query("positive_rate", sql="""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE target = 1) AS n_pos,
       round(CASE WHEN count(DISTINCT target) > 1
                  THEN (count(*) FILTER (WHERE target = 1)) / count(*) ELSE -1.0::DOUBLE END, 6) AS positive_rate
FROM ctr""")
def positive_rate(spark, sf_dir):
    return rounded(PR.positive_rate(ctr_frame(spark, sf_dir), "target"))


@query("null_profile", sql=union_sql(
    "SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    "CAST(printf('%.2f', 100.0::DOUBLE * (count(*) FILTER (WHERE {c} IS NULL)) / count(*)) AS DOUBLE) AS pct_null FROM ctr",
    FEATURES))
def null_profile(spark, sf_dir):
    return PR.null_profile(ctr_frame(spark, sf_dir), FEATURES)


@query("numeric_profile", sql=union_sql(
    "SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 6) AS mean, "
    "round(stddev_samp({c}), 6) AS stddev, round(min({c}), 6) AS min, "
    "round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS p75, "
    "round(max({c}), 6) AS max FROM ctr", INTS))
def numeric_profile(spark, sf_dir):
    return rounded(PR.numeric_profile(ctr_frame(spark, sf_dir), INTS))


@query("feature_std", sql=union_sql(
    "SELECT '{c}' AS feature, round(stddev_samp({c}), 6) AS std_sample, "
    "round(stddev_pop({c}), 6) AS std_population FROM ctr", INTS))
def feature_std(spark, sf_dir):
    """A14 + A15: sample and population standard deviation per feature."""
    df = ctr_frame(spark, sf_dir)
    agg = df.agg(*[F.stddev_samp(c).alias(f"s__{i}") for i, c in enumerate(INTS)],
                 *[F.stddev_pop(c).alias(f"p__{i}") for i, c in enumerate(INTS)])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"s__{i}").alias("std_sample"),
                                        F.col(f"p__{i}").alias("std_population"))
                               for i, c in enumerate(INTS)]))
    return rounded(agg.select(rows.alias("r")).select("r.*"))


@query("median_exact", sql=union_sql(
    "SELECT '{c}' AS feature, round(quantile_cont({c}, 0.5), 6) AS median FROM ctr", INTS))
def median_exact(spark, sf_dir):
    """Midpoint median of the non-null values (exact)."""
    df = ctr_frame(spark, sf_dir)
    q = exact_quantiles(df, INTS, [0.5])
    return rounded(spark.createDataFrame([(c, q[(c, 0.5)]) for c in INTS], "feature string, median double"))


@query("median_lower", sql=union_sql(
    "SELECT '{c}' AS feature, round(quantile_disc({c}, 0.5), 6) AS median FROM ctr", INTS))
def median_lower(spark, sf_dir):
    """A12 at relative error 0: the lower median (an actual element), which
    is what the median imputer fills."""
    df = ctr_frame(spark, sf_dir)
    q = exact_quantiles(df, INTS, [0.5], interpolation="lower")
    return rounded(spark.createDataFrame([(c, q[(c, 0.5)]) for c in INTS], "feature string, median double"))


@query("median_approx", sql=union_sql(
    "SELECT '{c}' AS feature, count({c}) AS n, true AS within FROM ctr", INTS))
def median_approx(spark, sf_dir):
    """A12 at the reference's relative error 0.001: whether each approximate
    median's rank lies within 0.001 n of the middle (its rows reach from the
    first to the last rank of its value)."""
    df = ctr_frame(spark, sf_dir)
    cols = [F.col(c) for c in INTS]
    approx = df.agg(*[F.percentile_approx(x, 0.5, 1000).alias(c) for c, x in zip(INTS, cols)]).first()
    aggs = []
    for i, x in enumerate(cols):
        m = F.lit(approx[INTS[i]])
        below, upto, n = F.count_if(x < m), F.count_if(x <= m), F.count(x)
        close = (below <= n * 0.501 + 1) & (upto >= n * 0.499 - 1) & (upto > below)
        aggs.append(F.struct(F.lit(INTS[i]).alias("feature"), n.alias("n"), close.alias("within")).alias(f"r{i}"))
    return df.agg(*aggs).select(F.explode(F.array(*[F.col(f"r{i}") for i in range(len(INTS))])).alias("r")).select("r.*")


@query("null_pct", sql="""
SELECT row_id // 4000 AS block, count(*) FILTER (WHERE row_id % 4000 < 107) AS n_null,
       CAST(printf('%.2f', 100.0::DOUBLE * (count(*) FILTER (WHERE row_id % 4000 < 107)) / count(*)) AS DOUBLE) AS pct_null
FROM ctr GROUP BY block""")
def null_pct(spark, sf_dir):
    """P8 + A4 on near ties: 107 of 4,000 is 2.675 %, whose double lies below it, so 2.67."""
    df = ctr_frame(spark, sf_dir)
    n_null = F.count_if(F.col("row_id") % 4000 < 107)
    return df.groupBy(F.floor(F.col("row_id") / 4000).alias("block")).agg(
        n_null.alias("n_null"), PR.pct_of(n_null, F.count(F.lit(1))).alias("pct_null"))


@query("rate_by_missing", sql=union_sql(
    "SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    "round(avg(target) FILTER (WHERE {c} IS NULL), 6) AS rate_missing, "
    "count(*) FILTER (WHERE {c} IS NOT NULL) AS n_present, "
    "round(avg(target) FILTER (WHERE {c} IS NOT NULL), 6) AS rate_present FROM ctr", FEATURES))
def rate_by_missing(spark, sf_dir):
    return rounded(PR.rate_by_missing(ctr_frame(spark, sf_dir), FEATURES, "target"))


@query("rate_by_value", sql="""
SELECT int_1 AS value, count(*) AS n, round(count(*) / (SELECT count(*) FROM ctr), 6) AS share,
       round(avg(target), 6) AS rate
FROM ctr GROUP BY int_1""")
def rate_by_value(spark, sf_dir):
    return rounded(PR.rate_by_value(ctr_frame(spark, sf_dir), "int_1", "target"))


@query("fill_missing", sql="SELECT row_id, " + ", ".join(
    f"coalesce({c}, 'missing') AS {c}" for c in CATS) + " FROM ctr")
def fill_missing(spark, sf_dir):
    return C.fill_missing(ctr_frame(spark, sf_dir), CATS).select("row_id", *CATS)


@query("log1p_clip", sql="SELECT row_id, " + ", ".join(
    f"round(ln(1 + CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END), 6) AS {c}" for c in S.skewed) + " FROM ctr")
def log1p_clip(spark, sf_dir):
    return rounded(C.log1p_clip(ctr_frame(spark, sf_dir), S.skewed).select("row_id", *S.skewed))


@query("missing_flags", sql="SELECT row_id, " + ", ".join(
    f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS {c}_was_missing" for c in S.flag_cols)
    + " FROM ctr")
def missing_flags(spark, sf_dir):
    return C.missing_flags(ctr_frame(spark, sf_dir), S.flag_cols).select("row_id", *S.missing_flag_cols)


@query("sentinel_flags", sql="""
SELECT row_id,
       CASE WHEN int_1 = -1 THEN 1.0 ELSE 0.0 END::DOUBLE AS int_1_is_neg1,
       CASE WHEN int_1 = -2 THEN 1.0 ELSE 0.0 END::DOUBLE AS int_1_is_neg2
FROM ctr""")
def sentinel_flags(spark, sf_dir):
    df = C.sentinel_flags(ctr_frame(spark, sf_dir), S.sentinel_col, S.sentinels)
    return df.select("row_id", *S.sentinel_flag_cols)


@query("clean_engineer", sql="SELECT row_id, target, " + ", ".join(
    [f"round(ln(1 + CASE WHEN {c} < 0 THEN 0.0 ELSE {c} END), 6) AS {c}" if c in S.skewed
     else f"round({c}, 6) AS {c}" for c in INTS]
    + [f"coalesce({c}, 'missing') AS {c}" for c in CATS]
    + [f"CASE WHEN {c} IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS {c}_was_missing" for c in S.flag_cols]
    + ["CASE WHEN int_1 = -1 THEN 1.0 ELSE 0.0 END::DOUBLE AS int_1_is_neg1",
       "CASE WHEN int_1 = -2 THEN 1.0 ELSE 0.0 END::DOUBLE AS int_1_is_neg2"]) + " FROM ctr")
def clean_engineer(spark, sf_dir):
    """P1-P4 together in one projection, flags from the raw values."""
    df = C.clean(ctr_frame(spark, sf_dir), S, indicators=True)
    return rounded(df.select("row_id", "target", *INTS, *CATS, *S.indicator_cols))


@query("row_tokens", sql="SELECT row_id, " + ", ".join(
    f"'{c}=' || coalesce({c}, 'missing') AS tok_{c}" for c in CATS) + " FROM ctr")
def row_tokens(spark, sf_dir):
    df = C.fill_missing(ctr_frame(spark, sf_dir), CATS)
    return C.row_tokens(df, CATS, keep=["row_id"])


@query("profile_fused_nulls", sql=union_sql(
    "SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    "CAST(printf('%.2f', 100.0::DOUBLE * (count(*) FILTER (WHERE {c} IS NULL)) / count(*)) AS DOUBLE) AS pct_null FROM ctr",
    FEATURES))
def profile_fused_nulls(spark, sf_dir):
    """A3 + A4 from the job's fused profile aggregate."""
    return PR.profile_summary(ctr_frame(spark, sf_dir), "target", FEATURES, INTS)["null_profile"]


@query("profile_fused_rates", sql=union_sql(
    "SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_missing, "
    "round(avg(target) FILTER (WHERE {c} IS NULL), 6) AS rate_missing, "
    "count(*) FILTER (WHERE {c} IS NOT NULL) AS n_present, "
    "round(avg(target) FILTER (WHERE {c} IS NOT NULL), 6) AS rate_present FROM ctr", FEATURES))
def profile_fused_rates(spark, sf_dir):
    """A8 from the job's fused profile aggregate."""
    return rounded(PR.profile_summary(ctr_frame(spark, sf_dir), "target", FEATURES, INTS)["rate_by_missing"])


@query("profile_sink_roundtrip", sql=union_sql(
    "SELECT '{c}' AS feature, count(*) FILTER (WHERE {c} IS NULL) AS n_null, "
    "CAST(printf('%.2f', 100.0::DOUBLE * (count(*) FILTER (WHERE {c} IS NULL)) / count(*)) AS DOUBLE) AS pct_null FROM ctr",
    FEATURES))
def profile_sink_roundtrip(spark, sf_dir):
    """S3: the null profile written as JSON into the shared folder and read back."""
    path = io.write_profile(PR.null_profile(ctr_frame(spark, sf_dir), FEATURES), scratch_path(spark, "eda"))
    return spark.read.schema("feature string, n_null bigint, pct_null double").json(path)


@query("profile_fused_classes", sql="SELECT target, count(*) AS n FROM ctr GROUP BY target")
def profile_fused_classes(spark, sf_dir):
    """A2 from the job's fused profile aggregate."""
    return PR.profile_summary(ctr_frame(spark, sf_dir), "target", FEATURES, INTS)["class_balance"]


@query("positive_rate_null_target", sql="""
SELECT count(*) AS n_rows, count(*) FILTER (WHERE t = 1) AS n_pos,
       round(CASE WHEN count(DISTINCT coalesce(t, -1)) > 1
                  THEN (count(*) FILTER (WHERE t = 1)) / count(*) ELSE -1.0::DOUBLE END, 6) AS positive_rate
FROM (SELECT CASE WHEN target = 1 THEN 1 END AS t FROM ctr)""")
def positive_rate_null_target(spark, sf_dir):
    """A5 where the target is 1 or null: null is a group."""
    df = ctr_frame(spark, sf_dir).select(F.when(F.col("target") == 1, 1).alias("t"))
    return rounded(PR.positive_rate(df, "t"))
