"""Profiling (A1-A9): shape, class balance, nulls, numeric profile and
target rates, each as one aggregate over the table, returned in long form.

The reference runs one job per column (39 null counts); here every profile
is a single aggregate with map-side partial aggregation, unpivoted after
the aggregate so the shuffle carries one row per partition.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

from .quantiles import exact_quantiles, first_brackets


def _unpivot_row(agg: DataFrame, names: list[str], fields: list[str],
                 name_col: str = "feature") -> DataFrame:
    """Turn a one-row aggregate with columns ``<field>__<i>`` into rows
    ``(feature, field...)``: one row per input column."""
    rows = F.explode(F.array(*[
        F.struct(F.lit(n).alias(name_col), *[F.col(f"{f}__{i}").alias(f) for f in fields])
        for i, n in enumerate(names)])).alias("r")
    return agg.select(rows).select("r.*")


def row_count(df: DataFrame) -> DataFrame:
    """A1: ``n_rows``."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def dataset_shape(df: DataFrame) -> DataFrame:
    """Rows and columns."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.lit(len(df.columns)).alias("n_columns"))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    """A2 + O1: rows per target value, ordered by target (nulls first)."""
    return (df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
              .orderBy(F.col(target).asc_nulls_first()))


def pct_of(n, total):
    """P8 + A4: ``100 * n / total`` to two digits; null on an empty table.

    The double's exact binary value is rounded (2.675 is a little less than
    that and gives 2.67), ties to the even digit, as the reference's driver
    does it; ``round`` and ``bround`` would round its shortest decimal form."""
    return F.format_number(n * 100.0 / F.nullif(total, F.lit(0)), 2).cast("double")


def several_classes(target: Column) -> Column:
    """A5: whether the target has at least two groups, null being one."""
    n_null = F.count_if(target.isNull())
    return F.coalesce(F.min(target) != F.max(target), F.lit(False)) | ((n_null > 0) & (n_null < F.count(F.lit(1))))


def null_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """A3 + A4 (+F1): ``(feature, n_null, pct_null)`` in one job.

    NaN is not null (the reference's ``isNull``); ``pct_null`` is null on
    an empty table instead of a division by zero."""
    n = F.count(F.lit(1))
    aggs = [n.alias("n__")]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"n_null__{i}") for i, c in enumerate(cols)]
    agg = df.agg(*aggs)
    long = _unpivot_row(agg.withColumns({f"n_rows__{i}": F.col("n__") for i in range(len(cols))}),
                        cols, ["n_null", "n_rows"])
    return long.select(
        "feature", "n_null",
        pct_of(F.col("n_null"), F.col("n_rows")).alias("pct_null"))


def positive_rate(df: DataFrame, target: str, positive=1) -> DataFrame:
    """A5: share of rows whose target equals ``positive`` (by value, not by
    position in the class table); -1.0 when fewer than two groups of the
    target occur (null is a group), as the reference prints."""
    t = F.col(target)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(t == F.lit(positive)).alias("n_pos"),
        several_classes(t).alias("several"),
    ).select(
        "n_rows", "n_pos",
        F.when(F.col("several"), F.col("n_pos") / F.col("n_rows"))
         .otherwise(F.lit(-1.0)).alias("positive_rate"))


def numeric_profile(df: DataFrame, cols: list[str], exact: bool = True,
                    relative_error: float = 0.001) -> DataFrame:
    """``(feature, n, mean, stddev, min, median, p75, max)``.

    Moments come from one aggregate. Quantiles are exact (narrowed brackets,
    see ``quantiles``) or ``percentile_approx`` in the same
    aggregate when ``exact=False``."""
    spark = df.sparkSession
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.count(x).alias(f"n__{i}"), F.avg(x).alias(f"mean__{i}"),
                 F.stddev_samp(x).alias(f"stddev__{i}"), F.min(x).alias(f"min__{i}"),
                 F.max(x).alias(f"max__{i}")]
        if not exact:
            acc = int(round(1.0 / relative_error))
            q = F.percentile_approx(x, [0.5, 0.75], acc)
            aggs += [q[0].alias(f"median__{i}"), q[1].alias(f"p75__{i}")]
    fields = ["n", "mean", "stddev", "min", "max"]
    if not exact:
        long = _unpivot_row(df.agg(*aggs), cols, fields + ["median", "p75"])
        return long.select("feature", "n", "mean", "stddev", "min", "median", "p75", "max")
    # the moments aggregate doubles as the first pass of the exact quantiles; their first sketches are
    # built in levels, so in a job of their own beside it
    probs = [0.5, 0.75]
    with ThreadPoolExecutor(max_workers=1) as pool:
        sketching = pool.submit(first_brackets, df, cols, probs)
        row = df.agg(*aggs).first()
        ends = sketching.result()
    stats = {c: (row[f"n__{i}"], row[f"min__{i}"], row[f"max__{i}"]) for i, c in enumerate(cols)}
    q = exact_quantiles(df, cols, probs, stats=stats, ends=ends)
    rows = [(c, row[f"n__{i}"], row[f"mean__{i}"], row[f"stddev__{i}"], row[f"min__{i}"],
             q[(c, 0.5)], q[(c, 0.75)], row[f"max__{i}"]) for i, c in enumerate(cols)]
    return spark.createDataFrame(rows, "feature string, n bigint, mean double, stddev double, min double, "
                                       "median double, p75 double, max double")


def rate_by_missing(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Target rate where each column is null vs not null, one job:
    ``(feature, n_missing, rate_missing, n_present, rate_present)``."""
    t = F.col(target).cast("double")
    aggs = []
    for i, c in enumerate(cols):
        miss: Column = F.col(c).isNull()
        aggs += [F.count_if(miss).alias(f"n_missing__{i}"),
                 F.avg(F.when(miss, t)).alias(f"rate_missing__{i}"),
                 F.count_if(~miss).alias(f"n_present__{i}"),
                 F.avg(F.when(~miss, t)).alias(f"rate_present__{i}")]
    return _unpivot_row(df.agg(*aggs), cols,
                        ["n_missing", "rate_missing", "n_present", "rate_present"])


def rate_by_value(df: DataFrame, col: str, target: str) -> DataFrame:
    """Rows, share of rows and target rate per value of ``col``.

    The share's denominator is the sum of the grouped counts, so the table
    is scanned once."""
    g = cut_lineage(df.groupBy(col).agg(F.count(F.lit(1)).alias("n"),
                                        F.avg(F.col(target).cast("double")).alias("rate")))
    total = g.agg(F.sum("n")).first()[0]
    share = F.col("n") / F.lit(total) if total else F.lit(None).cast("double")
    return g.select(F.col(col).alias("value"), "n", share.alias("share"), "rate")


def profile_summary(df: DataFrame, target: str, cols: list[str], numeric=()) -> dict[str, DataFrame]:
    """The whole profile of the reference job (A1-A6, A8 and moments of A7)
    from ONE aggregate over the table. The class table (A2) comes from the
    same aggregate when the target holds only 0, 1 and null (one grouped job
    otherwise). Returns small local frames: ``shape``, ``class_balance``,
    ``positive_rate``, ``null_profile``, ``rate_by_missing``, ``moments``."""
    spark = df.sparkSession
    t = F.col(target)
    td = t.cast("double")
    aggs = [F.count(F.lit(1)).alias("n"), F.count_if(t == 1).alias("n1"), F.count_if(t == 0).alias("n0"),
            F.count_if(t.isNull()).alias("nnull"), F.count_if(t.isNotNull() & ~t.isin(0, 1)).alias("nother"), several_classes(t).alias("several")]
    for i, c in enumerate(cols):
        miss = F.col(c).isNull()
        aggs += [F.count_if(miss).alias(f"m{i}"), F.avg(F.when(miss, td)).alias(f"rm{i}"),
                 F.avg(F.when(~miss, td)).alias(f"rp{i}")]
    for i, c in enumerate(numeric):
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        aggs += [F.count(x).alias(f"xn{i}"), F.avg(x).alias(f"xa{i}"), F.stddev_samp(x).alias(f"xs{i}"),
                 F.min(x).alias(f"xl{i}"), F.max(x).alias(f"xh{i}")]
    r = df.agg(*aggs).first()
    n = r["n"]
    if r["nother"]:
        balance = class_balance(df, target)  # labels beyond 0/1: one more grouped job
    else:
        ttype = df.schema[target].dataType.simpleString()
        rows = [(v, r[k]) for v, k in ((None, "nnull"), (0, "n0"), (1, "n1")) if r[k]]
        balance = spark.createDataFrame(rows, f"{target} {ttype}, n bigint")
    return {
        "class_balance": balance,
        "shape": spark.createDataFrame([(n, len(df.columns))], "n_rows bigint, n_columns int"),
        "positive_rate": spark.createDataFrame(
            [(n, r["n1"], (r["n1"] / n) if r["several"] else -1.0)],
            "n_rows bigint, n_pos bigint, positive_rate double"),
        "null_profile": spark.createDataFrame(
            [(c, r[f"m{i}"], n) for i, c in enumerate(cols)], "feature string, n_null bigint, n bigint")
            .select("feature", "n_null", pct_of(F.col("n_null"), F.col("n")).alias("pct_null")),
        "rate_by_missing": spark.createDataFrame(
            [(c, r[f"m{i}"], r[f"rm{i}"], n - r[f"m{i}"], r[f"rp{i}"]) for i, c in enumerate(cols)],
            "feature string, n_missing bigint, rate_missing double, n_present bigint, rate_present double"),
        "moments": spark.createDataFrame(
            [(c, r[f"xn{i}"], r[f"xa{i}"], r[f"xs{i}"], r[f"xl{i}"], r[f"xh{i}"]) for i, c in enumerate(numeric)],
            "feature string, n bigint, mean double, stddev double, min double, max double"),
    }
