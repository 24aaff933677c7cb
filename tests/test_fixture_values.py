"""Values published in FIXTURES.md for the sf0.01 fixture view."""

from pyspark.sql import functions as F

from propensity.operators import metrics as M
from propensity.operators import split as SP
from propensity.operators.features import ColumnScaler
from propensity.operators.quantiles import exact_quantiles


def test_view_counts(ctr01):
    r = ctr01.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("row_id").alias("d"),
                  F.sum("target").alias("pos"),
                  F.count_if(F.col("int_0").isNull()).alias("n0"), F.count_if(F.col("int_3").isNull()).alias("n3"),
                  F.count_if(F.col("cat_2").isNull()).alias("c2"), F.count_if(F.col("cat_3").isNull()).alias("c3"),
                  F.count_if(F.col("int_1") == -1).alias("m1"), F.count_if(F.col("int_2") < 0).alias("neg2"),
                  F.count_distinct("score").alias("ds")).first()
    assert (r.n, r.d, r.pos) == (10000, 10000, 2006)
    assert (r.n0, r.n3, r.c2, r.c3) == (4287, 7693, 5000, 358)
    assert (r.m1, r.neg2, r.ds) == (2000, 982, 121)


def test_ranking_metrics_of_planted_score(ctr01):
    r = M.ranking_metrics(ctr01, "target", "score").first()
    assert round(r.auc_roc, 6) == 0.673478
    assert round(r.avg_precision, 6) == 0.437062
    assert round(r.auc_pr, 6) == 0.440798


def test_confusion_at_half(ctr01):
    scored = ctr01.withColumn("prediction", (F.col("score") >= 0.5).cast("double"))
    cells = {(r.target, r.prediction): r.n for r in M.confusion_matrix(scored, "target").collect()}
    assert cells[(0, 0.0)] == 4796 and cells[(0, 1.0)] == 3198 and cells[(1, 0.0)] == 819


def test_md5_split_counts(ctr01):
    t = SP.tag_stratified_split(ctr01, "target", {0: 0.8, 1: 0.8}, 42, "row_id")
    got = {r.target: (r.n, r.s) for r in t.where("split = 'train'").groupBy("target")
           .agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("s")).collect()}
    assert got == {0: (6379, 31981085), 1: (1610, 8077314)}


def test_exact_split_counts(ctr01):
    for bits, limit in ((12, 1_000_000), (3, 50), (2, 1)):  # one pass; several refinement passes
        t = SP.tag_exact_stratified_split(ctr01, "target", 0.8, 42, "row_id", bits_per_pass=bits,
                                          max_rank_rows=limit)
        got = {r.target: (r.n, r.s) for r in t.where("split = 'train'").groupBy("target")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("row_id").alias("s")).collect()}
        assert got == {0: (6395, 32064049), 1: (1605, 8060436)}


def test_medians_and_std(ctr01):
    q = exact_quantiles(ctr01, ["int_0", "int_2"], [0.5, 0.75])
    assert q[("int_0", 0.5)] == 34.0
    assert round(q[("int_2", 0.75)], 2) == 7068.44
    low = exact_quantiles(ctr01, ["int_0"], [0.5], interpolation="lower")
    assert low[("int_0", 0.5)] == 34.0
    assert round(ColumnScaler.fit(ctr01, ["int_2"], 1).stds["int_2"], 6) == 3259.237922
    assert round(ColumnScaler.fit(ctr01, ["int_2"], 0).stds["int_2"], 6) == 3259.074956


def test_rate_by_missing_int3(ctr01):
    from propensity.operators.profile import rate_by_missing
    r = rate_by_missing(ctr01, ["int_3"], "target").first()
    assert (r.n_missing, round(r.rate_missing, 6)) == (7693, 0.199792)
    assert (r.n_present, round(r.rate_present, 6)) == (2307, 0.203294)
