"""Evaluation (A10, A11, V1-V9, O3) over a scored table.

A scored table has a label column, a class-1 score and a 0/1 prediction,
plus optional group columns (model, split). Everything is per group.

Ranking metrics (AUC-ROC, AUC-PR, average precision, ROC curve) are exact:
no down-sampling to bins. They need, for each distinct score, the positives
and negatives at or above it. The design:

1. ``groupBy(group, score)`` -> (pos, neg): partial aggregation folds hot
   scores (one value held by a third of the rows is one row);
2. the distinct-score table is cut into balanced buckets by approximate
   quantiles of a per-group normalised key (monotone in the score, so
   bucket order is score order) and bucketed by binary search;
3. totals per bucket (<= buckets x groups rows) -> offsets by a window over
   that small table -> broadcast join;
4. running sums inside each (group, bucket) window partition.

No window ever spans a whole group; the largest window partition is one
bucket of distinct scores.
"""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import BROADCAST_MAX_ROWS, broadcast_if_bounded, cut_lineage

METRIC_NAMES = ("AUC_ROC", "AUC_PR", "Accuracy", "F1", "Weighted_Precision", "Weighted_Recall")
DEFAULT_THRESHOLDS = tuple(i / 10.0 for i in range(11))
POINTS_PER_BUCKET = 200_000
MAX_BUCKETS = 65536  # 1e12 distinct scores -> ~1.5e7 per window partition (spillable)


def _div(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b.cast("double"))


PRED_CELLS = ("_p0n", "_p0p", "_p1n", "_p1p")  # (prediction, label) counts: 0/neg, 0/pos, 1/neg, 1/pos


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match (a null group is a group)."""
    right = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    cond = None
    for c in on:
        part = left[c].eqNullSafe(right[f"__r_{c}"])
        cond = part if cond is None else cond & part
    return left.join(right, cond, how).drop(*[f"__r_{c}" for c in on])


def score_points(scored: DataFrame, label: str, score: str, groups=(),
                 prediction: str | None = None) -> DataFrame:
    """(groups..., score, pos, neg) per distinct score; rows whose label is
    neither 0 nor 1 (e.g. null) are not counted. With ``prediction`` the
    counts are also split by predicted class (``PRED_CELLS``)."""
    lab = F.col(label)
    aggs = [F.count_if(lab == 1).alias("_pos"), F.count_if(lab == 0).alias("_neg")]
    if prediction:
        p = F.col(prediction)
        aggs += [F.count_if((p == 0) & (lab == 0)).alias("_p0n"), F.count_if((p == 0) & (lab == 1)).alias("_p0p"),
                 F.count_if((p == 1) & (lab == 0)).alias("_p1n"), F.count_if((p == 1) & (lab == 1)).alias("_p1p")]
    return (scored.where(F.col(score).isNotNull())
                  .groupBy(*groups, F.col(score).alias("_s")).agg(*aggs)
                  .where((F.col("_pos") + F.col("_neg")) > 0))


def _grouped(df: DataFrame, groups) -> tuple[DataFrame, list[str], list[str]]:
    """Add a constant group column when there are no groups, so every
    operator below is an equi-join / partitioned window on group keys."""
    groups = list(groups)
    if groups:
        return df, groups, []
    return df.withColumn("_all", F.lit(0)), ["_all"], ["_all"]


def ranked_points(scored: DataFrame, label: str, score: str, groups,
                  persist: bool | str = True, prediction: str | None = None
                  ) -> tuple[DataFrame, DataFrame, DataFrame | None]:
    """Distinct scores with running ``_tp``/``_fp`` (counts at or above the
    score) and the per-group totals ``_P``/``_N``. ``groups`` must be
    non-empty (see ``_grouped``). With ``persist=True`` the distinct-score
    table is cached for the passes below and returned so the caller can
    release it once its result is materialised; ``persist="checkpoint"``
    writes it once to the shared checkpoint folder instead (for lazily
    consumed results, which cannot release a cache)."""
    groups = list(groups)
    pts = score_points(scored, label, score, groups, prediction)
    extra = list(PRED_CELLS) if prediction else []
    if persist == "checkpoint":
        pts = cut_lineage(pts)
        persist = False
    elif persist:
        pts = pts.persist()
    # NaN ranks above every number, as in Spark's ordering; buckets span the finite scores only
    finite = F.when(~F.isnan("_s") & (F.abs("_s") < F.lit(float("inf"))), F.col("_s"))
    gs = pts.groupBy(*groups).agg(
        F.min(finite).alias("_lo"), F.max(finite).alias("_hi"),
        F.sum("_pos").alias("_P"), F.sum("_neg").alias("_N"),
        F.count(F.lit(1)).alias("_npts"))
    gs = cut_lineage(gs)  # one row per group (model x split)
    n_groups, total_pts = gs.agg(F.count(F.lit(1)), F.coalesce(F.sum("_npts"), F.lit(0))).first()
    n_buckets = int(min(MAX_BUCKETS, max(1, total_pts // POINTS_PER_BUCKET)))
    gtab = gs.withColumn("_gi", F.row_number().over(Window.orderBy(*groups)) - 1)
    keyed = null_safe_join(pts, broadcast_if_bounded(gtab, BROADCAST_MAX_ROWS, bound=n_groups), groups)
    w_all = (Window.partitionBy(*groups).orderBy(F.col("_s").desc())
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    if n_buckets == 1:
        # few distinct scores: one window partition per group is small
        ranked = keyed.select(*groups, F.lit(0).alias("_bk"), "_s", "_pos", "_neg", "_P", "_N", *extra,
                              F.sum("_pos").over(w_all).alias("_tp"), F.sum("_neg").over(w_all).alias("_fp"))
        return ranked, gs, (pts if persist else None)
    half_span = F.col("_hi") / 2 - F.col("_lo") / 2  # halves: the whole may overflow
    inside = F.least(F.greatest((F.col("_s") / 2 - F.col("_lo") / 2) / half_span, F.lit(0.0)), F.lit(1.0))
    # monotone non-decreasing in the score inside a group, disjoint across groups
    key = F.col("_gi") * 2.0 + (F.when(F.isnan("_s"), F.col("_s")).when(F.col("_s") > F.col("_hi"), 1.0)
                                .when(F.col("_s") < F.col("_lo"), 0.0).when(half_span > 0, inside).otherwise(0.0))
    keyed = keyed.withColumn("_key", key)
    probs = [i / n_buckets for i in range(1, n_buckets)]
    qs = keyed.approxQuantile("_key", probs, 1.0 / (4 * n_buckets))
    splits = sorted(set([float("-inf")] + list(qs) + [float("inf")]))
    # NaN keys (NaN scores) land in an extra, highest bucket
    keyed = Bucketizer(splits=splits, inputCol="_key", outputCol="_bk", handleInvalid="keep").transform(keyed)
    keyed = keyed.withColumn("_bk", F.col("_bk").cast("int")).drop("_key")
    part = groups + ["_bk"]
    tot = keyed.groupBy(*part).agg(F.sum("_pos").alias("_bp"), F.sum("_neg").alias("_bn"))
    above = (Window.partitionBy(*groups).orderBy(F.col("_bk").desc())
             .rowsBetween(Window.unboundedPreceding, -1))
    offs = tot.select(*part,
                      F.coalesce(F.sum("_bp").over(above), F.lit(0)).alias("_pa"),
                      F.coalesce(F.sum("_bn").over(above), F.lit(0)).alias("_na"))
    offs = broadcast_if_bounded(offs, BROADCAST_MAX_ROWS, bound=n_buckets * max(1, n_groups))
    w = (Window.partitionBy(*part).orderBy(F.col("_s").desc())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = (null_safe_join(keyed, offs, part)
                   .select(*groups, "_bk", "_s", "_pos", "_neg", "_P", "_N", *extra,
                           (F.col("_pa") + F.sum("_pos").over(w)).alias("_tp"),
                           (F.col("_na") + F.sum("_neg").over(w)).alias("_fp")))
    return ranked, gs, (pts if persist else None)


def _ranking_sums() -> list:
    """Per-group sums over ranked points giving AUC-ROC (exact integer
    numerator; decimal(38,0) holds P*N for ~1e19 rows), AUC-PR (trapezoid
    from (0, first precision)) and average precision."""
    tp, fp, pos, neg = F.col("_tp"), F.col("_fp"), F.col("_pos"), F.col("_neg")
    P = F.col("_P")
    tp0, fp0 = tp - pos, fp - neg
    auc_num = neg.cast("decimal(38,0)") * (tp0 * 2 + pos).cast("decimal(38,0)")
    prec = _div(tp, tp + fp)
    prec0 = F.when((tp0 + fp0) == 0, prec).otherwise(_div(tp0, tp0 + fp0))
    rec, rec0 = _div(tp, P), _div(tp0, P)
    return [F.sum(auc_num).alias("_auc_num"), F.first(P).alias("n_pos"), F.first(F.col("_N")).alias("n_neg"),
            F.sum((rec - rec0) * (prec + prec0) / 2.0).alias("_pr"), F.sum(_div(pos, P) * prec).alias("_ap")]


def _ranking_values(r) -> tuple[float, float, float]:
    n_pos, n_neg = r["n_pos"], r["n_neg"]
    auc = 0.0 if not n_pos or not n_neg else float(r["_auc_num"]) / (2.0 * n_pos * n_neg)
    return auc, (r["_pr"] if n_pos else 0.0), (r["_ap"] if n_pos else 0.0)


def ranking_metrics(scored: DataFrame, label: str, score: str, groups=()) -> DataFrame:
    """V1-V3 per group: ``auc_roc`` (trapezoid over all distinct scores,
    ties count half = Spark's evaluator with numBins=0), ``auc_pr`` (Spark's
    trapezoid over (recall, precision) starting at (0, first precision)),
    ``avg_precision`` (step sum of precision x recall increments, the
    single-machine twin's number), plus ``n_pos``/``n_neg``. A group with a
    single class gets 0.0.

    The result (one row per group) is materialised here so the cached
    distinct-score table can be released at once."""
    scored, groups, dummy = _grouped(scored, groups)
    ranked, _, pts = ranked_points(scored, label, score, groups)
    agg = ranked.groupBy(*groups).agg(*_ranking_sums())
    denom = (F.col("n_pos").cast("double") * F.col("n_neg").cast("double") * 2.0)
    one_class = (F.col("n_pos") == 0) | (F.col("n_neg") == 0)
    res = agg.select(
        *groups,
        F.when(one_class, 0.0).otherwise(F.col("_auc_num").cast("double") / denom).alias("auc_roc"),
        F.when(F.col("n_pos") == 0, 0.0).otherwise(F.col("_pr")).alias("auc_pr"),
        F.when(F.col("n_pos") == 0, 0.0).otherwise(F.col("_ap")).alias("avg_precision"),
        F.col("n_pos").cast("bigint").alias("n_pos"), F.col("n_neg").cast("bigint").alias("n_neg")
    ).drop(*dummy)
    return _materialise(res, pts)


def _materialise(df: DataFrame, *cached) -> DataFrame:
    """Collect a small per-group result into a local frame and release the
    cached inputs it was computed from."""
    try:
        rows = df.collect()
    finally:
        for c in cached:
            if c is not None:
                c.unpersist()
    return df.sparkSession.createDataFrame(rows, df.schema)


def roc_curve(scored: DataFrame, label: str, score: str, groups=(),
              drop_collinear: bool = False) -> DataFrame:
    """V9: one point per distinct score, in descending score order, plus the
    origin (threshold null). ``(groups..., threshold, tp, fp, tpr, fpr)``.

    ``drop_collinear`` drops a point whose increment equals the next
    point's (second difference zero), keeping the first and last point,
    like the single-machine twin's curve."""
    scored, groups, dummy = _grouped(scored, groups)
    ranked, gs, _ = ranked_points(scored, label, score, groups, persist="checkpoint")
    pts = ranked
    if drop_collinear:
        # the next point (lower score) inside the bucket, or the first point
        # of the next lower bucket, taken from a table of bucket heads
        heads = (ranked.groupBy(*groups, "_bk")
                       .agg(F.max_by(F.struct("_pos", "_neg"), "_s").alias("_h")))
        nxt = Window.partitionBy(*groups).orderBy(F.col("_bk").desc())
        heads = heads.select(*groups, F.lag("_bk").over(nxt).alias("_bk"),
                             F.col("_h._pos").alias("_hpos"), F.col("_h._neg").alias("_hneg")) \
                     .where(F.col("_bk").isNotNull())
        heads = broadcast_if_bounded(heads, BROADCAST_MAX_ROWS)
        w = Window.partitionBy(*groups, "_bk").orderBy(F.col("_s").desc())
        with_next = (ranked.withColumns({"_npos": F.lead("_pos").over(w), "_nneg": F.lead("_neg").over(w)})
                           .transform(lambda d: null_safe_join(d, heads, groups + ["_bk"], "left"))
                           .withColumns({"_npos": F.coalesce("_npos", "_hpos"),
                                         "_nneg": F.coalesce("_nneg", "_hneg")}))
        first = (F.col("_tp") == F.col("_pos")) & (F.col("_fp") == F.col("_neg"))
        last = F.col("_npos").isNull()
        same = (F.col("_npos") == F.col("_pos")) & (F.col("_nneg") == F.col("_neg"))
        pts = with_next.where(first | last | ~same)
    body = pts.select(*groups, F.col("_s").alias("threshold"),
                      F.col("_tp").cast("bigint").alias("tp"), F.col("_fp").cast("bigint").alias("fp"),
                      F.coalesce(_div(F.col("_tp"), F.col("_P")), F.lit(0.0)).alias("tpr"),
                      F.coalesce(_div(F.col("_fp"), F.col("_N")), F.lit(0.0)).alias("fpr"))
    origin = gs.select(*groups, F.lit(None).cast("double").alias("threshold"),
                       F.lit(0).cast("bigint").alias("tp"), F.lit(0).cast("bigint").alias("fp"),
                       F.lit(0.0).alias("tpr"), F.lit(0.0).alias("fpr"))
    return origin.unionByName(body).drop(*dummy)


def confusion_matrix(scored: DataFrame, label: str, prediction: str = "prediction",
                     groups=(), classes=(0, 1), weight: str | None = None) -> DataFrame:
    """A10: ``(groups..., label, prediction, n)`` with every cell of the
    classes x classes grid present (0 when unseen); cells with other labels
    or predictions are kept too."""
    scored, groups, dummy = _grouped(scored, groups)
    n = F.sum(weight) if weight else F.count(F.lit(1))
    counts = scored.groupBy(*groups, label, F.col(prediction).cast("double").alias("prediction")) \
                   .agg(n.alias("n"))
    cells = F.array(*[F.struct(F.lit(t).cast(scored.schema[label].dataType).alias(label),
                               F.lit(float(p)).alias("prediction"))
                      for t in classes for p in classes])
    keys = counts.select(*groups).distinct()
    grid = keys.select(*groups, F.explode(cells).alias("_c")).select(*groups, f"_c.{label}", "_c.prediction")
    on = groups + [label, "prediction"]
    return (grid.join(counts, on, "full_outer")
                .select(*on, F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
                .drop(*dummy))


def weighted_metrics(confusion: DataFrame, label: str, groups=()) -> DataFrame:
    """V4-V7 from a confusion table: ``accuracy``, ``weighted_precision``,
    ``weighted_recall``, ``f1`` (per-class values weighted by true-class
    share; precision 0 for a never-predicted class; Spark's definitions)."""
    groups = list(groups)
    c = confusion.withColumn("_lab", F.col(label).cast("double"))
    truth = c.groupBy(*groups, "_lab").agg(
        F.sum("n").alias("_true"),
        F.sum(F.when(F.col("_lab") == F.col("prediction"), F.col("n")).otherwise(0)).alias("_tp"))
    pred = c.groupBy(*groups, F.col("prediction").alias("_lab")).agg(F.sum("n").alias("_pred"))
    per = null_safe_join(truth.where(F.col("_true") > 0), pred, groups + ["_lab"], "left")
    p = F.coalesce(_div(F.col("_tp"), F.col("_pred")), F.lit(0.0))
    r = _div(F.col("_tp"), F.col("_true"))
    per = per.withColumns({"_p": p, "_r": r})
    f1 = F.when((F.col("_p") + F.col("_r")) == 0, 0.0) \
          .otherwise(2.0 * F.col("_p") * F.col("_r") / (F.col("_p") + F.col("_r")))
    per = per.withColumn("_f1", f1)
    total = F.sum("_true")
    return per.groupBy(*groups).agg(
        (F.sum("_tp") / total).alias("accuracy"),
        (F.sum(F.col("_p") * F.col("_true")) / total).alias("weighted_precision"),
        (F.sum(F.col("_r") * F.col("_true")) / total).alias("weighted_recall"),
        (F.sum(F.col("_f1") * F.col("_true")) / total).alias("f1"))


def _sweep(df: DataFrame, label: str, thresholds, at_or_above, weight: F.Column, groups) -> DataFrame:
    lab = F.col(label)

    def total(cond):
        return F.sum(F.when(cond, weight).otherwise(F.lit(0))).cast("bigint")
    aggs = [total(lab == 1).alias("_P"), total(lab == 0).alias("_N")]
    for i, t in enumerate(thresholds):
        aggs += [total(at_or_above(i, t) & (lab == 1)).alias(f"_tp{i}"),
                 total(at_or_above(i, t) & (lab == 0)).alias(f"_fp{i}")]
    agg = df.groupBy(*groups).agg(*aggs)
    rows = F.explode(F.array(*[
        F.struct(F.lit(float(t)).alias("threshold"), F.col(f"_tp{i}").alias("tp"),
                 F.col(f"_fp{i}").alias("fp"))
        for i, t in enumerate(thresholds)])).alias("r")
    long = agg.select(*groups, "_P", "_N", rows).select(*groups, "_P", "_N", "r.*")
    return long.select(
        *groups, "threshold", "tp", "fp",
        F.when(F.col("_P") > 0, F.col("tp") / F.col("_P")).otherwise(0.0).alias("tpr"),
        F.when(F.col("_N") > 0, F.col("fp") / F.col("_N")).otherwise(0.0).alias("fpr"))


def threshold_sweep(scored: DataFrame, label: str, score: str,
                    thresholds=DEFAULT_THRESHOLDS, groups=()) -> DataFrame:
    """A11 (F2, F3): ``(groups..., threshold, tp, fp, tpr, fpr)`` for
    ``score >= t``, all thresholds in one conditional aggregate; a rate is
    0.0 when its class is empty."""
    s = F.col(score)
    return _sweep(scored, label, thresholds, lambda i, t: s >= F.lit(float(t)), F.lit(1), list(groups))


def weighted_from_cells(cells: dict) -> dict:
    """V4-V7 from the four (prediction, label) cells of a binary problem,
    with Spark's definitions (the same formulas as ``weighted_metrics``)."""
    n = sum(cells.values())
    out = {"accuracy": None, "weighted_precision": None, "weighted_recall": None, "f1": None}
    if not n:
        return out
    acc = wp = wr = f1 = 0.0
    for c in (0, 1):
        true_c = cells[(0, c)] + cells[(1, c)]
        if true_c == 0:
            continue
        tp = cells[(c, c)]
        pred_c = cells[(c, 0)] + cells[(c, 1)]
        p = tp / pred_c if pred_c else 0.0
        r = tp / true_c
        f = 0.0 if p + r == 0 else 2.0 * p * r / (p + r)
        acc += tp
        wp += p * true_c
        wr += r * true_c
        f1 += f * true_c
    return {"accuracy": acc / n, "weighted_precision": wp / n, "weighted_recall": wr / n, "f1": f1 / n}


def evaluate(scored: DataFrame, label: str, score: str, prediction: str = "prediction",
             groups=(), thresholds=DEFAULT_THRESHOLDS) -> dict[str, DataFrame]:
    """Every evaluation table of a scored table of a binary classifier,
    from the ranked distinct-score table in two jobs (plus the bucket
    borders when there are many distinct scores): ``ranking``, ``confusion``
    (2x2 per group), ``weighted``, ``sweep`` (A11) and ``report`` (V8).

    The confusion cells and the threshold sweep are sums over the distinct
    scores (each carries its counts per predicted class), so they ride on
    the ranking aggregate. Rows whose label is not 0/1 are not counted."""
    spark = scored.sparkSession
    scored, groups, dummy = _grouped(scored, groups)
    gfields = [scored.schema[g] for g in groups]
    ranked, _, pts = ranked_points(scored, label, score, groups, prediction=prediction)
    s = F.col("_s")
    aggs = _ranking_sums() + [F.sum(c).alias(c) for c in PRED_CELLS]
    for i, t in enumerate(thresholds):
        at = s >= F.lit(float(t))
        aggs += [F.sum(F.when(at, F.col("_pos")).otherwise(0)).alias(f"_tp{i}"),
                 F.sum(F.when(at, F.col("_neg")).otherwise(0)).alias(f"_fp{i}")]
    try:
        rows = ranked.groupBy(*groups).agg(*aggs).collect()
    finally:
        if pts is not None:
            pts.unpersist()
    lab_type = scored.schema[label].dataType
    rank_rows, conf_rows, wm_rows, sweep_rows, rep_rows = [], [], [], [], []
    names = {"AUC_ROC": 0, "AUC_PR": 1, "Accuracy": "accuracy", "F1": "f1",
             "Weighted_Precision": "weighted_precision", "Weighted_Recall": "weighted_recall",
             "Average_Precision": 2}
    for r in rows:
        g = tuple(r[x] for x in groups)
        rk = _ranking_values(r)
        P, N = int(r["n_pos"]), int(r["n_neg"])
        rank_rows.append(g + rk + (P, N))
        cells = {(0, 0): r["_p0n"], (0, 1): r["_p0p"], (1, 0): r["_p1n"], (1, 1): r["_p1p"]}
        conf_rows += [g + (lab, float(pr), int(cells[(pr, lab)])) for lab in (0, 1) for pr in (0, 1)]
        wm = weighted_from_cells(cells)
        wm_rows.append(g + (wm["accuracy"], wm["weighted_precision"], wm["weighted_recall"], wm["f1"]))
        for i, t in enumerate(thresholds):
            tp, fp = int(r[f"_tp{i}"]), int(r[f"_fp{i}"])
            sweep_rows.append(g + (float(t), tp, fp, tp / P if P else 0.0, fp / N if N else 0.0))
        for name, k in names.items():
            rep_rows.append(g + (name, float(rk[k]) if isinstance(k, int) else wm[k]))
    gs = T.StructType(gfields)

    def frame(rows_, fields):
        return spark.createDataFrame(rows_, T.StructType(gs.fields + fields)).drop(*dummy)
    D, L = T.DoubleType(), T.LongType()
    return {
        "ranking": frame(rank_rows, [T.StructField(n, D) for n in ("auc_roc", "auc_pr", "avg_precision")]
                         + [T.StructField("n_pos", L), T.StructField("n_neg", L)]),
        "confusion": frame(conf_rows, [T.StructField(label, lab_type), T.StructField("prediction", D),
                                       T.StructField("n", L)]),
        "weighted": frame(wm_rows, [T.StructField(n, D) for n in
                                    ("accuracy", "weighted_precision", "weighted_recall", "f1")]),
        "sweep": frame(sweep_rows, [T.StructField("threshold", D), T.StructField("tp", L),
                                    T.StructField("fp", L), T.StructField("tpr", D), T.StructField("fpr", D)]),
        "report": frame(rep_rows, [T.StructField("metric", T.StringType()), T.StructField("value", D)]),
    }


def classification_report(scored: DataFrame, label: str, score: str,
                          prediction: str = "prediction", groups=()) -> DataFrame:
    """V8: the six metrics of the reference per group, long form
    ``(groups..., metric, value)``, plus ``Average_Precision`` under its own
    name. Two jobs over the scored table (see ``evaluate``)."""
    return evaluate(scored, label, score, prediction, groups)["report"]
