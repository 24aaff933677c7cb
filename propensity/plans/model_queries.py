"""Registered queries: features, fitted models, tuning and saved models
(A12, E1-E9, M1-M10, S5/S7, O2).

Fitted models are checked exactly through saturated constructions: with one
categorical feature and no regularisation, logistic regression's probability
per category is the category's target rate; one boosting round of deep
enough trees gives ``1/(1+exp(-2(2 rate - 1)))``; a single unbootstrapped
tree predicts the majority class per category.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import ctr_frame
from ..operators import features as FE
from ..operators import models as MO
from ..operators import report as RP
from ..operators import tuning as TU
from ..operators.clean import clean
from ..operators.split import split_parts, tag_stratified_split
from ..session import scratch_path
from ..sources import io
from ..spec import LR_GRID, FoldSpec, GridSpec
from .catalog import CATS, EIGHTY, H_FOLD, H_SPLIT, INTS, S, query, rounded

SEGMENT = S.with_(int_cols=(), cat_cols=("cat_0",), skewed=(), flag_cols=(), sentinel_col=None,
                  sentinels=())
EXACT_LR = {"regParam": 0.0, "tol": 1e-10, "maxIter": 100}
PLANTED_SEGMENTS = ("BUILDING", "MACHINERY")


def _train_rows(spark, sf_dir):
    ctr = ctr_frame(spark, sf_dir)
    return split_parts(tag_stratified_split(ctr, "target", {0: 0.8, 1: 0.8}, 42, "row_id"))[0]


def _segment_model(spark, sf_dir, kind, label="target", **params):
    df = ctr_frame(spark, sf_dir)
    if label != "target":
        df = df.withColumn(label, F.when(F.col("cat_0").isin(*PLANTED_SEGMENTS), 1 - F.col("target"))
                                   .otherwise(F.col("target")))
    stages = FE.index_one_hot("cat_0", "features") + [MO.make_classifier(kind, label, **params)]
    return df, MO.fit(Pipeline(stages=stages), df, label)


# ------------------------------------------------------------------ E1 / A12
_MEDIAN_TRAIN = ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in INTS)
TRAIN_SQL = f"train AS (SELECT * FROM ctr WHERE target IN (0, 1) AND {H_SPLIT} < {EIGHTY})"


@query("impute_median", sql=f"""{TRAIN_SQL},
med AS (SELECT {_MEDIAN_TRAIN} FROM train)
SELECT row_id, {", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}_imp" for c in INTS)} FROM ctr, med""")
def impute_median(spark, sf_dir):
    """MLlib's median imputer at relative error 0, fitted on the train
    split only, applied to every row."""
    model = FE.median_imputer(INTS, relative_error=0.0).fit(_train_rows(spark, sf_dir))
    return rounded(model.transform(ctr_frame(spark, sf_dir)).select("row_id", *S.imputed_cols))


@query("impute_median_exact", sql=f"""{TRAIN_SQL},
med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in INTS)} FROM train)
SELECT row_id, {", ".join(f"round(coalesce({c}, m_{c}), 6) AS {c}_imp" for c in INTS)} FROM ctr, med""")
def impute_median_exact(spark, sf_dir):
    """E1, exact midpoint median (the single-machine twin's imputer)."""
    meds = FE.fit_medians(_train_rows(spark, sf_dir), INTS, "linear")
    return rounded(FE.impute(ctr_frame(spark, sf_dir), meds).select("row_id", *S.imputed_cols))


# ------------------------------------------------------------------ E2/E3
def _murmur3_sql(tokens: str, n: int) -> str:
    """CTEs ending in ``hashed (tok, bucket)``: MLlib's bucket of every token
    of ``tokens (tok)``, the public 32-bit murmur3 (seed 42) of its bytes."""
    m = 1 << 32
    rotl = lambda x, r: f"((({x}) << {r}) | (({x}) >> {32 - r})) % {m}"
    mixed = lambda k: f"({rotl(f'({k}) * 3432918353 % {m}', 15)}) * 461845907 % {m}"
    return f"""toks AS (SELECT DISTINCT tok FROM ({tokens}) WHERE tok IS NOT NULL),
raw AS (SELECT tok, octet_length(encode(tok)) AS n,
               list_transform(range(1, 2 * octet_length(encode(tok)), 2), lambda i: ('0x' || substr(hex(encode(tok)), i, 2))::UBIGINT) AS b FROM toks),
words AS (SELECT *, list_transform(range(n // 4), lambda i: b[4 * i + 1] + 256 * b[4 * i + 2] + 65536 * b[4 * i + 3] + 16777216 * b[4 * i + 4]) AS w,
                 CASE n % 4 WHEN 0 THEN 0 WHEN 1 THEN b[n] WHEN 2 THEN b[n - 1] + 256 * b[n] ELSE b[n - 2] + 256 * b[n - 1] + 65536 * b[n] END::UBIGINT AS rest FROM raw),
body AS (SELECT tok, n, rest, list_reduce([42::UBIGINT] || list_transform(w, lambda k: {mixed('k::UBIGINT')}),
                                          lambda h, k: ({rotl('xor(h, k)', 13)} * 5 + 3864292196) % {m}) AS h FROM words),
f0 AS (SELECT tok, xor(xor(h, {mixed("rest")}), n::UBIGINT) AS h FROM body),
f1 AS (SELECT tok, xor(h, h >> 16) * 2246822507 % {m} AS h FROM f0),
f2 AS (SELECT tok, xor(h, h >> 13) * 3266489909 % {m} AS h FROM f1),
f3 AS (SELECT tok, xor(h, h >> 16)::BIGINT AS h FROM f2),
hashed AS (SELECT tok, (((CASE WHEN h >= {m // 2} THEN h - {m} ELSE h END) % {n} + {n}) % {n})::INTEGER AS bucket FROM f3)"""


_TOKENS = " UNION ALL ".join(f"SELECT row_id, '{c}=' || {c} AS tok FROM ctr" for c in CATS)


@query("hash_features", sql=f"""all_tokens AS ({_TOKENS}),
{_murmur3_sql("SELECT tok FROM all_tokens", S.num_hash_features)}
SELECT row_id, bucket, CAST(count(*) AS DOUBLE) AS value FROM all_tokens JOIN hashed USING (tok) GROUP BY row_id, bucket""")
def hash_features(spark, sf_dir):
    """MLlib's hasher, long form (row_id, bucket, value), against murmur3 written in SQL."""
    df = FE.feature_hasher(CATS, S.num_hash_features).transform(ctr_frame(spark, sf_dir))
    return (df.select("row_id", F.explode(FE.sparse_entries(F.col("cat_features"))).alias("e"))
              .select("row_id", F.col("e.index").alias("bucket"), "e.value"))


@query("feature_hasher_invariants", sql="SELECT row_id, " + " + ".join(
    f"CAST({c} IS NOT NULL AS INTEGER)" for c in CATS) + " AS n_tokens, CAST(" + " + ".join(
    f"CAST({c} IS NOT NULL AS INTEGER)" for c in CATS) + " AS DOUBLE) AS vec_sum FROM ctr")
def feature_hasher_invariants(spark, sf_dir):
    """E2 invariant: a row's hashed vector sums to its number of non-null
    categories (collisions add, nulls are skipped)."""
    df = FE.feature_hasher(CATS, S.num_hash_features).transform(ctr_frame(spark, sf_dir))
    n_tok = sum(F.col(c).isNotNull().cast("int") for c in CATS)
    vsum = F.aggregate(vector_to_array("cat_features"), F.lit(0.0), lambda a, x: a + x)
    return df.select("row_id", n_tok.alias("n_tokens"), vsum.alias("vec_sum"))


def _signed_sql(n: int) -> str:
    toks = "\nUNION ALL\n".join(
        f"SELECT row_id, '{c}=' || {c} AS tok FROM ctr WHERE {c} IS NOT NULL" for c in CATS)
    return f"""t AS ({toks}),
h AS (SELECT row_id, CAST(('0x' || substr(md5(tok), 1, 8))::BIGINT % {n} AS INTEGER) AS bucket,
             1.0 - 2.0 * (('0x' || substr(md5(tok), 9, 1))::INTEGER % 2) AS s FROM t)
SELECT row_id, bucket, CAST(sum(s) AS DOUBLE) AS value FROM h GROUP BY row_id, bucket HAVING sum(s) <> 0"""


@query("hash_features_signed", sql=_signed_sql(S.num_hash_features))
def hash_features_signed(spark, sf_dir):
    """E3, long form."""
    return FE.signed_hash_long(ctr_frame(spark, sf_dir), CATS, S.num_hash_features, "row_id")


@query("hash_features_signed_vector", sql=_signed_sql(1 << 20))
def hash_features_signed_vector(spark, sf_dir):
    """E3, vector form with 2^20 buckets (built per row, no shuffle), read back as entries."""
    df = FE.signed_hash_vector(ctr_frame(spark, sf_dir), CATS, 1 << 20)
    return (df.select("row_id", F.explode(FE.sparse_entries(F.col("signed_features"))).alias("e"))
              .select("row_id", F.col("e.index").alias("bucket"), "e.value"))


# ------------------------------------------------------------------ E4-E6, E9
_STD = ", ".join(f"stddev_samp({c}) AS s_{c}" for c in INTS)
_POP = ", ".join(f"stddev_pop({c}) AS s_{c}" for c in INTS)


@query("scale_sample_std", sql=f"""sd AS (SELECT {_STD} FROM ctr)
SELECT row_id, {", ".join(f"round(CASE WHEN s_{c} = 0 THEN 0.0 * {c} ELSE {c} / s_{c} END, 6) AS {c}" for c in INTS)}
FROM ctr, sd""")
def scale_sample_std(spark, sf_dir):
    """E5 (A14): divide by the sample deviation; constant column -> 0."""
    df = ctr_frame(spark, sf_dir)
    return rounded(FE.ColumnScaler.fit(df, INTS, ddof=1).transform(df).select("row_id", *INTS))


@query("scale_population_std", sql=f"""sd AS (SELECT {_POP} FROM ctr)
SELECT row_id, {", ".join(f"round(CASE WHEN s_{c} = 0 THEN {c} ELSE {c} / s_{c} END, 6) AS {c}" for c in INTS)}
FROM ctr, sd""")
def scale_population_std(spark, sf_dir):
    """E6 (A15): divide by the population deviation; constant column kept."""
    df = ctr_frame(spark, sf_dir)
    return rounded(FE.ColumnScaler.fit(df, INTS, ddof=0).transform(df).select("row_id", *INTS))


@query("assemble_features", sql=f"""med AS (SELECT {", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in INTS)} FROM ctr),
imp AS (SELECT row_id, {", ".join(f"coalesce({c}, m_{c}) AS i_{c}" for c in INTS)} FROM ctr, med),
sd AS (SELECT {", ".join(f"stddev_samp(i_{c}) AS s_{c}" for c in INTS)} FROM imp)
SELECT row_id, {", ".join(f"round(CASE WHEN s_{c} = 0 THEN 0.0 ELSE i_{c} / s_{c} END, 6) AS f{i}" for i, c in enumerate(INTS))}
FROM imp, sd""")
def assemble_features(spark, sf_dir):
    """E4 + E5 + E8 preprocessing: the canonical four stages; the first
    slots of the scaled vector are the imputed numerics over their sample
    deviation."""
    df = ctr_frame(spark, sf_dir)
    prep = Pipeline(stages=FE.preprocessing_stages(S, relative_error=0.0)).fit(df)
    arr = vector_to_array("features")
    return rounded(prep.transform(df).select("row_id", *[arr[i].alias(f"f{i}") for i in range(len(INTS))]))


@query("assemble_with_indicators", sql=f"""med AS (SELECT {", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in INTS)} FROM ctr)
SELECT row_id, {", ".join(f"round(coalesce({c}, m_{c}), 6) AS f{i}" for i, c in enumerate(INTS))},
       CAST(int_0 IS NULL AS DOUBLE) AS f4, CAST(int_3 IS NULL AS DOUBLE) AS f5,
       CAST(coalesce(int_1 = -1, false) AS DOUBLE) AS f6, CAST(coalesce(int_1 = -2, false) AS DOUBLE) AS f7
FROM ctr, med""")
def assemble_with_indicators(spark, sf_dir):
    """Indicator flags pass into the assembled vector un-imputed,
    between the numerics and the hashed block."""
    df = clean(ctr_frame(spark, sf_dir), S.with_(skewed=()), indicators=True)
    stages = FE.preprocessing_stages(S, relative_error=0.0, indicators=True)
    prep = Pipeline(stages=stages[:-1]).fit(df)  # unscaled vector
    arr = vector_to_array("raw_features")
    n = len(INTS) + len(S.indicator_cols)
    return rounded(prep.transform(df).select("row_id", *[arr[i].alias(f"f{i}") for i in range(n)]))


@query("one_hot_index", sql="""
SELECT row_id, CAST(dense_rank() OVER (ORDER BY cat_1) - 1 AS INTEGER) AS cat_1_index FROM ctr""")
def one_hot_index(spark, sf_dir):
    """String index (alphabetical) + one-hot; the hot slot of each row."""
    df = ctr_frame(spark, sf_dir)
    model = Pipeline(stages=FE.index_one_hot("cat_1")).fit(df)
    pos = F.array_position(vector_to_array("cat_1_vec"), 1.0) - 1
    return model.transform(df).select("row_id", pos.cast("int").alias("cat_1_index"))


# ------------------------------------------------------------------ M1-M3, M7, M8, P7, S5, S7
@query("lr_segment_rates", sql="SELECT cat_0, round(avg(target), 4) AS prob FROM ctr GROUP BY cat_0")
def lr_segment_rates(spark, sf_dir):
    """M1 + E9 + M7 + M8 + P7: unregularised logistic regression on one
    category reproduces each category's target rate."""
    df, model = _segment_model(spark, sf_dir, "lr", **EXACT_LR)
    scored = MO.score(model, df, "target", keep=["cat_0"])
    return scored.groupBy("cat_0").agg(F.round(F.avg("prob"), 4).alias("prob"))


@query("lr_hashed_segment_rates", sql="SELECT cat_0, round(avg(target), 4) AS prob FROM ctr GROUP BY cat_0")
def lr_hashed_segment_rates(spark, sf_dir):
    """E2 + E4 + E5 + E8: the canonical pipeline (hasher, assembler, scaler,
    logistic regression) on one category; the 5 segments do not collide in
    128 buckets, so the model is saturated too."""
    df = ctr_frame(spark, sf_dir)
    model = MO.fit(MO.build_pipeline(SEGMENT, "lr", **EXACT_LR), df, "target")
    scored = MO.score(model, df, "target", keep=["cat_0"])
    return scored.groupBy("cat_0").agg(F.round(F.avg("prob"), 4).alias("prob"))


@query("gbt_one_round", sql="""
SELECT cat_0, round(1 / (1 + exp(-2 * (2 * avg(target) - 1))), 6) AS prob FROM ctr GROUP BY cat_0""")
def gbt_one_round(spark, sf_dir):
    """M3: one boosting round with trees deep enough to isolate each category."""
    df, model = _segment_model(spark, sf_dir, "gbt", maxIter=1, maxDepth=5, seed=42)
    scored = MO.score(model, df, "target", keep=["cat_0"])
    return scored.groupBy("cat_0").agg(F.round(F.avg("prob"), 6).alias("prob"))


@query("rf_majority_class", sql=f"""
SELECT cat_0, CASE WHEN avg(CASE WHEN cat_0 IN {PLANTED_SEGMENTS} THEN 1 - target ELSE target END) >= 0.5
                   THEN 1.0 ELSE 0.0 END::DOUBLE AS prediction
FROM ctr GROUP BY cat_0""")
def rf_majority_class(spark, sf_dir):
    """M2: one unbootstrapped tree over all features predicts each
    category's majority class (label planted so rates straddle 0.5)."""
    df, model = _segment_model(spark, sf_dir, "rf", label="planted", numTrees=1, bootstrap=False,
                               featureSubsetStrategy="all", maxDepth=5, seed=42)
    scored = MO.score(model, df, "planted", keep=["cat_0"])
    return scored.groupBy("cat_0").agg(F.max("prediction").alias("prediction"))


@query("score_saved_model", sql="SELECT cat_0, round(avg(target), 4) AS prob FROM ctr GROUP BY cat_0")
def score_saved_model(spark, sf_dir):
    """S5 + S7: save the fitted pipeline to the shared folder, load it back
    and score with the loaded copy."""
    df, model = _segment_model(spark, sf_dir, "lr", **EXACT_LR)
    path = io.save_model(model, scratch_path(spark, "segment-lr"))
    scored = MO.score(io.load_model(path), df, "target", keep=["cat_0"])
    return scored.groupBy("cat_0").agg(F.round(F.avg("prob"), 4).alias("prob"))


# ------------------------------------------------------------------ M4-M6, M9, M10, O2
@query("cv_auc_by_fold", sql=f"""
f AS (SELECT *, CAST({H_FOLD} % 2 AS INTEGER) AS fold FROM ctr),
rates AS (SELECT fold, cat_0, avg(target) AS r FROM f GROUP BY ALL),
sc AS (SELECT f.fold, f.target, rates.r AS score FROM f JOIN rates ON rates.cat_0 = f.cat_0 AND rates.fold <> f.fold),
pts AS (SELECT fold, score, count(*) FILTER (WHERE target = 1) AS pos, count(*) FILTER (WHERE target = 0) AS neg
        FROM sc GROUP BY fold, score),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC) AS tp,
               sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM pts)
SELECT fold, round(sum(neg * (2 * (tp - pos) + pos)) / (2.0 * max(P) * max(N)), 6) AS auc FROM cum GROUP BY fold""")
def cv_auc_by_fold(spark, sf_dir):
    """M5 + X5: 2-fold search over the canonical pipeline on one category
    with md5 folds; each fold's AUC ranks validation rows by the other
    fold's category rates."""
    res = TU.cross_validate(ctr_frame(spark, sf_dir), SEGMENT, "lr", GridSpec({"regParam": [0.0]}),
                            FoldSpec(2, 42, method="hash"), base_params=EXACT_LR, key="row_id")
    rows = [(f, round(a, 6)) for f, a in enumerate(res.fold_metrics[0])]
    return spark.createDataFrame(rows, "fold int, auc double")


#: Planted shares of positives by segment: far enough apart that ridge keeps their order, and near enough to
#: the mean that the lasso at 0.1 takes every weight to 0 (its pull on a scaled indicator is at most 0.09).
_SHARES = {"AUTOMOBILE": 34, "BUILDING": 42, "FURNITURE": 50, "HOUSEHOLD": 58, "MACHINERY": 66}
PLANTED = SEGMENT.with_(target="planted")


def _planted_frame(spark, sf_dir):
    share = F.coalesce(*[F.when(F.col("cat_0") == k, v) for k, v in _SHARES.items()])
    return ctr_frame(spark, sf_dir).withColumn("planted", ((F.col("row_id") * 7919) % 100 < share).cast("int"))


#: Per fold the AUC of a model that orders the segments by the other fold's rates; a model without weights has 0.5.
_FOLD_AUCS = f"""
f AS (SELECT cat_0, CAST({H_FOLD} % 2 AS INTEGER) AS fold,
             CAST((row_id * 7919) % 100 < CASE cat_0 {" ".join(f"WHEN '{k}' THEN {v}" for k, v in _SHARES.items())} END AS INTEGER) AS y FROM ctr),
rates AS (SELECT fold, cat_0, avg(y) AS r FROM f GROUP BY ALL),
sc AS (SELECT f.fold, f.y, rates.r AS score FROM f JOIN rates ON rates.cat_0 = f.cat_0 AND rates.fold <> f.fold),
pts AS (SELECT fold, score, count(*) FILTER (WHERE y = 1) AS pos, count(*) FILTER (WHERE y = 0) AS neg FROM sc GROUP BY fold, score),
cum AS (SELECT *, sum(pos) OVER (PARTITION BY fold ORDER BY score DESC) AS tp,
               sum(pos) OVER (PARTITION BY fold) AS P, sum(neg) OVER (PARTITION BY fold) AS N FROM pts),
ordered AS (SELECT fold, sum(neg * (2 * (tp - pos) + pos)) / (2.0 * max(P) * max(N)) AS auc FROM cum GROUP BY fold)"""


@query("cv_grid_search", sql=f"""{_FOLD_AUCS},
grid(combo, "regParam", "elasticNetParam") AS (VALUES (0, 0.0::DOUBLE, 0.0::DOUBLE), (1, 0.0, 1.0), (2, 0.1, 0.0), (3, 0.1, 1.0))
SELECT combo::INTEGER AS combo, "regParam", "elasticNetParam", fold,
       round(CASE WHEN "regParam" * "elasticNetParam" > 0 THEN 0.5 ELSE auc END, 6) AS auc FROM grid, ordered""")
def cv_grid_search(spark, sf_dir):
    """M4 + M5: the reference's logistic-regression grid (regParam x
    elasticNet), 2 folds, on planted segment rates: every fold's AUC at every
    grid point is known."""
    res = TU.cross_validate(_planted_frame(spark, sf_dir), PLANTED, "lr", LR_GRID, FoldSpec(2, 42, method="hash"), base_params=EXACT_LR, key="row_id")
    rows = [(i, float(c["regParam"]), float(c["elasticNetParam"]), f, round(a, 6))
            for i, (c, aucs) in enumerate(zip(res.combos, res.fold_metrics)) for f, a in enumerate(aucs)]
    return spark.createDataFrame(rows, "combo int, regParam double, elasticNetParam double, fold int, auc double")


@query("best_params", sql=f"""{_FOLD_AUCS},
grid(combo, en, reg) AS (VALUES (0, 1.0::DOUBLE, 0.1::DOUBLE), (1, 1.0, 0.0), (2, 0.0, 0.1), (3, 0.0, 0.0)),
best AS (SELECT en, reg FROM grid, (SELECT avg(auc) AS auc FROM ordered)
         ORDER BY CASE WHEN en * reg > 0 THEN 0.5 ELSE auc END DESC, combo LIMIT 1)
SELECT 'elasticNetParam' AS param, CAST(en AS VARCHAR) AS value FROM best UNION ALL SELECT 'regParam', CAST(reg AS VARCHAR) FROM best""")
def best_params(spark, sf_dir):
    """M6: parameters of the best grid point (the first of equals), not the
    grid's first one."""
    grid = GridSpec({"elasticNetParam": [1.0, 0.0], "regParam": [0.1, 0.0]})
    res = TU.cross_validate(_planted_frame(spark, sf_dir), PLANTED, "lr", grid, FoldSpec(2, 42, method="hash"), base_params=EXACT_LR, key="row_id")
    return res.params_table(spark).where(F.col("param").isin(*grid.params))


_TREE = {"null_0": "int_0 IS NULL", "above_1": "int_1 > 0", "null_3": "int_3 IS NULL", "null_c2": "cat_2 IS NULL", "building": "cat_0 = 'BUILDING'"}
#: The root decides most; in each half one more split leads to leaves of either class (equal ones would be merged).
_TREE_LABEL = ("CAST(CASE WHEN int_0 IS NULL THEN CASE WHEN int_1 > 0 THEN true ELSE (row_id * 7919) % 100 < 45 END "
               "ELSE cat_2 IS NULL AND (row_id * 7919) % 100 < 55 END AS INTEGER)")
_GINI = "(1 - ({s} / {n}) ** 2 - (({n} - {s}) / {n}) ** 2)"


def _gain_sql(rows: str, node: str) -> str:
    """Per (node, idx) the rows, and the impurity a split on it takes away."""
    whole, low, high = (_GINI.format(s=f"s{k}", n=f"n{k}") for k in ("", "0", "1"))
    return f"""SELECT {node} AS node, idx, n, {whole} - n0 / n * {low} - n1 / n * {high} AS gain FROM (
  SELECT {node}, idx, count(*)::DOUBLE AS n, sum(y)::DOUBLE AS s, count(*) FILTER (WHERE v = 0)::DOUBLE AS n0, sum(y) FILTER (WHERE v = 0)::DOUBLE AS s0,
         count(*) FILTER (WHERE v = 1)::DOUBLE AS n1, sum(y) FILTER (WHERE v = 1)::DOUBLE AS s1 FROM {rows} GROUP BY {node}, idx) WHERE n0 > 0 AND n1 > 0"""


@query("feature_importance_topk", sql=f"""
base AS (SELECT row_id, {_TREE_LABEL} AS y, [{", ".join(f"CAST(coalesce({e}, false) AS INTEGER)" for e in _TREE.values())}] AS x FROM ctr),
long AS (SELECT row_id, y, x, i - 1 AS idx, x[i] AS v, 0 AS root FROM base, unnest(range(1, {len(_TREE) + 1})) AS u(i)),
g0 AS ({_gain_sql("long", "root")}),
top AS (SELECT * FROM g0 ORDER BY gain DESC, idx LIMIT 1),
sides AS (SELECT long.*, x[top.idx + 1] AS side FROM long, top),
g1 AS ({_gain_sql("sides", "side")}),
splits AS (SELECT idx, gain * n AS taken FROM top UNION ALL
           SELECT idx, gain * n FROM (SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, idx) AS r FROM g1) WHERE r = 1 AND gain > 0),
imp AS (SELECT i AS idx, name, coalesce((SELECT sum(taken) FROM splits WHERE splits.idx = i), 0) / (SELECT sum(taken) FROM splits) AS importance
        FROM (SELECT unnest(range({len(_TREE)})) AS i, unnest({list(_TREE)}) AS name))
SELECT 'rf' AS model, CAST(row_number() OVER (ORDER BY importance DESC, idx) AS INTEGER) AS rank, CAST(idx AS INTEGER) AS idx, name, round(importance, 6) AS importance FROM imp""")
def feature_importance_topk(spark, sf_dir):
    """M9 + O2: top-20 features by importance (descending, ties by index),
    named from the assembled vector, of one unbootstrapped tree of depth 2 on a
    planted label; its Gini gains are worked out in SQL."""
    df = ctr_frame(spark, sf_dir).select(F.expr(_TREE_LABEL).alias("y"), *[
        F.coalesce(F.expr(e), F.lit(False)).cast("double").alias(n) for n, e in _TREE.items()])
    tree = MO.make_classifier("rf", "y", numTrees=1, bootstrap=False, featureSubsetStrategy="all", maxDepth=2, seed=42)
    model = MO.fit(Pipeline(stages=[FE.assembler(list(_TREE), "features"), tree]), df, "y")
    names = MO.feature_names(model, df, "features")
    imp = MO.feature_importances(spark, model, names, "rf").orderBy("idx").collect()
    return rounded(RP.top_importances(spark, [r["importance"] for r in imp], names, 20, "rf"))


_SLOTS = len(INTS) + S.num_hash_features


@query("end_to_end_job", sql=f"""
held AS (SELECT target FROM ctr WHERE {H_SPLIT} >= {EIGHTY}),
kinds(model, points) AS (VALUES ('lr', 4), ('rf', 2), ('gbt', 2))
SELECT 'job' AS model, 'n_rows' AS item, count(*) AS value FROM ctr
UNION ALL SELECT 'job', 'n_features', {len(INTS) + len(CATS)}
UNION ALL SELECT 'job', 'class_' || target, count(*) FROM ctr GROUP BY target
{"".join(f"UNION ALL SELECT 'job', 'nulls_{c}', count(*) FILTER (WHERE {c} IS NULL) FROM ctr " for c in INTS + CATS)}
UNION ALL SELECT model, 'test_rows_' || target, count(*) FROM kinds, held GROUP BY model, target
UNION ALL SELECT model, 'grid_points', points FROM kinds
UNION ALL SELECT model, 'cv_rows', points FROM kinds
UNION ALL SELECT model, 'roc_points', 11 FROM kinds
UNION ALL SELECT model, 'report_rows', 14 FROM kinds
UNION ALL SELECT model, 'importances', {_SLOTS} FROM kinds WHERE model <> 'lr'""")
def end_to_end_job(spark, sf_dir):
    """The whole job (profile, clean, split, 2-fold search for the three
    model kinds on the reference's grids, save, score, report) over the fixture
    view; every count in the documents and tables it wrote, against SQL."""
    from .job import JobConfig, run_job
    out = scratch_path(spark, "job")
    run_job(spark, JobConfig(output=out, spec=S), df=ctr_frame(spark, sf_dir).drop("score"))
    return job_counts(spark, out)


def job_counts(spark, out: str):
    """(model, item, value): the counts that a finished job's output holds."""
    eda = spark.read.text(f"{out}/eda_summary", wholetext=True).select(F.from_json(
        "value", "n_rows bigint, n_features bigint, class_balance array<struct<target:int, count:bigint>>, null_counts map<string,bigint>").alias("d"))
    job = F.lit("job").alias("model")
    parts = [eda.select(job, F.lit(c).alias("item"), F.col(f"d.{c}").alias("value")) for c in ("n_rows", "n_features")]
    parts.append(eda.select(F.explode("d.class_balance").alias("c")).select(job, F.concat(F.lit("class_"), "c.target").alias("item"), F.col("c.count").alias("value")))
    parts.append(eda.select(F.explode("d.null_counts").alias("c", "n")).select(job, F.concat(F.lit("nulls_"), "c").alias("item"), F.col("n").alias("value")))
    docs = io.read_metrics_documents(spark, out)
    held = RP.stored_confusion(docs).groupBy("model", "target").agg(F.sum("n").alias("value"))
    parts.append(held.select("model", F.concat(F.lit("test_rows_"), "target").alias("item"), "value"))
    parts.append(docs.select("model", F.lit("roc_points").alias("item"), F.size("doc.roc_points").cast("bigint").alias("value")))
    combos = [spark.read.text(f"{out}/metrics_{m}", wholetext=True).select(
        F.lit(m).alias("model"), F.lit("grid_points").alias("item"),
        F.size(F.from_json("value", "cv_avg_auc_by_param_combo array<double>")["cv_avg_auc_by_param_combo"]).cast("bigint").alias("value")) for m in MO.KINDS]
    for folder, item in (("cv", "cv_rows"), ("report", "report_rows"), ("importances", "importances")):
        rows = io.read_metrics(spark, f"{out}/{folder}")
        parts.append(rows.groupBy("model").agg(F.count(F.lit(1)).alias("value")).select("model", F.lit(item).alias("item"), "value"))
    return reduce(DataFrame.unionByName, parts + combos)


_TWIN_FLAGS = {"w0": "CAST(int_0 IS NULL AS DOUBLE)", "w3": "CAST(int_3 IS NULL AS DOUBLE)",
               "s1": "CAST(coalesce(int_1 = -1, false) AS DOUBLE)", "s2": "CAST(coalesce(int_1 = -2, false) AS DOUBLE)"}
_TWIN_SLOTS = [f"i_{c}" for c in INTS] + list(_TWIN_FLAGS)


@query("twin_pipeline_features", sql=f"""med AS (SELECT {", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in INTS)} FROM ctr),
imp AS (SELECT row_id, {", ".join(f"coalesce({c}, m_{c}) AS i_{c}" for c in INTS)},
               {", ".join(f"{e} AS {k}" for k, e in _TWIN_FLAGS.items())} FROM ctr, med),
sd AS (SELECT {", ".join(f"stddev_pop({x}) AS s_{x}" for x in _TWIN_SLOTS)} FROM imp)
SELECT row_id, {", ".join(f"round(CASE WHEN s_{x} = 0 THEN {x} ELSE {x} / s_{x} END, 6) AS f{i}" for i, x in enumerate(_TWIN_SLOTS))}
FROM imp, sd""")
def twin_pipeline_features(spark, sf_dir):
    """A13 + E3 + E6 + E7 as pipeline stages (the single-machine twin's
    preprocessing): exact midpoint medians, indicator flags, population
    scaling; the first eight slots of the scaled vector."""
    from ..operators.twin import twin_preprocessing_stages
    df = clean(ctr_frame(spark, sf_dir), S.with_(skewed=()), indicators=True)
    prep = Pipeline(stages=twin_preprocessing_stages(S)).fit(df)
    arr = vector_to_array("features")
    return rounded(prep.transform(df).select("row_id", *[arr[i].alias(f"f{i}") for i in range(len(_TWIN_SLOTS))]))
