"""Cross-validated search.

Same result as MLlib's ``CrossValidator`` wrapped around the whole pipeline
with a fold column, in fewer passes:

* the four preprocessing stages do not depend on the classifier's
  parameters, so they are fitted once per fold (k + 1 fits instead of
  grid x k + 1) and the fold's (label, features) table is persisted once
  and shared by every grid point;
* grid points that are the same model are fitted once: logistic regression
  with ``regParam == 0`` ignores ``elasticNetParam``;
* boosted trees that differ only in ``maxIter`` are prefixes of one
  ensemble (the first k trees of the 50-tree fit are the 20-tree fit when
  subsampling is off), so only the longest is fitted and shorter ones are
  scored from its leading trees;
* random forests that differ only in ``maxDepth`` are the upper levels of the
  deepest one, which alone is fitted;
* validation AUC is the exact bucketed ranking metric, not a 1000-bin
  approximation.

Folds come from the md5 fold column (reproducible) or Spark's seeded
``rand`` like ``CrossValidator``.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir, cut_lineage, persist_spread
from ..spec import FeatureSpec, FoldSpec, GridSpec
from . import metrics as M
from .boosting import fit_boosted
from .features import preprocessing_stages
from .models import make_classifier, prepare_training, training_row_bytes
from .split import assign_folds


@dataclass
class SearchResult:
    kind: str
    best_model: PipelineModel
    best_params: dict
    combos: list[dict]
    avg_metrics: list[float]
    fold_metrics: list[list[float]]
    fit_time_sec: float
    n_fits: int = 0
    notes: list[str] = field(default_factory=list)

    def table(self, spark) -> DataFrame:
        """``(combo, params, avg_auc, fold_aucs)`` per grid point, in grid order."""
        rows = [(i, str(c), float(a), [float(x) for x in f])
                for i, (c, a, f) in enumerate(zip(self.combos, self.avg_metrics, self.fold_metrics))]
        return spark.createDataFrame(rows, "combo int, params string, avg_auc double, fold_aucs array<double>")

    def params_table(self, spark) -> DataFrame:
        """M6: ``(param, value)`` of the best grid point."""
        return spark.createDataFrame([(k, str(v)) for k, v in self.best_params.items()],
                                     "param string, value string")


def param_grid(clf, grid: GridSpec) -> list:
    """M4: MLlib ParamMaps in the same order as ``grid.combos()``."""
    b = ParamGridBuilder()
    for name, values in grid.params.items():
        b = b.addGrid(clf.getParam(name), list(values))
    return b.build()


def _equivalence_key(kind: str, combo: dict):
    if kind == "lr" and float(combo.get("regParam", 0.0)) == 0.0:
        return tuple(sorted((k, v) for k, v in combo.items() if k != "elasticNetParam"))
    return tuple(sorted(combo.items()))


#: For each kind, the parameter along which fits are prefixes of one another, and MLlib's value if none is given.
_NESTED = {"gbt": ("maxIter", 20), "rf": ("maxDepth", 5)}


def _whole_levels(depth: int, n_features: int, params: dict) -> bool:
    """Whether a forest's learner surely takes each level above ``depth`` in
    one pass: then forests of more levels draw the same features down to it."""
    trees, bins, memory = params.get("numTrees", 20), params.get("maxBins", 32), params.get("maxMemoryInMB", 256)
    return trees * (1 << max(0, depth - 1)) * n_features * bins * 3 * 8 < memory << 20  # 3: the sums of two classes, and rows


def _prefix_groups(kind: str, combos: list[dict], base: dict, n_features: int) -> dict:
    """Map each combo index to (index of the combo to fit, trees or levels to keep)."""
    out = {i: (i, None) for i in range(len(combos))}
    if kind not in _NESTED or (kind == "gbt" and float(base.get("subsamplingRate", 1.0)) != 1.0):
        return out
    name, default = _NESTED[kind]
    value = lambda j: combos[j].get(name, base.get(name, default))
    groups: dict = {}
    for i, c in enumerate(combos):
        key = tuple(sorted((k, v) for k, v in c.items() if k != name))
        groups.setdefault(key, []).append(i)
    for members in groups.values():
        longest = max(members, key=value)
        for j in members:
            if kind == "gbt" or value(j) == value(longest) or _whole_levels(value(j), n_features, {**base, **combos[j]}):
                out[j] = (longest, value(j))
    return out


def truncated_gbt(model: GBTClassificationModel, n_trees: int) -> GBTClassificationModel:
    """The boosted model as it was after its first ``n_trees`` rounds: a round
    depends on the earlier ones only, so this is the model a shorter fit gives."""
    java, sc = model._java_obj, SparkSession.active().sparkContext
    package = sc._jvm.org.apache.spark.ml
    trees = sc._gateway.new_array(package.regression.DecisionTreeRegressionModel, n_trees)
    weights = sc._gateway.new_array(sc._gateway.jvm.double, n_trees)
    for i, (t, w) in enumerate(zip(java.trees(), model.treeWeights)):
        if i < n_trees:
            trees[i], weights[i] = t, w
    short = package.classification.GBTClassificationModel(java.uid(), trees, weights, java.numFeatures(), java.numClasses())
    short.setFeaturesCol(java.getFeaturesCol())
    return GBTClassificationModel(short)


def truncated_forest(model: RandomForestClassificationModel, depth: int) -> RandomForestClassificationModel:
    """The forest as it was after ``depth`` levels. A level's rows, features
    and splits depend on the levels above only, and leaves are merged as MLlib
    merges them, so this is the model a shallower fit gives (if both took whole
    levels, see ``_whole_levels``)."""
    java, sc = model._java_obj, SparkSession.active().sparkContext
    package = sc._jvm.org.apache.spark.ml
    new_leaf, new_inner = package.tree.LeafNode, package.tree.InternalNode

    def cut(node, levels: int):
        stats = node.impurityStats()
        if levels and node.subtreeDepth():
            (low, a), (high, b) = cut(node.leftChild(), levels - 1), cut(node.rightChild(), levels - 1)
            if a is None or a != b:
                return new_inner(node.prediction(), node.impurity(), node.gain(), low, high, node.split(), stats), None
        return new_leaf(node.prediction(), node.impurity(), stats), node.prediction()
    trees = sc._gateway.new_array(package.classification.DecisionTreeClassificationModel, model.getNumTrees)
    for i, t in enumerate(java.trees()):
        trees[i] = package.classification.DecisionTreeClassificationModel(cut(t.rootNode(), depth)[0], java.numFeatures(), java.numClasses())
    short = package.classification.RandomForestClassificationModel(java.uid(), trees, java.numFeatures(), java.numClasses())
    short.setFeaturesCol(java.getFeaturesCol())
    return RandomForestClassificationModel(short)


def shortened(model, kind: str, keep: int | None):
    """The model with its first ``keep`` trees (boosting) or levels (forest)."""
    if kind == "gbt" and keep is not None and keep < model.getNumTrees:
        return truncated_gbt(model, keep)
    if kind == "rf" and keep is not None and any(t.depth > keep for t in model.trees):
        return truncated_forest(model, keep)
    return model


def fit_classifier(clf, rows: DataFrame, prep: PipelineModel):
    """``clf`` fitted on one fold's rows: prepared ones, or for boosted trees those still to be prepared by ``prep``."""
    return fit_boosted(clf, rows, prep) if isinstance(clf, GBTClassifier) else clf.fit(rows)


def cross_validate(train: DataFrame, spec: FeatureSpec, kind: str, grid: GridSpec,
                   folds: FoldSpec = FoldSpec(), base_params: dict | None = None,
                   relative_error: float = 0.001, indicators: bool = False,
                   parallelism: int = 2, dedupe: bool = True, key: str | None = None,
                   style: str = "canonical") -> SearchResult:
    """M5 + M6 + M10: mean validation AUC per grid point, best point refitted
    on all of ``train``; ``fit_time_sec`` covers the search and the refit.

    In all, ``parallelism`` fits run at once, like
    ``CrossValidator(parallelism=...)``. Folds go one after the other, so one
    fold's features are cached at a time, unless a fold has so few distinct
    fits that several folds fit in (at most ``parallelism`` / fits of them are
    then cached). In a fold each distinct model scores the validation rows
    once, and all its scores are ranked together."""
    base = dict(base_params or {})
    label = spec.target
    combos = grid.combos() or [{}]
    t0 = time.monotonic()
    if kind in ("rf", "gbt"):
        checkpoint_dir(train.sparkSession)  # tree learners checkpoint every 10 iterations
    key = key or spec.id_col or "_row_id"
    train = prepare_training(train, label)
    if key not in train.columns:  # generated ids must not change between reads
        train = cut_lineage(train.withColumn(key, F.monotonically_increasing_id()))
    with_flags = indicators or style == "twin"
    needed = [c for c in dict.fromkeys([key, label, *spec.int_cols, *spec.cat_cols,
                                        *(spec.indicator_cols if with_flags else ())]) if c in train.columns]
    tagged = persist_spread(assign_folds(train.select(*needed), folds.num_folds, folds.seed, key,
                                         folds.method, target=label, stratified=folds.stratified, col="_fold"),
                            row_bytes=training_row_bytes(spec, with_flags))
    if dedupe:
        seen: dict = {}
        fit_of = {i: seen.setdefault(_equivalence_key(kind, c), i) for i, c in enumerate(combos)}
        prefix = _prefix_groups(kind, combos, base, len(spec.int_cols) + (spec.num_hash_features if spec.cat_cols else 0)
                                + (len(spec.indicator_cols) if with_flags else 0))
    else:
        fit_of = {i: i for i in range(len(combos))}
        prefix = {i: (i, None) for i in range(len(combos))}
    model_of = {i: prefix[fit_of[i]] for i in range(len(combos))}  # (grid point fitted, trees or levels kept)
    distinct = sorted(set(model_of.values()), key=str)
    to_fit = sorted({src for src, _ in distinct})
    fold_metrics = [[0.0] * folds.num_folds for _ in combos]
    n_fits = 0
    # folds overlap only as far as one fold's fits leave the pool idle
    at_once = max(1, min(folds.num_folds, parallelism // len(to_fit)))

    def run_fold(f: int) -> tuple[dict, int]:
        """AUC by distinct model; only the fold's slim scores outlive its cache."""
        trn, val = tagged.where(F.col("_fold") != f), tagged.where(F.col("_fold") == f)
        prep = Pipeline(stages=preprocessing_stages(spec, relative_error, indicators, style=style)).fit(trn)
        # the boosted trees' learner keeps its own, smaller form of the rows
        trn_x = trn if kind == "gbt" else prep.transform(trn).select(label, "features").persist()
        val_x = prep.transform(val).select(label, "features").persist()
        pool = ThreadPoolExecutor(max_workers=max(1, parallelism // at_once))
        try:
            fitted = dict(zip(to_fit, pool.map(
                lambda i: fit_classifier(make_classifier(kind, label, **{**base, **combos[i]}), trn_x, prep), to_fit)))
            scored = None
            for d, (src, keep) in enumerate(distinct):
                model = shortened(fitted[src], kind, keep)
                s = model.transform(val_x).select(label, vector_to_array("probability")[1].alias("prob"), F.lit(d).alias("_model"))
                scored = s if scored is None else scored.unionByName(s)
            auc = {r["_model"]: float(r["auc_roc"]) for r in M.ranking_metrics(scored, label, "prob", ["_model"]).collect()}
            return auc, 1 + len(fitted)
        finally:
            pool.shutdown()
            if trn_x is not trn:
                trn_x.unpersist()
            val_x.unpersist()

    fold_pool = ThreadPoolExecutor(max_workers=at_once)
    try:
        for f, (auc, fits) in enumerate(fold_pool.map(run_fold, range(folds.num_folds))):
            n_fits += fits
            for i in range(len(combos)):
                fold_metrics[i][f] = auc[distinct.index(model_of[i])]
        avg = [sum(m) / len(m) for m in fold_metrics]
        best = max(range(len(combos)), key=lambda i: (avg[i], -i))
        best_params = {**base, **combos[best]}
        # refit on every training row, read from the cached, pruned fold table
        rows, stages = tagged.drop("_fold"), preprocessing_stages(spec, relative_error, indicators, style=style)
        clf = make_classifier(kind, label, **best_params)
        if kind == "gbt":
            prep = Pipeline(stages=stages).fit(rows)
            model = PipelineModel([*prep.stages, fit_boosted(clf, rows, prep)])
        else:
            model = Pipeline(stages=[*stages, clf]).fit(rows)
        n_fits += 1
    finally:
        fold_pool.shutdown()
        tagged.unpersist()
    notes = []
    if dedupe and len(to_fit) < len(combos):
        notes.append("equivalent or nested grid points fitted once")
    return SearchResult(kind, model, best_params, combos, avg, fold_metrics,
                        round(time.monotonic() - t0, 2), n_fits, notes)
