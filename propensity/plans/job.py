"""The end-to-end job (Z1): load -> profile -> clean -> split -> per model
search/fit -> save -> score once -> report.

Compared with the reference's script, the data is read with an explicit
schema, profiled in one aggregate, split by tagging every row in one
projection, and the tagged table is checkpointed into the shared folder so
model fitting never replays the scan; each split is scored once into a
slim persisted table from which every metric is read.
"""

from __future__ import annotations

import argparse
import json
import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..fixtures import CTR_SPEC, ctr_frame
from ..operators import metrics as M
from ..operators import models as MO
from ..operators import profile as PR
from ..operators import report as RP
from ..operators import tuning as TU
from ..operators.clean import clean
from ..operators.split import (attach_row_id, random_split, sample, split_parts, stratified_split,
                               tag_exact_stratified_split, tag_random_split, tag_stratified_split)
from ..session import checkpoint_spread, cut_lineage
from ..sources import io
from ..spec import (CLICKS, GBT_GRID, LR_GRID, RF_GRID, FeatureSpec, FoldSpec, GridSpec,
                    SplitSpec, c_to_reg_param)

GRIDS = {"lr": LR_GRID, "rf": RF_GRID, "gbt": GBT_GRID}


@dataclass
class JobConfig:
    output: str
    input: str | None = None
    sample_frac: float = 1.0
    models: tuple = ("lr", "rf", "gbt")
    tune: bool = True
    spec: FeatureSpec = CLICKS
    split: SplitSpec = field(default_factory=SplitSpec)
    folds: FoldSpec = field(default_factory=FoldSpec)
    grids: dict = field(default_factory=lambda: dict(GRIDS))
    params: dict = field(default_factory=dict)  # per-kind overrides of classifier defaults
    relative_error: float = 0.001
    indicators: bool = False
    parallelism: int = 2
    partitions: int | None = None  # minimum partitions of the split table (default: defaultParallelism)
    style: str = "canonical"       # preprocessing stages: "canonical" (MLlib) or "twin"


def preset(name: str, output: str, input: str | None = None, **overrides) -> JobConfig:
    """The reference's three entry points as configurations.

    ``canonical``  the main job: 128 buckets, md5 stratified 80/20 split,
                   LR/RF/GBT with the tuned grids;
    ``legacy``     the older job: 16,384 buckets, plain random 80/20 split,
                   LR (maxIter 50) and RF (50-tree grid) only;
    ``twin``       the single-machine twin's choices on Spark: exact median
                   imputer, signed hashing, indicator flags in the vector,
                   population scaling, exact stratified split, stratified
                   folds, its own LR grid over C and 50-tree RF grid, the full
                   ROC curve and average precision in the report."""
    from ..spec import (CLICKS_LEGACY, CLICKS_TWIN, LEGACY_LR_DEFAULTS, LEGACY_RF_DEFAULTS,
                        LEGACY_RF_GRID, TWIN_GBT_GRID, TWIN_LR_DEFAULTS, TWIN_LR_GRID, TWIN_RF_GRID)
    if name == "canonical":
        cfg = JobConfig(output=output, input=input)
    elif name == "legacy":
        cfg = JobConfig(output=output, input=input, spec=CLICKS_LEGACY, models=("lr", "rf"),
                        split=SplitSpec(stratified=False),
                        grids={"lr": LR_GRID, "rf": LEGACY_RF_GRID},
                        params={"lr": LEGACY_LR_DEFAULTS, "rf": LEGACY_RF_DEFAULTS})
    elif name == "twin":
        cfg = JobConfig(output=output, input=input, spec=CLICKS_TWIN, indicators=True, style="twin",
                        split=SplitSpec(exact=True), folds=FoldSpec(stratified=True),
                        grids={"lr": TWIN_LR_GRID, "rf": TWIN_RF_GRID, "gbt": TWIN_GBT_GRID},
                        params={"lr": TWIN_LR_DEFAULTS})
    else:
        raise ValueError(f"unknown preset {name!r}")
    for k, v in overrides.items():
        setattr(cfg, k, v)
    return cfg


def parse_models(text: str) -> list[str]:
    """Comma list, blanks dropped, unknown names rejected."""
    models = [m.strip() for m in text.split(",") if m.strip()]
    for m in models:
        if m not in MO.KINDS:
            raise ValueError(f"Unknown model_type: {m}")
    return models


def profile_tables(df: DataFrame, spec: FeatureSpec) -> dict[str, DataFrame]:
    """The EDA summary: one fused aggregate."""
    feats = [c for c in spec.features if c in df.columns]
    nums = [c for c in spec.int_cols if c in df.columns]
    return PR.profile_summary(df, spec.target, feats, nums)


def resolve_grid(grid: GridSpec, n_train: int) -> GridSpec:
    """A grid over ``C`` as one over ``regParam`` for ``n_train`` rows."""
    return GridSpec({("regParam" if k == "C" else k): ([c_to_reg_param(c, n_train) for c in v] if k == "C" else v)
                     for k, v in grid.params.items()})


def tag_split(df: DataFrame, spec: FeatureSpec, s: SplitSpec, key: str) -> DataFrame:
    """The split column, by hash or (``method="seeded"``) by Spark's samplers."""
    if s.method == "seeded" and not s.exact:
        parts = (stratified_split(df, spec.target, s.train_frac, s.seed, "seeded", key) if s.stratified
                 else random_split(df, s.train_frac, s.seed, "seeded"))
        train, test = (p.withColumn("split", F.lit(n)) for p, n in zip(parts, ("train", "test")))
        return train.unionByName(test)
    if s.stratified and s.exact:
        return tag_exact_stratified_split(df, spec.target, s.train_frac, s.seed, key)
    if s.stratified:
        return tag_stratified_split(df, spec.target, {0: s.train_frac, 1: s.train_frac}, s.seed, key)
    return tag_random_split(df, s.train_frac, s.seed, key)


def score_splits(model, tagged: DataFrame, spec: FeatureSpec, key: str) -> DataFrame:
    """One scoring pass over both splits: ``(key, split, target, prob, prediction)``."""
    return MO.score(model, tagged, spec.target, keep=[key, "split"])


def evaluate_model(kind: str, scored: DataFrame, spec: FeatureSpec) -> dict[str, DataFrame]:
    """All report tables of one model from its persisted scored table, in
    two jobs (ranking aggregate + outcome counts) for both splits."""
    ev = M.evaluate(scored, spec.target, "prob", "prediction", ["split"])
    test = F.col("split") == "test"
    return {
        "report": ev["report"].select(F.lit(kind).alias("model"), "*"),
        "confusion": ev["confusion"].where(test).drop("split").select(F.lit(kind).alias("model"), "*"),
        "roc_points": ev["sweep"].where(test).drop("split").select(F.lit(kind).alias("model"), "*"),
    }


def metrics_document(kind: str, tables: dict, fit_time: float, search=None, importances=None,
                     label: str = "target", twin: bool = False) -> dict:
    """The reference's metrics JSON layout, from the (small) report tables;
    ``twin``: average precision as AUC_PR and, for its whole curve (a point for
    each distinct score), the folder of the sorted table that holds it."""
    rep = tables["report"].collect()
    doc = {"training_metrics": {}, "test_metrics": {}}
    for r in rep:
        if r["metric"] in M.METRIC_NAMES:
            doc[f"{'training' if r['split'] == 'train' else 'test'}_metrics"][r["metric"]] = r["value"]
    doc["fit_time_sec"] = round(fit_time, 2)
    if search is not None:
        doc["cv_avg_auc_by_param_combo"] = search.avg_metrics
        doc["best_params"] = search.best_params
    if importances is not None:
        doc["top_20_feature_importance_indices"] = importances
    conf = tables["confusion"].collect()
    cm: dict = {}
    for r in conf:
        cm.setdefault(str(r["prediction"]), {})[str(r[label])] = r["n"]
    doc["confusion_matrix"] = cm
    if twin:
        ap = {r["split"]: r["avg_precision"] for r in tables["ranking"].collect()}
        for part, name in (("train", "training_metrics"), ("test", "test_metrics")):
            doc[name]["AUC_PR"] = ap.get(part)
        doc["roc_curve"] = tables["curve"]
        return doc
    doc["roc_points"] = [{"threshold": r["threshold"], "tpr": r["tpr"], "fpr": r["fpr"]}
                         for r in tables["roc_points"].orderBy("threshold").collect()]
    return doc


def eda_document(prof: dict, spec: FeatureSpec) -> dict:
    """The reference's EDA summary layout (nested JSON) from the profile tables."""
    n = prof["shape"].first()["n_rows"]
    profile = prof["null_profile"].collect()
    return {"n_rows": n, "n_features": len(spec.features),
            "class_balance": [{spec.target: r[spec.target], "count": r["n"]}
                              for r in prof["class_balance"].collect()],
            "null_counts": {r["feature"]: r["n_null"] for r in profile},
            "null_pct": {r["feature"]: r["pct_null"] for r in profile}}


def write_json_doc(spark: SparkSession, doc: dict, path: str) -> str:
    """A small JSON document written through Spark (shared storage on a
    cluster), as one text file."""
    spark.createDataFrame([(json.dumps(doc, indent=2, default=str),)], "value string") \
         .coalesce(1).write.mode("overwrite").text(path)
    return path


def run_job(spark: SparkSession, cfg: JobConfig, df: DataFrame | None = None) -> dict:
    spec = cfg.spec
    if df is None:
        df = io.read_impressions(spark, cfg.input, spec)
    else:
        df = io.conform(df, spec)
    key = spec.id_col or "_row_id"
    if cfg.sample_frac < 1.0:
        # md5 sampling needs a row key; without one, Spark's seeded sampler (the reference's form)
        method = cfg.split.method if spec.id_col else "seeded"
        df = sample(df, cfg.sample_frac, cfg.split.seed, method, spec.id_col)
    # [EDA] one aggregate per profile table
    prof = profile_tables(df, spec)
    for name, t in prof.items():
        io.write_profile(t, os.path.join(cfg.output, "eda", name))
    write_json_doc(spark, eda_document(prof, spec), os.path.join(cfg.output, "eda_summary"))
    cleaned = clean(df, spec, indicators=cfg.indicators)
    if not spec.id_col:
        cleaned = cut_lineage(attach_row_id(cleaned, None, key))  # generated ids must not change between reads
    # one tagging pass; checkpointed so every later job starts from here
    tagged = checkpoint_spread(tag_split(cleaned, spec, cfg.split, key), cfg.partitions,
                               MO.training_row_bytes(spec, cfg.indicators or cfg.style == "twin"))
    train, _ = split_parts(tagged)
    labels = tagged.agg(F.count_if(F.col("split") == "train").alias("train"),
                        F.count_if((F.col("split") == "train") & F.col(spec.target).isNull()).alias("null_train"),
                        F.count_if((F.col("split") == "test") & F.col(spec.target).isNull()).alias("null_test")).first()
    out = {"profile": prof, "models": {}, "null_labels": {"train": labels["null_train"], "test": labels["null_test"]}}
    twin = cfg.style == "twin"
    for kind in cfg.models:
        params = {**MO.DEFAULTS[kind], **cfg.params.get(kind, {})}
        search = None
        if cfg.tune:
            grid = resolve_grid(cfg.grids[kind], max(1, labels["train"] - labels["null_train"]))
            search = TU.cross_validate(train, spec, kind, grid, cfg.folds, params,
                                       cfg.relative_error, cfg.indicators, cfg.parallelism, key=key,
                                       style=cfg.style)
            model, fit_time = search.best_model, search.fit_time_sec
        else:
            import time
            t0 = time.monotonic()
            model = MO.fit(MO.build_pipeline(spec, kind, cfg.relative_error, cfg.indicators,
                                             style=cfg.style, **params), train, spec.target)
            fit_time = time.monotonic() - t0
        io.save_model(model, os.path.join(cfg.output, f"{kind}_best_pipeline"))
        scored = score_splits(model, tagged, spec, key).persist()
        try:
            tables = evaluate_model(kind, scored, spec)
            if twin:
                tables["ranking"] = M.ranking_metrics(scored, spec.target, "prob", ["split"])
                curve = M.roc_curve(scored.where(F.col("split") == "test"), spec.target, "prob", drop_collinear=True)
                tables["curve"] = io.write_sorted(curve, os.path.join(cfg.output, "roc_curve", kind), ["fpr", "tpr"])
            top = None
            if kind in ("rf", "gbt"):
                values = model.stages[-1].featureImportances.toArray()
                top = [r["idx"] for r in RP.top_importances(spark, values).collect()]
            doc = metrics_document(kind, tables, fit_time, search, top, spec.target, twin)
            doc["n_null_labels"] = out["null_labels"]
            write_json_doc(spark, doc, os.path.join(cfg.output, f"metrics_{kind}"))
            io.write_metrics(tables["report"], os.path.join(cfg.output, "report"))
            io.write_metrics(tables["confusion"], os.path.join(cfg.output, "confusion"))
            io.write_metrics(tables["roc_points"], os.path.join(cfg.output, "roc_points"))
            if search is not None:
                io.write_metrics(search.table(spark).select(F.lit(kind).alias("model"), "*"),
                                 os.path.join(cfg.output, "cv"))
            if kind in ("rf", "gbt"):
                names = MO.feature_names(model, tagged)
                io.write_metrics(MO.feature_importances(spark, model, names, kind),
                                 os.path.join(cfg.output, "importances"))
        finally:
            scored.unpersist()
        out["models"][kind] = {"doc": doc, "search": search}
    return out


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The smoke query: fixture view -> clean -> md5 stratified split ->
    untuned logistic regression -> (model, split, metric, value)."""
    spec = CTR_SPEC
    df = clean(ctr_frame(spark, sf_dir), spec)
    tagged = tag_stratified_split(df, spec.target, {0: 0.8, 1: 0.8}, 42, "row_id")
    train, _ = split_parts(tagged)
    model = MO.fit(MO.build_pipeline(spec, "lr"), train, spec.target)
    scored = score_splits(model, tagged, spec, "row_id")
    rep = M.classification_report(scored, spec.target, "prob", "prediction", ["split"])
    return rep.select(F.lit("lr").alias("model"), "split", "metric", "value")


def main(argv=None):
    ap = argparse.ArgumentParser(description="profile, split, tune and evaluate click models")
    ap.add_argument("--input", required=True)
    ap.add_argument("--output", default="./results")
    ap.add_argument("--sample_frac", type=float, default=1.0)
    ap.add_argument("--models", default=None, help="comma list (default: the preset's models)")
    ap.add_argument("--no-tune", action="store_true")
    ap.add_argument("--preset", default="canonical", choices=["canonical", "legacy", "twin"])
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("propensity-job").getOrCreate()
    models = tuple(parse_models(a.models)) if a.models else None
    cfg = preset(a.preset, a.output, a.input, sample_frac=a.sample_frac, tune=not a.no_tune)
    if models:
        cfg.models = models
    run_job(spark, cfg)
    spark.stop()


if __name__ == "__main__":
    main()
