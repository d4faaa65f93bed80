"""Sampling, training, selection and scoring (L01–L16) with Spark MLlib.

* Split and folds come from a hash of the row key (stable under
  repartitioning, same for every target) — no ``randomSplit``.
* Every fit is an MLlib job over the cluster (normal-equation aggregates for
  linear models, distributed tree induction for forests); only parameters and
  metrics come back to the driver.
* Cross-validation scores all folds of a candidate in one union and one
  grouped aggregate, instead of one evaluation job per fold.
"""

from __future__ import annotations

import datetime as _dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce
from itertools import product
from operator import and_

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.functions import as_col, hash_bucket, round_to
from campo.operators.clean import onehot_fixed
from campo.operators.features import (align_features, assert_no_leakage, available_targets,
                                      feature_matrix, model_features)
from campo.operators.stats import regression_metrics
from campo.schema import KEY, PIVOT_DUMMIES, TARGETS

SEED = 42
CV_FOLDS = 5
TEST_PCT = 20
FOREST_MAX_DEPTH = 30          # MLlib's limit; stands for "unlimited depth"
FIT_PARTITIONS = 16            # of a forest's input; its bags depend on them
NODES_MB = 512                 # of sums that a task of a forest holds in a pass
FORESTS_AT_ONCE = 2            # a fit keeps its rows and their nodes in memory
FAMILIES = ("linear_regression", "ridge", "random_forest")

# Candidate grids of the original application.
RIDGE_ALPHAS = (0.1, 1.0, 10.0)
FOREST_GRID = {"numTrees": (200, 400), "maxDepth": (None, 12)}
FOREST_GRID_EXTENDED = {"numTrees": (100, 200, 300), "maxDepth": (None, 10, 20),
                        "minInstancesPerNode": (1, 3)}


# ------------------------------------------------------------------ L01, L15, L10
def assign_split(df: DataFrame, key: str = KEY, test_pct: int = TEST_PCT,
                 folds: int = CV_FOLDS, seed: int = SEED) -> DataFrame:
    """L01 + L05 folds: 'treino' / 'teste' by a stable hash bucket of the key,
    and a CV fold (0..folds-1) for training rows."""
    b = hash_bucket(key, 100, seed)
    train = b < (100 - test_pct)
    return df.withColumns({
        "conjunto": F.when(train, F.lit("treino")).otherwise(F.lit("teste")),
        "fold": F.when(train, (b % folds).cast("int")),
    })


def fixed_sample(df: DataFrame, n: int = 300, key: str = KEY, seed: int = SEED) -> DataFrame:
    """A fixed-size seeded sample — the n rows with the smallest key hash
    (a top-k, not a full sort)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), as_col(key).cast("string")))
    return df.withColumn("_h", h).orderBy("_h", key).limit(n).drop("_h")


def stub_predictions(df: DataFrame, targets=TARGETS) -> DataFrame:
    """Neutral 0.0 predictions tagged 'stub' when no model is available."""
    return df.withColumns({**{f"pred_{t}": F.lit(0.0) for t in targets},
                           "fonte_modelo": F.lit("stub")})


# ------------------------------------------------------------------ estimators
def _assembler(target, features):
    return VectorAssembler(inputCols=list(features), outputCol=f"features_{target}",
                           handleInvalid="keep")


def full_rank(features) -> list[str]:
    """Reference-category encoding for OLS: with an intercept the three pivot
    dummies are collinear, which makes MLlib's Cholesky step fail and fall
    back to an iterative quasi-Newton solve (many passes over the data).
    Dropping the last dummy spans the same column space, so the least-squares
    predictions are unchanged and the fit is a single pass."""
    feats = list(features)
    if all(d in feats for d in PIVOT_DUMMIES):
        feats.remove(PIVOT_DUMMIES[-1])
    return feats


def linear(target: str, features, **_) -> Pipeline:
    """Ordinary least squares by the normal equations (one aggregate pass)."""
    features = full_rank(features)
    lr = LinearRegression(featuresCol=f"features_{target}", labelCol=target,
                          predictionCol=f"pred_{target}", regParam=0.0, solver="normal",
                          standardization=False)
    return Pipeline(stages=[_assembler(target, features), lr])


def ridge_reg_param(alpha: float, label_sd_pop: float, n: int) -> float:
    """MLlib regParam equal to a ridge penalty alpha·||w||² on the sum of
    squared errors.  MLlib minimises SSE/(2n) + (regParam/σ_y)·||w||²/2
    (label standardised, features not), so regParam = alpha·σ_y/n with σ_y the
    population standard deviation of the training labels."""
    if n <= 0 or label_sd_pop <= 0:
        return 0.0
    return float(alpha) * float(label_sd_pop) / float(n)


def ridge(target: str, features, alpha: float = 1.0, label_sd: float = 1.0,
          n: int = 1, **_) -> Pipeline:
    lr = LinearRegression(featuresCol=f"features_{target}", labelCol=target,
                          predictionCol=f"pred_{target}", elasticNetParam=0.0,
                          regParam=ridge_reg_param(alpha, label_sd, n), solver="normal",
                          standardization=False)
    return Pipeline(stages=[_assembler(target, features), lr])


def forest(target: str, features, numTrees: int = 200, maxDepth: int | None = None,
           minInstancesPerNode: int = 1, seed: int = SEED, **_) -> Pipeline:
    """Random forest using every feature at every split (bootstrap rows).

    A depth of None is unlimited in the original and 30, MLlib's limit, here;
    :func:`applied_params` shows it.  ``minInstancesPerNode`` bounds leaves, the
    original's minimum split bounds inner nodes: they are not equivalent.
    The node of each row is kept from level to level and ``NODES_MB`` of nodes
    are split in a pass; the trees are the same without either."""
    rf = RandomForestRegressor(featuresCol=f"features_{target}", labelCol=target,
                               predictionCol=f"pred_{target}", numTrees=int(numTrees),
                               maxDepth=FOREST_MAX_DEPTH if maxDepth is None else int(maxDepth),
                               minInstancesPerNode=int(minInstancesPerNode),
                               featureSubsetStrategy="all", subsamplingRate=1.0,
                               bootstrap=True, seed=seed, cacheNodeIds=True, maxMemoryInMB=NODES_MB)
    return Pipeline(stages=[_assembler(target, features), rf])


def grid(spec: dict) -> list[dict]:
    keys = list(spec)
    return [dict(zip(keys, vals)) for vals in product(*[spec[k] for k in keys])]


def default_candidates(forest_grid=FOREST_GRID, alphas=RIDGE_ALPHAS) -> dict[str, list[dict]]:
    return {"linear_regression": [{}],
            "ridge": [{"alpha": a} for a in alphas],
            "random_forest": grid(forest_grid)}


def applied_params(family: str, params: dict) -> dict:
    """The parameters a fit really uses."""
    if family == "random_forest" and params.get("maxDepth", 0) is None:
        return {**params, "maxDepth": FOREST_MAX_DEPTH}
    return dict(params)


_BUILDERS = {"linear_regression": linear, "ridge": ridge, "random_forest": forest}


# ------------------------------------------------------------------ data prep
def training_frame(df: DataFrame, target: str, features=None) -> DataFrame:
    """Rows of one target: key, split, fold, features (double), label, and a
    ``_valido`` flag (every feature and the label present — MLlib cannot fit
    on missing values; ``train_target`` reports how many rows it skipped)."""
    features = list(features or model_features(target))
    assert_no_leakage(target, features)
    if "conjunto" not in df.columns:
        df = assign_split(df)
    x = feature_matrix(df, features, [KEY, "conjunto", "fold", F.col(target).cast("double").alias(target)])
    x = x.select(KEY, "conjunto", "fold", *features, target)
    ok = F.lit(True)
    for c in features + [target]:
        ok = ok & F.col(c).isNotNull() & ~F.isnan(c)
    return x.withColumn("_valido", ok)


def _label_stats_per_fold(train: DataFrame, target: str) -> dict:
    """n, mean and variance per fold in one small aggregate -> (n, σ_pop) of every
    'all folds but f' training set and of the full training set."""
    rows = train.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.avg(target).alias("m"),
                                     F.var_pop(target).alias("v")).collect()

    def merged(parts):
        """Count and deviation of several folds: within plus between."""
        n = sum(r["n"] for r in parts)
        if not n:
            return 0, 0.0
        mean = sum(r["n"] * r["m"] for r in parts) / n
        return n, (sum(r["n"] * (r["v"] + (r["m"] - mean) ** 2) for r in parts) / n) ** 0.5

    return {"all": merged(rows), **{r["fold"]: merged([o for o in rows if o is not r]) for r in rows}}


@dataclass
class CandidateResult:
    family: str
    params: dict
    cv_r2: float


@dataclass
class TargetResult:
    target: str
    best_model: str
    best_params: dict
    best_cv_r2: float
    candidates: list[CandidateResult]
    test_metrics: dict
    n_train: int
    n_test: int
    n_dropped: int
    features: list[str]
    model: PipelineModel = field(repr=False, default=None)


def _score_of(c: CandidateResult) -> float:
    """CV R², with an undefined one below every other."""
    return float("-inf") if c.cv_r2 != c.cv_r2 else c.cv_r2


def _fit(family, target, features, params, data, stats_key, label_stats):
    kw = dict(params)
    if family == "random_forest":
        # bags are drawn by partition: the same rows in the same order, however they came
        data = data.repartition(FIT_PARTITIONS, KEY).sortWithinPartitions(KEY)
    if family == "ridge":
        n, sd = label_stats[stats_key]
        kw.update(label_sd=sd, n=n)
    return _BUILDERS[family](target, features, **kw).fit(data)


def _fold_scores(train: DataFrame, target: str, features, family: str, params: dict,
                 fold: int, label_stats) -> DataFrame:
    """Fit on every fold but ``fold`` (an action), return the lazy scores of ``fold``."""
    m = _fit(family, target, features, params, train.where(F.col("fold") != fold), fold,
             label_stats)
    return m.transform(train.where(F.col("fold") == fold)).select(
        "fold", target, f"pred_{target}")


def _mean_fold_r2(parts: list[DataFrame], target: str) -> float:
    """Unweighted mean of the per-fold R², all folds in one grouped aggregate."""
    scored = parts[0]
    for p in parts[1:]:
        scored = scored.unionByName(p)
    r2 = regression_metrics(scored, target, f"pred_{target}", by=["fold"]) \
        .agg(F.avg("r2").alias("r2")).first()["r2"]
    return float(r2) if r2 is not None else float("nan")


def cross_validate(train: DataFrame, target: str, features, family: str, params: dict,
                   folds: int = CV_FOLDS, label_stats=None, parallelism: int = 1) -> float:
    """Mean R² over the hash folds (unweighted mean of per-fold R²).

    Fits run concurrently when ``parallelism`` > 1 (Spark schedules the
    jobs of all threads on the same cluster); predictions of every fold are
    scored together by one grouped aggregate."""
    label_stats = label_stats or _label_stats_per_fold(train, target)
    args = (train, target, features, family, params)
    if parallelism > 1:
        with ThreadPoolExecutor(parallelism) as ex:
            parts = list(ex.map(lambda f: _fold_scores(*args, f, label_stats), range(folds)))
    else:
        parts = [_fold_scores(*args, f, label_stats) for f in range(folds)]
    return _mean_fold_r2(parts, target)


def _cv_all(train, target, features, cand_list, folds, label_stats, parallelism) -> list[float]:
    """Mean CV R² of every candidate; with parallelism > 1 all (candidate,
    fold) fits of the target share one thread pool."""
    if parallelism <= 1:
        return [cross_validate(train, target, features, fam, params, folds, label_stats)
                for fam, params in cand_list]
    with ThreadPoolExecutor(parallelism) as ex:
        futs = [[ex.submit(_fold_scores, train, target, features, fam, params, f, label_stats)
                 for f in range(folds)] for fam, params in cand_list]
        parts = [[x.result() for x in row] for row in futs]
        return list(ex.map(lambda p: _mean_fold_r2(p, target), parts))


def train_target(df: DataFrame, target: str, candidates=None, folds: int = CV_FOLDS,
                 parallelism: int = 1, features=None, persist: bool = True) -> TargetResult:
    """L05–L07 for one target: CV every candidate, select the best mean R²
    (first family wins ties: linear, ridge, forest), refit it on all training
    rows and evaluate it on the hold-out rows."""
    candidates = candidates or default_candidates()
    features = list(features or model_features(target))
    # Persist before filtering: the validity filter then runs on stored rows
    # instead of being pushed into (and re-evaluating) the feature formulas.
    # Skipped when the caller already persisted ``df`` (``train_all``): the
    # frame is then a projection of cached columns and a second cache would
    # double the memory.
    frame = training_frame(df, target, features)
    if persist:
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    data = frame.where("_valido").drop("_valido")
    try:
        counts = {(r["conjunto"], r["_valido"]): r["n"] for r in
                  frame.groupBy("conjunto", "_valido").agg(F.count(F.lit(1)).alias("n")).collect()}
        train = data.where(F.col("conjunto") == "treino")
        test = data.where(F.col("conjunto") == "teste")
        label_stats = _label_stats_per_fold(train, target)
        cand_list = [(fam, params) for fam in FAMILIES for params in candidates.get(fam, [])]
        scores = _cv_all(train, target, features, cand_list, folds, label_stats, parallelism)
        results: list[CandidateResult] = []
        best = None
        for family in FAMILIES:
            fam_best = None
            for (fam, params), r2 in zip(cand_list, scores):
                if fam != family:
                    continue
                cand = CandidateResult(family, params, r2)
                if fam_best is None or _score_of(cand) > _score_of(fam_best):
                    fam_best = cand
            if fam_best is None:
                continue
            results.append(fam_best)
            if best is None or _score_of(fam_best) > _score_of(best):
                best = fam_best
        model = _fit(best.family, target, features, best.params, train, "all", label_stats)
        m = regression_metrics(model.transform(test), target, f"pred_{target}").first()
        n_train, n_test = counts.get(("treino", True), 0), counts.get(("teste", True), 0)
        dropped = sum(v for (_, ok), v in counts.items() if not ok)
        return TargetResult(target, best.family, best.params, best.cv_r2, results,
                            {k: float(m[k]) if m[k] is not None else None
                             for k in ("mae", "mse", "rmse", "r2")},
                            n_train, n_test, dropped, features, model)
    finally:
        if persist:
            frame.unpersist()


def train_all(df: DataFrame, targets=TARGETS, candidates=None, folds: int = CV_FOLDS,
              parallelism: int = 1) -> dict[str, TargetResult]:
    """Every available target on one persisted feature frame."""
    df = assign_split(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        have, _ = available_targets(df)
        present = [t for t in targets if t in have]  # same rows for every target
        if parallelism > 1:
            # targets are independent: their CV pools run side by side
            with ThreadPoolExecutor(min(len(present), 2)) as ex:
                res = list(ex.map(lambda t: train_target(df, t, candidates, folds, parallelism,
                                                         persist=False), present))
            return dict(zip(present, res))
        return {t: train_target(df, t, candidates, folds, parallelism, persist=False)
                for t in present}
    finally:
        df.unpersist()


# ------------------------------------------------------------------ L08/L12/L16 documents
METRICS_SCHEMA = T.StructType([
    T.StructField("alvo", T.StringType()),
    T.StructField("modelo", T.StringType()),
    T.StructField("cv_r2", T.DoubleType()),
    T.StructField("parametros", T.StringType()),
    T.StructField("escolhido", T.BooleanType()),
    T.StructField("mae", T.DoubleType()),
    T.StructField("mse", T.DoubleType()),
    T.StructField("rmse", T.DoubleType()),
    T.StructField("r2", T.DoubleType()),
    T.StructField("n_train", T.LongType()),
    T.StructField("n_test", T.LongType()),
    T.StructField("n_dropped", T.LongType()),
    T.StructField("features", T.ArrayType(T.StringType())),
])


def metrics_frame(spark: SparkSession, results: dict[str, TargetResult]) -> DataFrame:
    """One row per (target, family): CV R², parameters, chosen flag; the chosen
    row carries the hold-out metrics.  Small by construction (targets x 3)."""
    rows = []
    for t, r in results.items():
        for c in r.candidates:
            chosen = c.family == r.best_model
            tm = r.test_metrics if chosen else {}
            rows.append((t, c.family, c.cv_r2, json.dumps(applied_params(c.family, c.params), sort_keys=True), chosen,
                         tm.get("mae"), tm.get("mse"), tm.get("rmse"), tm.get("r2"),
                         r.n_train, r.n_test, r.n_dropped, r.features))
    return spark.createDataFrame(rows, METRICS_SCHEMA)


def metrics_document(results: dict[str, TargetResult], folds: int = CV_FOLDS) -> dict:
    """The nested metrics document (generated_at, settings, per-target block).
    The keys are fixed by the original's file format; ``n_dropped`` (rows of a
    target without all inputs) and ``missing_targets`` are added."""
    from campo.schema import BASE_FEATURES, CONTEXT_FEATURES
    doc = {"generated_at": _dt.datetime.now(_dt.timezone.utc).isoformat(),
           "random_state": SEED, "test_size": TEST_PCT / 100.0, "cv_folds": folds,
           "base_features": BASE_FEATURES, "context_features": CONTEXT_FEATURES,
           "missing_targets": [t for t in TARGETS if t not in results], "targets": {}}
    for t, r in results.items():
        doc["targets"][t] = {
            "best_model": r.best_model, "best_cv_r2": r.best_cv_r2,
            "candidates": {c.family: {"cv_r2": c.cv_r2, "best_params": applied_params(c.family, c.params)}
                           for c in r.candidates},
            "test_metrics": r.test_metrics, "n_train": r.n_train, "n_test": r.n_test,
            "n_dropped": r.n_dropped, "model_path": f"modelo_{t}", "feature_columns": r.features,
        }
    return doc


def comparison_table(metrics: DataFrame) -> DataFrame:
    """Model comparison ordered by CV R² (descending) per target."""
    return metrics.select("alvo", "modelo", "cv_r2", "parametros", "escolhido") \
        .orderBy("alvo", F.desc("cv_r2"))


def holdout_comparison(df: DataFrame, targets=TARGETS, params: dict[str, dict] | None = None) -> DataFrame:
    """Every family fitted on the training rows and measured on the
    hold-out rows: alvo, modelo, mae, mse, rmse, r2, by falling R² in a target.

    ``params`` are those of each family (default: the middle ridge penalty and
    the first forest of the grid)."""
    params = params or {"linear_regression": {}, "ridge": {"alpha": RIDGE_ALPHAS[1]},
                        "random_forest": grid(FOREST_GRID)[0]}
    spark = df.sparkSession
    df = assign_split(df).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        have, _ = available_targets(df)
        jobs = [(t, family) for t in targets if t in have for family in FAMILIES if family in params]
        with ThreadPoolExecutor(max(1, min(4, len(jobs)))) as pool:
            got = list(pool.map(lambda j: fit_evaluate(df, j[0], j[1], params[j[1]], persist=False)[1], jobs))
    finally:
        df.unpersist()
    rows = [(t, f, int(m["n"]), m["mae"], m["mse"], m["rmse"], m["r2"],
             json.dumps(applied_params(f, params[f]), sort_keys=True)) for (t, f), m in zip(jobs, got)]
    return spark.createDataFrame(rows, "alvo string, modelo string, n_teste long, mae double, mse double, rmse double, "
                                       "r2 double, parametros string").orderBy("alvo", F.desc_nulls_last("r2"), "modelo")


def quality_gate(doc: dict, min_r2: dict | None = None, n_targets: int = 5) -> list[str]:
    """Problems with a metrics document (empty list = passes)."""
    min_r2 = {"rendimento": 0.7} if min_r2 is None else min_r2
    probs = []
    targets = doc.get("targets", {})
    if len(targets) != n_targets:
        probs.append(f"expected {n_targets} targets, found {len(targets)}")
    for t, blk in targets.items():
        tm = blk.get("test_metrics", {})
        if set(tm) != {"mae", "mse", "rmse", "r2"}:
            probs.append(f"{t}: metrics {sorted(tm)}")
        if t in blk.get("feature_columns", []):
            probs.append(f"{t}: leakage")
        if t in min_r2 and (tm.get("r2") is None or tm["r2"] <= min_r2[t]):
            probs.append(f"{t}: r2 {tm.get('r2')} <= {min_r2[t]}")
    return probs


# ------------------------------------------------------------------ L09, L11, L13
def score(df: DataFrame, models: dict[str, PipelineModel], keep_features: bool = False,
          digits: int | None = None) -> DataFrame:
    """One prediction column per available model, one scan.

    The columns of ``df`` come back as they are.  Each model reads its own
    feature list from temporary columns (an absent input or pivot is 0.0, P10);
    a reading with a missing input gets a NULL prediction, never a guess.
    Absent models are simply skipped.  ``digits`` rounds the predictions
    (M06)."""
    wanted = sorted({c for m in models.values() for c in m.stages[0].getInputCols()})
    encoded = onehot_fixed(df) if "id_pivo" in df.columns else df
    own = [F.col(c).alias(f"_em_{c}") for c in df.columns]
    both = encoded.select(*own, *[c for c in wanted if c in encoded.columns])
    inputs = align_features(both, wanted).select(
        *[f"_em_{c}" for c in df.columns], *[F.col(c).alias(f"_x_{c}") for c in wanted])
    preds = []
    for t, m in models.items():
        feats = m.stages[0].getInputCols()
        whole = reduce(and_, [F.col(f"_x_{c}").isNotNull() for c in feats])
        assembler = VectorAssembler(inputCols=[f"_x_{c}" for c in feats], outputCol=f"features_{t}", handleInvalid="keep")
        scored = m.stages[-1].transform(assembler.transform(inputs)).drop(f"features_{t}")
        value = F.when(whole, F.col(f"pred_{t}"))
        inputs = scored.withColumn(f"pred_{t}", value if digits is None else round_to(value, digits))
        preds.append(f"pred_{t}")
    extra = [F.col(f"_x_{c}").alias(c) for c in wanted if c not in df.columns] if keep_features else []
    return inputs.select(*[F.col(f"_em_{c}").alias(c) for c in df.columns], *extra, *preds,
                         F.lit("modelo" if models else "stub").alias("fonte_modelo"))


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) of a forest, descending (sums to 1)."""
    feats = model.stages[0].getInputCols()
    imp = model.stages[-1].featureImportances.toArray().tolist()
    return spark.createDataFrame(list(zip(feats, [float(v) for v in imp])),
                                 "feature string, importancia double") \
        .orderBy(F.desc("importancia"), "feature")


def predicted_vs_actual(scored: DataFrame, target: str) -> tuple[DataFrame, DataFrame]:
    """(y, ŷ, residual) points and the common axis limits."""
    pts = scored.select(KEY, F.col(target).alias("real"), F.col(f"pred_{target}").alias("previsto"),
                        (F.col(target) - F.col(f"pred_{target}")).alias("residuo"))
    lim = pts.agg(F.least(F.min("real"), F.min("previsto")).alias("minimo"),
                  F.greatest(F.max("real"), F.max("previsto")).alias("maximo"))
    return pts, lim


def fit_evaluate(df: DataFrame, target: str, family: str, params: dict | None = None,
                 features=None, persist: bool = True) -> tuple[PipelineModel, dict]:
    """Fit one candidate on the training split, evaluate on the hold-out split
    (L02/L03/L04 + L07 without the grid search).  ``persist=False`` when the
    caller already persisted ``df``."""
    features = list(features or model_features(target))
    frame = training_frame(df, target, features)
    if persist:
        frame = frame.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        data = frame.where("_valido").drop("_valido")
        train = data.where(F.col("conjunto") == "treino")
        test = data.where(F.col("conjunto") == "teste")
        stats = _label_stats_per_fold(train, target) if family == "ridge" else None
        model = _fit(family, target, features, params or {}, train, "all", stats)
        m = regression_metrics(model.transform(test), target, f"pred_{target}").first().asDict()
        return model, m
    finally:
        if persist:
            frame.unpersist()
