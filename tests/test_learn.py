import numpy as np
import pytest
from pyspark.sql import functions as F

from campo.operators import learn
from campo.operators.features import (assert_no_leakage, available_targets, feature_contract,
                                      features_for_target, model_features)
from campo.operators.targets import prepare
from campo.sources.fixtures import readings
from campo.schema import TARGETS
from tests.conftest import SF_MID, SF_SMALL


@pytest.fixture(scope="module")
def small(spark):
    return learn.assign_split(prepare(readings(spark, SF_SMALL), noise=True)).cache()


def test_feature_lists():
    for t in TARGETS:
        assert t not in features_for_target(t)
        assert_no_leakage(t, model_features(t))
    assert "umidade" in features_for_target("rendimento")
    assert "umidade" not in features_for_target("ph")
    with pytest.raises(ValueError):
        assert_no_leakage("ph", ["ph"])
    assert feature_contract({t: model_features(t) for t in TARGETS}) == []


def test_available_targets(small):
    present, missing = available_targets(small.drop("ph"))
    assert "ph" in missing and "rendimento" in present


def _matrix(frame, feats, target):
    rows = frame.where("_valido").where(F.col("conjunto") == "treino").select(
        learn.KEY, *feats, target).orderBy(learn.KEY).collect()
    X = np.array([[r[c] for c in feats] for r in rows])
    y = np.array([r[target] for r in rows])
    return X, y


def test_ols_matches_least_squares(spark, small):
    t = "volume_irrigacao"
    feats = model_features(t)
    model, m = learn.fit_evaluate(small, t, "linear_regression")
    frame = learn.training_frame(small, t)
    X, y = _matrix(frame, feats, t)
    A = np.hstack([X, np.ones((len(X), 1))])
    w = np.linalg.lstsq(A, y, rcond=None)[0]
    pred = model.transform(frame.where("_valido").where(F.col("conjunto") == "treino")
                           .orderBy(learn.KEY)).select(f"pred_{t}").collect()
    assert np.allclose([p[0] for p in pred], A @ w, atol=1e-5)


def test_ridge_matches_closed_form(spark, small):
    t = "necessidade_fertilizacao"
    feats = model_features(t)
    alpha = 10.0
    model, _ = learn.fit_evaluate(small, t, "ridge", {"alpha": alpha})
    frame = learn.training_frame(small, t)
    X, y = _matrix(frame, feats, t)
    xm, ym = X.mean(0), y.mean()
    Xc = X - xm
    w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(X.shape[1]), Xc.T @ (y - ym))
    b = ym - xm @ w
    pred = model.transform(frame.where("_valido").where(F.col("conjunto") == "treino")
                           .orderBy(learn.KEY)).select(f"pred_{t}").collect()
    assert np.allclose([p[0] for p in pred], X @ w + b, atol=1e-6)


def test_forest_reaches_the_quality_limit(spark):
    from campo.plans.queries import DEMO_FOREST
    df = learn.assign_split(prepare(readings(spark, SF_MID), noise=True))
    model, m = learn.fit_evaluate(df, "rendimento", "random_forest", DEMO_FOREST)
    doc = {"targets": {"rendimento": {"test_metrics": {k: m[k] for k in ("mae", "mse", "rmse", "r2")}, "feature_columns": []}}}
    assert learn.quality_gate(doc, n_targets=1) == []
    imp = learn.importances(spark, model).collect()
    assert abs(sum(r["importancia"] for r in imp) - 1.0) < 1e-9


def test_forest_does_not_depend_on_partitions(spark, small):
    params = {"numTrees": 5, "maxDepth": 4}
    a = learn.fit_evaluate(small.repartition(3), "volume_irrigacao", "random_forest", params)[1]
    b = learn.fit_evaluate(small.repartition(5), "volume_irrigacao", "random_forest", params)[1]
    assert a["r2"] == pytest.approx(b["r2"], abs=1e-12)


def test_selection_never_takes_an_undefined_score():
    nan, low = learn.CandidateResult("ridge", {}, float("nan")), learn.CandidateResult("ridge", {}, -3.0)
    assert max([nan, low], key=learn._score_of) is low and max([low, nan], key=learn._score_of) is low


def test_score_keeps_columns_and_pivotless_rows(spark, small):
    models = {"ph": learn.fit_evaluate(small, "ph", "linear_regression")[0]}
    no_pivot = small.withColumn("id_pivo", F.lit(None).cast("string"))
    out = learn.score(no_pivot, models, digits=3)
    assert [(f.name, f.dataType) for f in out.schema.fields][:len(small.columns)] == [(f.name, f.dataType) for f in small.schema.fields]
    rows = out.where(F.col("hora").isNotNull()).select("pred_ph").collect()
    assert rows and all(r[0] is not None and r[0] == round(r[0], 3) for r in rows)


def test_holdout_comparison(spark, small):
    rows = learn.holdout_comparison(small, ["volume_irrigacao"], {
        "linear_regression": {}, "ridge": {"alpha": 1.0}, "random_forest": {"numTrees": 3, "maxDepth": None}}).collect()
    assert {r["modelo"] for r in rows} == set(learn.FAMILIES)
    assert [r["r2"] for r in rows] == sorted((r["r2"] for r in rows), reverse=True)
    assert '"maxDepth": 30' in next(r["parametros"] for r in rows if r["modelo"] == "random_forest")


def test_train_target_and_documents(spark, small):
    cands = {"linear_regression": [{}], "ridge": [{"alpha": 0.1}, {"alpha": 10.0}],
             "random_forest": [{"numTrees": 5, "maxDepth": 4}]}
    res = {t: learn.train_target(small, t, cands) for t in ("rendimento", "ph")}
    total = small.count()
    for t, r in res.items():
        assert r.best_model in learn.FAMILIES
        assert r.best_cv_r2 == max(c.cv_r2 for c in r.candidates)
        assert r.n_train + r.n_test + r.n_dropped == total
        assert r.n_dropped > 0          # readings without pH cannot be used
        assert set(r.test_metrics) == {"mae", "mse", "rmse", "r2"}
        assert abs(r.test_metrics["rmse"] - r.test_metrics["mse"] ** 0.5) < 1e-12
    doc = learn.metrics_document(res)
    assert learn.quality_gate(doc, min_r2={}, n_targets=2) == []
    assert learn.quality_gate(doc, n_targets=5)
    mf = learn.metrics_frame(spark, res)
    assert mf.where("escolhido").count() == 2
    assert learn.comparison_table(mf).count() == 6


def test_split_is_stable(spark, small):
    a = {r[0]: (r[1], r[2]) for r in small.select(learn.KEY, "conjunto", "fold").collect()}
    b = learn.assign_split(prepare(readings(spark, SF_SMALL)).repartition(5))
    assert all(a[r[0]] == (r[1], r[2]) for r in b.select(learn.KEY, "conjunto", "fold").collect())
    share = sum(v[0] == "treino" for v in a.values()) / len(a)
    assert 0.75 < share < 0.85


def test_scoring_nulls_and_stub(spark, small):
    models = {t: learn.fit_evaluate(small, t, "linear_regression")[0]
              for t in ("volume_irrigacao", "ph")}
    sc = learn.score(small, models)
    assert {"pred_volume_irrigacao", "pred_ph"} <= set(sc.columns)
    assert "pred_rendimento" not in sc.columns
    nulls = sc.where(F.col("hora").isNull()).select("pred_ph").collect()
    assert nulls and all(r[0] is None for r in nulls)
    stub = learn.stub_predictions(small).select("pred_ph", "fonte_modelo").first()
    assert (stub[0], stub[1]) == (0.0, "stub")


def test_fixed_sample(spark, small):
    a = [r[0] for r in learn.fixed_sample(small, 50).collect()]
    b = [r[0] for r in learn.fixed_sample(small.repartition(3), 50).collect()]
    assert a == b and len(a) == 50


def test_predicted_vs_actual(spark, small):
    model, _ = learn.fit_evaluate(small, "volume_irrigacao", "linear_regression")
    pts, lim = learn.predicted_vs_actual(model.transform(learn.training_frame(small, "volume_irrigacao")
                                                         .where("_valido")), "volume_irrigacao")
    r = lim.first()
    assert r["minimo"] <= r["maximo"] and pts.count() > 0


def test_ridge_reg_param():
    assert learn.ridge_reg_param(10.0, 2.0, 100) == pytest.approx(0.2)
    assert learn.ridge_reg_param(1.0, 0.0, 10) == 0.0
    assert len(learn.grid(learn.FOREST_GRID_EXTENDED)) == 18


def test_kept_nodes_and_large_groups_give_the_same_forest(spark, small):
    t, features = "volume_irrigacao", ["umidade", "temperatura", "ph"]
    train = learn.training_frame(small, t, features).where("_valido and conjunto = 'treino'").repartition(4, "id_leitura").sortWithinPartitions("id_leitura").cache()
    pipe = learn.forest(t, features, numTrees=3, maxDepth=7)
    rf = pipe.getStages()[-1]
    assert rf.getCacheNodeIds() and rf.getMaxMemoryInMB() == learn.NODES_MB
    ours = pipe.fit(train).stages[-1].toDebugString
    rf.setCacheNodeIds(False).setMaxMemoryInMB(1)
    plain = pipe.fit(train).stages[-1].toDebugString
    assert ours.split("\n")[1:] == plain.split("\n")[1:]
