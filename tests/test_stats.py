import numpy as np
import pytest
from pyspark.sql import functions as F

from campo.operators import stats
from tests.conftest import SF_SMALL


def _q(spark, values, probs, parts=16):
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(parts)
    out = stats.exact_quantiles(df, ["x"], probs).collect()
    return {r["q"]: r["valor"] for r in out}


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 3.0, 4.0],
    [5.0],
    [3.0, 1.0, 2.0, 2.0, 2.0, 9.0, 0.5],
    list(np.random.default_rng(0).normal(size=1001)),
])
def test_exact_quantiles_match_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.75, 1.0, 0.1]
    got = _q(spark, values, probs)
    exp = np.quantile(np.array(values), probs, method="linear")
    for q, e in zip(probs, exp):
        assert abs(got[q] - e) < 1e-12


def test_exact_quantiles_hot_value(spark):
    # one value holds a third of the rows: counted once per distinct value
    vals = [7.0] * 3000 + list(np.arange(6000, dtype=float))
    got = _q(spark, vals, [0.25, 0.5, 0.75], parts=8)
    exp = np.quantile(np.array(vals), [0.25, 0.5, 0.75])
    assert [got[q] for q in (0.25, 0.5, 0.75)] == pytest.approx(list(exp), abs=1e-9)


def test_quantiles_several_columns_and_nulls(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 10.0), (None, 20.0), (4.0, float("nan"))],
                               "a double, b double")
    out = {(r["coluna"], r["q"]): r["valor"]
           for r in stats.exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert out == {("a", 0.5): 2.0, ("b", 0.5): 15.0}


def test_describe_lineitem_vs_numpy(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    d = {r["coluna"]: r for r in stats.describe(li, ["l_quantity", "l_discount"]).collect()}
    x = np.array([r[0] for r in li.select("l_quantity").collect()])
    r = d["l_quantity"]
    assert r["count"] == len(x)
    assert r["mean"] == pytest.approx(x.mean())
    assert r["std"] == pytest.approx(x.std(ddof=1))
    assert r["q25"] == pytest.approx(np.quantile(x, 0.25))
    assert r["q75"] == pytest.approx(np.quantile(x, 0.75))
    approx = {r["coluna"]: r for r in stats.describe(li, ["l_quantity"], exact=False).collect()}
    assert abs(approx["l_quantity"]["q50"] - np.quantile(x, 0.5)) <= 1.0


def test_correlation_pairwise_and_constant(spark):
    rng = np.random.default_rng(1)
    a = rng.normal(size=200)
    b = 2 * a + rng.normal(size=200)
    rows = [(float(x), float(y) if i % 10 else None, 3.0) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    m = {(r["var_x"], r["var_y"]): r["corr"]
         for r in stats.correlation_matrix(df, ["a", "b", "c"]).collect()}
    mask = np.array([i % 10 != 0 for i in range(200)])
    assert m[("a", "b")] == pytest.approx(np.corrcoef(a[mask], b[mask])[0, 1], abs=1e-12)
    assert m[("a", "b")] == m[("b", "a")]
    assert m[("a", "a")] == pytest.approx(1.0)
    assert m[("a", "c")] is None and m[("c", "c")] is None
    assert len(m) == 9


def test_histogram_matches_numpy(spark):
    vals = list(np.random.default_rng(2).uniform(0, 10, size=500)) + [10.0]
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    h = stats.histogram(df, "x", 30).orderBy("bin").collect()
    counts, edges = np.histogram(vals, bins=30)
    assert [r["contagem"] for r in h] == list(counts)
    assert [r["inicio"] for r in h] == pytest.approx(list(edges[:-1]))
    const = spark.createDataFrame([(1.0,), (1.0,)], "x double")
    hc = stats.histogram(const, "x", 30).collect()
    assert len(hc) == 30 and sum(r["contagem"] for r in hc) == 2


def test_box_summary(spark):
    vals = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 8.0, 100.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = stats.box_summary(df, ["x"]).first()
    q1, q3 = np.quantile(vals, [0.25, 0.75])
    assert (r["q1"], r["q3"]) == (q1, q3)
    assert r["bigode_sup"] == 8.0 and r["bigode_inf"] == 1.0 and r["outliers"] == 1


def test_regression_metrics_example(spark):
    df = spark.createDataFrame([(1.0, 1.1), (2.0, 1.9), (3.0, 3.2)], "y double, p double")
    r = stats.regression_metrics(df, "y", "p").first()
    assert r["mae"] == pytest.approx(0.133333, abs=1e-6)
    assert r["mse"] == pytest.approx(0.02)
    assert r["rmse"] == pytest.approx(0.141421, abs=1e-6)
    assert r["r2"] == pytest.approx(0.97)


def test_kpis_and_counts(spark):
    df = spark.createDataFrame([(50.0, 20.0, 6.0, "ON", 10, 20, 30), (70.0, 30.0, 7.0, " on ", 20, 30, 40),
                                (60.0, 25.0, None, None, 30, 40, 50), (60.0, 25.0, 6.5, "1", 0, 0, 0)],
                               "umidade double, temperatura double, ph double, estado_bomba string, "
                               "n int, p int, k int")
    k = stats.kpis(df).first()
    assert k["umidade_media"] == 60.0 and k["bomba_ligada"] == 0.25
    pc = {r["estado"]: r["contagem"] for r in stats.pump_counts(df).collect()}
    assert pc == {"ON": 2, " ON ": 1, "NAN": 1}
    nm = {r["nutriente"]: r["valor"] for r in stats.npk_means(df).collect()}
    assert nm == {"n": 15.0, "p": 22.5, "k": 30.0}
    nc = {r["coluna"]: r["nulos"] for r in stats.null_counts(df).collect()}
    assert nc["ph"] == 1 and nc["estado_bomba"] == 1 and nc["n"] == 0
    assert stats.ph_band_share(df).first()["fracao_faixa_boa"] == 1.0


def test_series_and_trend(spark):
    from campo.operators.targets import prepare
    from campo.sources.fixtures import readings
    df = prepare(readings(spark, SF_SMALL))
    s = stats.series_long(df)
    assert s.count() == 2 * df.where(F.col("capturado_em").isNotNull()).count()
    t = stats.trend(df).collect()
    assert sum(r["leituras"] for r in t) == df.where(F.col("capturado_em").isNotNull()).count()
    assert stats.series_buckets(df).count() > 0


def test_regression_metrics_constant_truth(spark):
    df = spark.createDataFrame([(2.0, 2.0, "a"), (2.0, 2.0, "a"), (2.0, 1.0, "b"), (2.0, 3.0, "b")],
                               "y double, p double, g string")
    r = {x["g"]: x["r2"] for x in stats.regression_metrics(df, "y", "p", by=["g"]).collect()}
    assert r == {"a": 1.0, "b": 0.0}


def test_exact_quantiles_property(spark):
    """Random multisets (with heavy duplicates) against NumPy's linear quantile."""
    from hypothesis import given, settings, strategies as st

    @settings(max_examples=12, deadline=None)
    @given(st.lists(st.integers(min_value=-5, max_value=5), min_size=1, max_size=60),
           st.integers(min_value=1, max_value=9))
    def check(ints, parts):
        vals = [float(v) / 2 for v in ints]
        got = _q(spark, vals, [0.1, 0.5, 0.9], parts=parts)
        exp = np.quantile(np.array(vals), [0.1, 0.5, 0.9])
        assert [got[q] for q in (0.1, 0.5, 0.9)] == pytest.approx(list(exp), abs=1e-12)

    check()


def test_quartiles_do_not_depend_on_session_settings(spark):
    df = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet")
    cols = ["l_extendedprice", "l_discount", "l_quantity"]
    expect = {c: np.quantile(df.select(df[c].cast("double")).toPandas()[c].to_numpy(), [0.25, 0.5, 0.75]) for c in cols}
    for reuse in ("true", "false"):
        for adaptive in ("true", "false"):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.adaptive.enabled", adaptive)
            try:
                rows = stats.describe(df, cols).collect()
            finally:
                spark.conf.unset("spark.sql.exchange.reuse")
                spark.conf.set("spark.sql.adaptive.enabled", "true")
            for r in rows:
                assert [r["q25"], r["q50"], r["q75"]] == pytest.approx(list(expect[r["coluna"]]), abs=1e-9)


def test_brackets_are_narrowed(spark, monkeypatch):
    monkeypatch.setattr(stats, "BRACKET_ROWS", 5)
    monkeypatch.setattr(stats, "SKETCH_ACCURACY", 20)
    vals = np.random.default_rng(4).normal(size=5000)
    got = _q(spark, vals, [0.25, 0.5, 0.9])
    assert [got[q] for q in (0.25, 0.5, 0.9)] == pytest.approx(list(np.quantile(vals, [0.25, 0.5, 0.9])), abs=1e-12)


def test_tiny_and_huge_values(spark):
    df = spark.createDataFrame([(1e-12, 1e12), (3e-12, 3e12)], "a double, b double")
    rows = {r["coluna"]: r for r in stats.describe(df, ["a", "b"]).collect()}
    assert rows["a"]["mean"] == pytest.approx(2e-12) and rows["a"]["std"] == pytest.approx(1.4142135e-12)
    assert rows["b"]["mean"] == pytest.approx(2e12) and rows["b"]["q50"] == pytest.approx(2e12)


def test_density_cells_nulls_and_one_value(spark):
    from campo.operators.stats import density_cells
    schema = "umidade double, temperatura double, estado_bomba string"
    rows = [(0.0, 5.0, "ON"), (10.0, 5.0, "ON"), (9.99, 5.0, None), (None, 5.0, "ON"), (float("nan"), 5.0, "ON"), (3.0, None, "OFF")]
    got = density_cells(spark.createDataFrame(rows, schema), bins=10).collect()
    assert sorted((r["cor"] or "", r["celula_x"], r["celula_y"], r["pontos"]) for r in got) == [("", 9, 0, 1), ("ON", 0, 0, 1), ("ON", 9, 0, 1)]
    assert density_cells(spark.createDataFrame([], schema)).collect() == []


def test_series_extremes_ties_and_spikes(spark):
    from campo.operators.stats import series_extremes
    rows = [(2, "2024-01-01 10:00:00", 5.0, None), (1, "2024-01-01 10:00:00", 4.0, 1.0), (3, "2024-01-01 10:30:00", 99.0, 2.0),
            (4, "2024-01-01 10:59:59", 6.0, 3.0), (5, "2024-01-01 11:00:00", None, 7.0), (6, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "id_leitura long, t string, umidade double, temperatura double").selectExpr(
        "*", "cast(t as timestamp_ntz) as capturado_em")
    got = {(r["periodo"].hour, r["variavel"]): tuple(r)[2:] for r in series_extremes(df).collect()}
    assert got == {(10, "umidade"): (4.0, 6.0, 4.0, 99.0, 4), (10, "temperatura"): (1.0, 3.0, 1.0, 3.0, 3), (11, "temperatura"): (7.0, 7.0, 7.0, 7.0, 1)}
