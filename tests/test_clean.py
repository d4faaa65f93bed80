from pyspark.sql import functions as F

from campo.operators import clean


def test_pump_flags(spark):
    df = spark.createDataFrame([("ON",), (" on ",), ("OFF",), (None,), ("LIGADA",), ("1",),
                                ("true",)], "estado_bomba string")
    r = df.select(clean.pump_flag_strict().alias("s"), clean.pump_flag_lenient().alias("l")).collect()
    assert [x["s"] for x in r] == [1, 1, 0, 0, 0, 0, 0]
    assert [x["l"] for x in r] == [1, 1, 0, 0, 1, 1, 1]


def test_features_time_and_defaults(spark):
    df = spark.createDataFrame(
        [("2024-01-01 14:05:00", "OFF"), ("bad", "ON"), (None, None)],
        "capturado_em string, estado_bomba string")
    r = clean.engineer_features(df).collect()
    assert (r[0]["hora"], r[0]["dia_semana"], r[0]["estado_bomba_bin"]) == (14, 0, 0)
    assert (r[1]["hora"], r[1]["estado_bomba_bin"]) == (None, 1)
    assert r[2]["estado_bomba_bin"] == 0
    t = clean.time_defaults(spark.createDataFrame(
        [("2024-01-02T10:00:00-03:00", None), ("2024-01-02 10:00:00", 7), (None, None)],
        "capturado_em string, hora int")).collect()
    assert [(x["hora"], x["dia_semana"]) for x in t] == [(10, 1), (7, 1), (12, 0)]


def test_onehot_fixed_and_observed(spark):
    df = spark.createDataFrame([("p1",), (" P2 ",), ("p9",)], "id_pivo string")
    r = clean.onehot_fixed(df).collect()
    assert [(x.id_pivo_p1, x.id_pivo_p2, x.id_pivo_p3) for x in r] == [(1, 0, 0), (0, 1, 0), (0, 0, 0)]
    obs = clean.onehot_observed(df)
    assert sorted(c for c in obs.columns if c.startswith("id_pivo_")) == [
        "id_pivo_ P2 ", "id_pivo_p1", "id_pivo_p9"]


def test_quality_reasons(spark):
    df = spark.createDataFrame(
        [("p1", 50.0, 25.0, 6.5, 10, 10, 10, "2024-01-01 00:00:00"),
         ("p7", 150.0, None, 20.0, 10, 300, 10, "bad")],
        "id_pivo string, umidade double, temperatura double, ph double, n int, p int, k int, "
        "capturado_em string")
    valid, bad = clean.quality_split(df)
    assert valid.count() == 1
    reasons = set(bad.first()["motivos"])
    assert reasons == {"temperatura_ausente", "umidade_fora_da_faixa", "ph_fora_da_faixa",
                       "p_fora_da_faixa", "id_pivo_invalido", "capturado_em_invalido"}
    counts = {r["motivo"]: r["leituras"] for r in clean.quality_counts(df).collect()}
    assert counts["id_pivo_invalido"] == 1


def test_fill_defaults_profiles(spark):
    df = spark.createDataFrame([(None, None, None)], "umidade double, ph double, hora int")
    s = clean.fill_defaults(df, "service").first()
    z = clean.fill_defaults(df, "zero").first()
    assert (s.umidade, s.ph, s.hora) == (60.0, 6.5, 12)
    assert (z.umidade, z.ph, z.hora) == (0.0, 0.0, 0)


def test_period_and_filter(spark):
    df = spark.createDataFrame([(5, "p1"), (6, "p2"), (12, "p1"), (18, "p3"), (None, "p1")],
                               "hora int, id_pivo string")
    assert [r[0] for r in df.select(clean.period_of_day()).collect()] == [
        "noite", "manhã", "tarde", "noite", None]
    assert clean.pivot_filter(df, "Todos").count() == 5
    assert clean.pivot_filter(df, "p1").count() == 3


def test_nan_as_null_and_names(spark):
    df = spark.createDataFrame([(float("nan"), 1)], "` UMIDADE ` double, N int")
    out = clean.nan_as_null(clean.normalize_columns(df))
    assert out.columns == ["umidade", "n"]
    assert out.first()["umidade"] is None
    assert clean.numeric_columns(out) == ["umidade", "n"]


def test_cohort_yield_orders_soils(spark):
    from campo.operators.targets import prepare
    from campo.sources.fixtures import readings
    from tests.conftest import SF_MID
    r = clean.cohort_yield(prepare(readings(spark, SF_MID))).first()
    assert r["n_solo_bom"] > 0 and r["n_solo_ruim"] > 0
    assert r["media_solo_bom"] > r["media_solo_ruim"]
    assert F is not None


def test_restamp_and_text(spark):
    import datetime as dt
    from campo.functions import norm_text, round_to
    df = spark.createDataFrame([("2020-01-01 00:00:00", " On ", 1.0005)],
                               "capturado_em string, s string, x double")
    r = clean.restamp(df).select("capturado_em", norm_text("s").alias("u"),
                                 norm_text("s", "lower").alias("l"),
                                 round_to("x", 3).alias("r")).first()
    assert isinstance(r["capturado_em"], dt.datetime) and r["capturado_em"].year >= 2024
    assert r["capturado_em"].microsecond == 0
    assert (r["u"], r["l"], r["r"]) == ("ON", "on", 1.001)


def test_onehot_has_no_limit(spark):
    df = spark.range(1001).select(F.concat(F.lit("c"), F.col("id").cast("string")).alias("id_pivo"))
    assert len(clean.onehot_observed(df).columns) == 1002
    vec = clean.onehot_observed(df.union(spark.createDataFrame([(None,)], "id_pivo string")), sparse=True)
    rows = {r["id_pivo"]: r["id_pivo_vec"] for r in vec.collect()}
    assert rows["c7"].numNonzeros() == 1 and rows["c7"].size == 1001 and rows[None].numNonzeros() == 0


def test_onehot_fixed_is_zero_for_null(spark):
    df = spark.createDataFrame([(None,), ("p9",), (" P1 ",)], "id_pivo string")
    got = [tuple(r)[1:] for r in clean.onehot_fixed(df).collect()]
    assert got == [(0, 0, 0), (0, 0, 0), (1, 0, 0)]
