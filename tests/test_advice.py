import pytest
from pyspark.sql import functions as F

from campo.operators import advice as adv

SCHEMA = ("volume_irrigacao double, necessidade_fertilizacao double, rendimento double, "
          "ph double, n int, p int, k int")


def codes(spark, row, fn=None):
    df = spark.createDataFrame([row], SCHEMA)
    col = (fn or adv.advice)()
    return [(x["code"], x["value"], x["detail"]) for x in df.select(col.alias("a")).first()["a"]]


def test_all_bad(spark):
    out = codes(spark, (20.0, 60.0, 10.0, 5.0, 30, 30, 30))
    assert [c for c, _, _ in out] == ["IRRIGAR", "ADUBAR", "RENDIMENTO_BAIXO", "PH_ACIDO"]
    assert out[1][2] == "N"


def test_all_good(spark):
    out = codes(spark, (0.5, 5.0, 70.0, 6.5, 80, 80, 80))
    assert [c for c, _, _ in out] == ["SOLO_ADEQUADO"]


@pytest.mark.parametrize("vol,code", [(1.0, "SOLO_ADEQUADO"), (1.0001, "IRRIGACAO_LEVE"),
                                      (5.0, "IRRIGACAO_LEVE"), (5.0001, "IRRIGAR"), (None, None)])
def test_irrigation_boundaries(spark, vol, code):
    out = codes(spark, (vol, 0.0, 70.0, 6.5, 80, 80, 80))
    got = [c for c, _, _ in out if c in ("SOLO_ADEQUADO", "IRRIGACAO_LEVE", "IRRIGAR")]
    assert got == ([code] if code else [])


@pytest.mark.parametrize("fert,fires", [(50.0, False), (50.0001, True)])
def test_fertilise_boundary(spark, fert, fires):
    out = codes(spark, (0.0, fert, 70.0, 6.5, 80, 80, 80))
    assert ("ADUBAR" in [c for c, _, _ in out]) == fires


@pytest.mark.parametrize("y,fires", [(40.0, False), (39.9999, True)])
def test_yield_boundary(spark, y, fires):
    out = codes(spark, (0.0, 0.0, y, 6.5, 80, 80, 80))
    assert ("RENDIMENTO_BAIXO" in [c for c, _, _ in out]) == fires


@pytest.mark.parametrize("ph,code", [(5.9999, "PH_ACIDO"), (6.0, None), (7.0, None),
                                     (7.0001, "PH_ALCALINO"), (None, None)])
def test_ph_boundaries(spark, ph, code):
    out = codes(spark, (0.0, 0.0, 70.0, ph, 80, 80, 80))
    got = [c for c, _, _ in out if c.startswith("PH_")]
    assert got == ([code] if code else [])


def test_predicted_ph_first(spark):
    df = spark.createDataFrame([(5.0, 6.5), (None, 7.5)], "ph_prev double, ph double")
    r = df.select(adv.advice(volume=None, necessity=None, yield_=None, ph_pred="ph_prev",
                             ph_reading="ph").alias("a")).collect()
    assert [x["a"][0]["code"] for x in r] == ["PH_ACIDO", "PH_ALCALINO"]


def test_texts(spark):
    df = spark.createDataFrame([(18.4, 63.0, 10.0, 5.2, 30, 30, 30)], SCHEMA)
    items = df.select(adv.advice().alias("a")).first()["a"]
    assert items[0]["text"].startswith("Irrigação recomendada: aplicar aproximadamente 18.4 mm")
    assert items[1]["text"].endswith("em 63/100 (alto). O nutriente mais deficiente é N.")
    assert "pH ácido (5.2)" in items[3]["text"]


def test_service_and_dashboard_sets(spark):
    df = spark.createDataFrame([(0.5, 10.0, 70.0, 60.0, 6.5), (8.0, 60.0, 30.0, 40.0, 5.0)],
                               "volume_irrigacao double, necessidade_fertilizacao double, "
                               "rendimento double, umidade double, ph double")
    serv = [[i["code"] for i in r["a"]] for r in df.select(adv.advice_service().alias("a")).collect()]
    assert serv == [["SERV_MANTER"],
                    ["SERV_IRRIGAR", "SERV_ADUBAR", "SERV_UMIDADE_BAIXA", "SERV_PH_FORA"]]
    fb = df.select(adv.advice_dashboard_fallback().alias("a")).collect()
    assert [i["code"] for i in fb[0]["a"]] == ["PAINEL_UMIDADE_OK", "PAINEL_NUTRICAO_OK",
                                               "PAINEL_RENDIMENTO"]
    empty = spark.createDataFrame([(None, None, None)], "v double, f double, y double")
    e = empty.select(adv.advice_dashboard("v", "f", "y", ph_reading=None, n=F.lit(1), p=F.lit(1),
                                          k=F.lit(1)).alias("a")).first()["a"]
    assert [i["code"] for i in e] == ["PAINEL_SEM_PREVISAO"]


def test_advice_volume_counts(spark):
    df = spark.createDataFrame([(20.0, 60.0, 10.0, 5.0, 30, 30, 30, "p1")],
                               SCHEMA + ", id_pivo string")
    out = adv.advice_volume(adv.with_advice(df), day=None).collect()
    assert sorted((r["code"], r["ocorrencias"]) for r in out) == [
        ("ADUBAR", 1), ("IRRIGAR", 1), ("PH_ACIDO", 1), ("RENDIMENTO_BAIXO", 1)]
