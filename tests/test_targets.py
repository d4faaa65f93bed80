from pyspark.sql import functions as F

from campo.operators.targets import prepare
from campo.sources.fixtures import readings
from tests.conftest import SF_SMALL


def test_ranges_and_columns(spark):
    df = prepare(readings(spark, SF_SMALL), noise=True)
    for c in ["hora", "dia_semana", "estado_bomba_bin", "rendimento", "volume_irrigacao",
              "necessidade_fertilizacao"]:
        assert c in df.columns
    r = df.agg(F.min("rendimento"), F.max("rendimento"), F.min("volume_irrigacao"),
               F.max("volume_irrigacao"), F.min("necessidade_fertilizacao"),
               F.max("necessidade_fertilizacao"), F.min("hora"), F.max("hora"),
               F.min("dia_semana"), F.max("dia_semana")).first()
    assert 0 <= r[0] <= r[1] <= 80
    assert 0 <= r[2] <= r[3] <= 40
    assert 0 <= r[4] <= r[5] <= 100
    assert 0 <= r[6] <= r[7] <= 23 and 0 <= r[8] <= r[9] <= 6


def test_dry_reading_needs_water(spark):
    from campo.operators.targets import engineer_targets
    df = spark.createDataFrame([(1, 31.0, 35, 25, 50, 40.0, 5.2)],
                               "id_leitura long, temperatura double, n int, p int, k int, "
                               "umidade double, ph double")
    r = engineer_targets(df).first()
    assert r["volume_irrigacao"] > 0
    assert abs(r["volume_irrigacao"] - (0.8 * 25 + 0.15 * 11)) < 1e-12
    assert abs(r["necessidade_fertilizacao"] - (35 + 35 + 10) / 190 * 100) < 1e-12


def test_partition_invariance(spark):
    df = prepare(readings(spark, SF_SMALL), noise=True).select(
        "id_leitura", "rendimento", "volume_irrigacao", "necessidade_fertilizacao")
    a = sorted(df.collect())
    b = sorted(df.repartition(1).collect())
    c = sorted(df.repartition(7, "id_leitura").collect())
    assert a == b == c


def test_null_ph_gives_null_yield(spark):
    df = prepare(readings(spark, SF_SMALL))
    r = df.where(F.col("ph").isNull()).select("rendimento", "volume_irrigacao").collect()
    assert r and all(x["rendimento"] is None and x["volume_irrigacao"] is not None for x in r)
