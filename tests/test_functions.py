import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from campo import functions as cf


def one(spark, expr, schema="x double", rows=((None,),)):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


def test_bell_and_relu(spark):
    df = spark.createDataFrame([(5.0, -3.0), (8.0, 4.0), (None, None)], "x double, y double")
    r = df.select(cf.bell("x", 5, 1).alias("b"), cf.relu("y").alias("r")).collect()
    assert r[0]["b"] == 1.0
    assert 0 < r[1]["b"] < 1
    assert r[0]["r"] == 0.0 and r[1]["r"] == 4.0
    assert r[2]["b"] is None and r[2]["r"] is None


def test_clip_keeps_null(spark):
    vals = [(-1.0,), (0.5,), (3.0,), (None,)]
    out = one(spark, cf.clip("x", 0, 2), rows=vals)
    assert out == [0.0, 0.5, 2.0, None]


def test_mean_of(spark):
    df = spark.createDataFrame([(1.0, 2.0, 6.0), (1.0, None, 2.0)], "a double, b double, c double")
    assert [r[0] for r in df.select(cf.mean_of("a", "b", "c")).collect()] == [3.0, None]


@pytest.mark.parametrize("vals,expected", [
    ((30, 30, 30), "N"),       # deficits 0.571 / 0.5 / 0.5
    ((70, 60, 60), ""),        # all sufficient
    ((None, None, None), ""),  # no data
    ((None, 30, 30), "P"),     # one missing; equal deficits -> first (P before K)
    ((35, 25, 50), "P"),
    ((0, 0, 0), "N"),
])
def test_most_deficient(spark, vals, expected):
    from campo.operators.advice import most_deficient_nutrient
    df = spark.createDataFrame([vals], "n int, p int, k int")
    assert df.select(most_deficient_nutrient()).first()[0] == expected


def test_noise_reproducible_and_normal(spark):
    df = spark.range(20000).withColumn("z", cf.gaussian_noise("id", "s", 1.0))
    a = {r["id"]: r["z"] for r in df.collect()}
    b = {r["id"]: r["z"] for r in df.repartition(7).collect()}
    assert a == b
    z = np.array(list(a.values()))
    assert abs(z.mean()) < 0.03 and abs(z.std() - 1) < 0.03
    other = spark.range(5).withColumn("z", cf.gaussian_noise("id", "t", 1.0)).collect()
    assert [r["z"] for r in other] != [a[i] for i in range(5)]


def test_hash_bucket_range_and_stability(spark):
    df = spark.range(5000).withColumn("b", cf.hash_bucket("id", 100))
    rows = df.collect()
    assert all(0 <= r["b"] < 100 for r in rows)
    again = {r["id"]: r["b"] for r in df.repartition(3).collect()}
    assert all(again[r["id"]] == r["b"] for r in rows)
    share = sum(r["b"] < 80 for r in rows) / len(rows)
    assert 0.77 < share < 0.83


@pytest.mark.parametrize("text,hour,weekday", [
    ("2024-01-01 10:00:00", 10, 0),
    ("2024-01-01T10:00:00-03:00", 10, 0),
    ("2024-01-07T23:30:00Z", 23, 6),
    ("2024-01-03 08:00:00+0200", 8, 2),
    ("bad", None, None),
    (None, None, None),
])
def test_parse_wallclock(spark, text, hour, weekday):
    df = spark.createDataFrame([(text,)], "s string").select(cf.parse_wallclock("s").alias("t"))
    r = df.select(F.hour("t"), F.weekday("t")).first()
    assert (r[0], r[1]) == (hour, weekday)


def test_nan_to_null(spark):
    out = one(spark, cf.nan_to_null("x"), rows=[(float("nan"),), (1.0,)])
    assert out == [None, 1.0]


def test_fmt_is_fixed_point(spark):
    out = one(spark, cf.fmt("x", 1), rows=[(18.4,), (62.0,)])
    assert out == ["18.4", "62.0"]
    assert not math.isnan(1.0)


def test_column_mean(spark):
    from pyspark.sql import functions as F
    vals = [(0.01 * (i % 7),) for i in range(600)] + [(None,)]
    df = spark.createDataFrame(vals, "x double")
    exact = sum(round(0.01 * (i % 7), 2) for i in range(600)) / 600
    a = df.agg(cf.column_mean("x")).first()[0]
    b = df.repartition(7).agg(cf.column_mean("x")).first()[0]
    assert a == pytest.approx(b, abs=1e-15) and a == pytest.approx(exact, abs=1e-14)
    tiny = spark.createDataFrame([(1e-12,), (3e-12,)], "x double").agg(cf.column_mean("x")).first()[0]
    assert tiny == pytest.approx(2e-12, rel=1e-12)
    big = spark.createDataFrame([(1e30,), (3e30,)], "x double").agg(cf.column_mean("x")).first()[0]
    assert big == 2e30
    assert spark.createDataFrame([(None,)], "x double").agg(cf.column_mean("x")).first()[0] is None
    assert F is not None


def test_scatter_sample_is_deterministic(spark):
    from campo.operators.stats import scatter_points
    df = spark.range(2000).select(F.col("id").alias("id_leitura"), (F.col("id") * 0.5).alias("umidade"),
                                  F.lit(20.0).alias("temperatura"), F.lit("ON").alias("estado_bomba"))
    a = sorted(r[0] for r in scatter_points(df, fraction=0.1).collect())
    b = sorted(r[0] for r in scatter_points(df.repartition(5), fraction=0.1).collect())
    assert a == b and 120 < len(a) < 280
