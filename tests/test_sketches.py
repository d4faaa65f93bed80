"""Summaries of loads, merged, against the readings themselves."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from campo.operators import sketches, stats
from campo.streaming.ingest import SUMMARISED, arriving_readings, ingest_stream
from tests.test_sources import HEADER, write_csv
from tests.test_streaming import _lines, _replay_last


@pytest.fixture(scope="module")
def values(spark):
    """A pivot with most rows, a small one, one of equal values, one without
    values and one without a name; means far from zero."""
    pivot = (F.when(F.col("id") % 50 == 1, "p2").when(F.col("id") % 50 == 2, "p3")
             .when(F.col("id") % 50 == 3, "p4").when(F.col("id") % 50 == 4, F.lit(None)).otherwise("p1"))
    x = F.when(pivot == "p3", 7.0).when(pivot == "p4", None).when(F.col("id") % 97 == 0, float("nan")).otherwise(
        1e9 + F.pmod(F.xxhash64("id"), F.lit(100_003)) / 100.0)
    y = F.pow(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 100.0, 3)
    return spark.range(60_000).select(pivot.alias("id_pivo"), "id", x.alias("x"), y.alias("y")).cache()


def _stored(df, path, loads=6):
    for i in range(loads):
        sketches.store(df.where(F.col("id") % loads == i), path, f"carga-{i}", ["x", "y"])
    return df.sparkSession.read.parquet(path)


def test_merged_summaries_describe_each_pivot(spark, values, tmp):
    got = {(r["id_pivo"], r["coluna"]): r for r in sketches.describe_stored(_stored(values, tmp)).collect()}
    rows = values.toPandas()
    assert len(got) == 10
    for (pivot, col), r in got.items():
        x = rows[rows.id_pivo.isna() if pivot is None else rows.id_pivo == pivot][col].dropna().to_numpy(float)
        assert r["count"] == len(x)
        if not len(x):
            assert r["mean"] is r["std"] is r["min"] is r["q50"] is r["max"] is None
            continue
        assert (r["min"], r["max"]) == (x.min(), x.max())
        assert np.isclose(r["mean"], x.mean(), rtol=1e-14) and np.isclose(r["std"], x.std(ddof=1), rtol=1e-7, atol=1e-9)
        for q in sketches.QUARTILES:
            v = r[f"q{round(q * 100)}"]
            assert (x < v).mean() - 0.01 <= q <= (x <= v).mean() + 0.01


def test_coarser_groups_and_order_of_loads(spark, values, tmp):
    stored = _stored(values, tmp)
    whole = {r["coluna"]: r for r in sketches.describe_stored(stored, by=()).collect()}
    exact = {r["coluna"]: r for r in stats.describe(values, ["x", "y"]).collect()}
    for c, r in whole.items():
        assert (r["count"], r["min"], r["max"]) == (exact[c]["count"], exact[c]["min"], exact[c]["max"])
        assert np.isclose(r["mean"], exact[c]["mean"], rtol=1e-14) and np.isclose(r["std"], exact[c]["std"], rtol=1e-7)
    again = stored.repartition(5, F.rand(1)).unionByName(stored.limit(0))
    assert {(r["id_pivo"], r["coluna"], r["count"]) for r in sketches.describe_stored(again).collect()} \
        == {(r["id_pivo"], r["coluna"], r["count"]) for r in sketches.describe_stored(stored).collect()}


def test_box_from_summaries(spark, values, tmp):
    got = {r["coluna"]: r for r in sketches.box_stored(_stored(values, tmp)).where("id_pivo = 'p1'").collect()}
    exact = {r["coluna"]: r for r in stats.box_summary(values.where("id_pivo = 'p1'"), ["x", "y"]).collect()}
    n = values.where("id_pivo = 'p1'").count()
    for c, r in got.items():
        assert abs(r["outliers_aprox"] - exact[c]["outliers"]) <= 0.02 * n
        assert r["limite_inf"] <= r["q1"] <= r["mediana"] <= r["q3"] <= r["limite_sup"]
    assert sketches.box_stored(sketches.summarise(values.where("id_pivo = 'p4'"), ["x"])).count() == 0


def test_empty_load(spark, values, tmp):
    sketches.store(values.limit(0), tmp, "vazia", ["x", "y"])
    assert sketches.describe_stored(spark.read.parquet(tmp)).count() == 0


def test_stream_keeps_summaries(spark, tmp):
    src, ckpt, out = (os.path.join(tmp, x) for x in ("in", "ckpt", "resumos"))
    for i in range(3):
        write_csv(src, f"lote_{i}.csv", HEADER, _lines(i))
    for _ in range(2):  # the last batch is run again and replaces its summaries
        ingest_stream(arriving_readings(spark, src), "leituras_resumos", ckpt, quarantine=os.path.join(tmp, "bad"),
                      summaries=out).awaitTermination()
        got = {(r["id_pivo"], r["coluna"]): r for r in sketches.describe_stored(spark.read.parquet(out)).collect()}
        spark.catalog.refreshTable("leituras_resumos")
        rows = spark.table("leituras_resumos").groupBy("id_pivo").agg(F.count("ph"), F.avg("ph"), F.max("umidade")).collect()
        assert len(got) == len(rows) * len(SUMMARISED)
        for pivot, n, ph, top in rows:
            assert got[pivot, "ph"]["count"] == n and np.isclose(got[pivot, "ph"]["mean"], ph) and got[pivot, "umidade"]["max"] == top
        _replay_last(ckpt)
