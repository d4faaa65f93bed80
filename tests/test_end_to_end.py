"""The original application's flow, end to end, on the driver's tables:

readings CSV -> strict load -> table -> preparation -> processed dataset ->
training + selection -> metrics document -> model store -> arriving CSV
files scored as a stream -> advice -> advice volume.
"""

import os

from pyspark.sql import functions as F

from campo.operators import advice, learn, targets
from campo.schema import READINGS_RAW
from campo.sources import files, models, tables
from campo.sources.fixtures import readings
from campo.streaming.ingest import arriving_readings
from campo.streaming.score import score_readings
from tests.conftest import SF_SMALL


def test_full_flow(spark, tmp):
    raw = readings(spark, SF_SMALL).drop("id_leitura")
    # 1. the raw readings as CSV files with the original upper-case header
    csv_dir = os.path.join(tmp, "raw")
    raw.select([F.col(c).alias(c.upper()) for c in raw.columns]).coalesce(1).write \
        .option("header", True).option("ignoreLeadingWhiteSpace", False) \
        .option("ignoreTrailingWhiteSpace", False).csv(csv_dir)
    # 2. strict load (the dirty pH is NULL in the file: empty numeric cell -> error)
    try:
        files.read_csv_strict(spark, csv_dir)
        raise AssertionError("strict load accepted empty numeric cells")
    except files.StrictLoadError as e:
        assert "ph" in str(e)
    valid, quarantine = files.read_csv_quarantine(spark, csv_dir)
    n_raw = raw.count()
    assert valid.count() + quarantine.count() == n_raw and quarantine.count() > 0
    # 3. into the table (with a row key), and back
    name = "sensores_e2e"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keyed = valid.withColumn("id_leitura", F.xxhash64(*valid.columns))
    from campo.operators.clean import parse_timestamp
    assert tables.ingest_once(spark, parse_timestamp(keyed), name) == valid.count()
    table = spark.table(name)
    # 4. preparation and the processed dataset round trip
    prepared = targets.prepare(table, noise=True)
    pq = os.path.join(tmp, "processed.parquet")
    files.save_processed(prepared, pq)
    processed = files.read_processed(spark, pq)
    assert processed.count() == valid.count()
    # 5. training and selection (reduced grid, as in the original's tests)
    cands = {"linear_regression": [{}], "ridge": [{"alpha": 1.0}],
             "random_forest": [{"numTrees": 10, "maxDepth": 6}]}
    res = learn.train_all(processed, candidates=cands, folds=3, parallelism=3)
    assert set(res) == {"rendimento", "volume_irrigacao", "necessidade_fertilizacao",
                        "umidade", "ph"}
    doc = learn.metrics_document(res, folds=3)
    assert learn.quality_gate(doc, min_r2={"volume_irrigacao": 0.5}) == []
    files.write_metrics(spark, doc, os.path.join(tmp, "metrics"))
    assert files.read_metrics(spark, os.path.join(tmp, "metrics"))["cv_folds"] == 3
    # 6. model store
    models.save_models({t: r.model for t, r in res.items()}, os.path.join(tmp, "models"))
    loaded = models.load_models(os.path.join(tmp, "models"))
    assert set(loaded) == set(res)
    # 7. arriving readings (same CSV files) scored as a stream, advice counted
    stream = arriving_readings(spark, csv_dir, schema=READINGS_RAW, max_files_per_trigger=1)
    scored = score_readings(stream, loaded)
    counted = scored.select("id_pivo", F.explode_outer("sugestoes").alias("item")) \
        .where(F.col("item").isNotNull()).groupBy("id_pivo", F.col("item.code").alias("code")) \
        .agg(F.count(F.lit(1)).alias("n"))
    q = (counted.writeStream.outputMode("complete").format("memory").queryName("e2e_advice")
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = {(r["id_pivo"], r["code"]): r["n"] for r in spark.sql("SELECT * FROM e2e_advice").collect()}
    batch = advice.advice_volume(score_readings(files.read_csv_quarantine(spark, csv_dir)[0]
                                                .unionByName(files.read_csv_quarantine(spark, csv_dir)[1]
                                                             .drop("erros").select(
                                                                 *[F.col(f.name).cast(f.dataType)
                                                                   for f in READINGS_RAW.fields])),
                                                loaded), day=None)
    want = {(r["id_pivo"], r["code"]): r["ocorrencias"] for r in batch.collect()}
    assert got == want and sum(got.values()) >= n_raw
    spark.sql(f"DROP TABLE IF EXISTS {name}")
