import datetime
import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from campo.operators.clean import parse_timestamp
from campo.sources import files, tables
from campo.streaming.ingest import arriving_readings, batch_counts, ingest_stream
from campo.streaming.score import score_readings, windowed_trend
from tests.test_sources import HEADER, write_csv


def _lines(i):
    return [f"p{(i + j) % 3 + 1},{40 + j}.5,{20 + i}.0,6.{j},{10 * j},{5 * j},{j},ON,"
            f"2024-01-0{i + 1} 1{j}:00:00" for j in range(5)]


def _replay_last(ckpt):
    """Lose the last commit: the batch is run again on restart."""
    commits = os.path.join(ckpt, "commits")
    last = sorted(int(x) for x in os.listdir(commits) if x.isdigit())[-1]
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(commits, name)):
            os.remove(os.path.join(commits, name))


def test_loads_and_stream_share_the_table(spark, tmp):
    src, table = os.path.join(tmp, "in"), "leituras_fluxo"
    ckpt, log, bad = (os.path.join(tmp, x) for x in ("ckpt", "log", "bad"))
    tables.create_table(spark, table, path=os.path.join(tmp, "table"), by_lote=True)
    full = write_csv(os.path.join(tmp, "full"), "a.csv", HEADER, _lines(0))
    first = parse_timestamp(files.read_csv_strict(spark, full))
    assert tables.ingest_once(spark, first, table) == 5
    assert tables.insert_rows(spark, first, table) == 5
    for i in range(3):
        extra = ["p1,abc,25,6,70,60,60,ON,2024-01-01 10:00:00", "p1,50,25"] if i == 1 else []
        write_csv(src, f"lote_{i}.csv", HEADER, _lines(i) + extra)
    for _ in range(2):
        stream = arriving_readings(spark, src, max_files_per_trigger=1)
        ingest_stream(stream, table, ckpt, quarantine=bad, log_path=log).awaitTermination()
        assert tables.count_rows(spark, table) == 25
        rows = tables.read_table(spark, table).collect()
        assert len({r["id_leitura"] for r in rows}) == 25
        assert all(r["capturado_em"] is not None and r["umidade"] is not None for r in rows)
        assert [r["capturado_em"] for r in rows] == sorted(r["capturado_em"] for r in rows)
        aside = spark.read.parquet(bad).collect()
        assert sorted(len(r["erros"]) > 0 for r in aside) == [True, True]
        bc = batch_counts(spark, log).orderBy("batch_id").collect()
        assert [(r["linhas"], r["acumulado"]) for r in bc] == [(5, 5), (5, 10), (5, 15)]
        _replay_last(ckpt)


def test_restamp_in_the_stream(spark, tmp):
    src, table = os.path.join(tmp, "in"), "leituras_carimbo"
    tables.create_table(spark, table, path=os.path.join(tmp, "table"), by_lote=True)
    write_csv(src, "a.csv", HEADER, _lines(0))
    before = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None, microsecond=0)
    ingest_stream(arriving_readings(spark, src), table, os.path.join(tmp, "ck"), restamp=True).awaitTermination()
    stamps = {r["capturado_em"] for r in spark.table(table).collect()}
    assert len(stamps) == 1 and min(stamps) >= before


def test_batch_equals_stream_scoring(spark, tmp):
    from campo.operators import learn
    from campo.operators.targets import prepare
    from campo.sources.fixtures import readings
    from tests.conftest import SF_SMALL
    base = readings(spark, SF_SMALL)
    models = {"volume_irrigacao": learn.fit_evaluate(prepare(base), "volume_irrigacao",
                                                     "linear_regression")[0]}
    src = os.path.join(tmp, "src")
    base.write.parquet(src)
    batch = score_readings(base, models).select("id_leitura", "pred_volume_irrigacao",
                                                F.to_json("sugestoes").alias("s"))
    stream = spark.readStream.schema(base.schema).parquet(src)
    out = os.path.join(tmp, "out")
    q = (score_readings(stream, models).select("id_leitura", "pred_volume_irrigacao",
                                               F.to_json("sugestoes").alias("s"))
         .writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", os.path.join(tmp, "ck")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(batch.collect()) == sorted(spark.read.parquet(out).collect())


def test_windowed_trend_stream(spark, tmp):
    from campo.operators.targets import prepare
    from campo.sources.fixtures import readings
    from tests.conftest import SF_SMALL
    df = prepare(readings(spark, SF_SMALL)).select("id_pivo", "capturado_em", "rendimento")
    src = os.path.join(tmp, "p")
    df.write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    q = (windowed_trend(stream).writeStream.outputMode("append").format("memory")
         .queryName("tendencia").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.sql("SELECT * FROM tendencia").count()
    days = df.where(F.col("capturado_em").isNotNull()).select(
        "id_pivo", F.to_date("capturado_em")).distinct().count()
    # the last window per pivot stays open until the watermark passes it
    assert 0 < got <= days


def test_bad_rows_without_a_quarantine_folder_fail(spark, tmp):
    src, table = os.path.join(tmp, "in"), "leituras_sem_quarentena"
    tables.create_table(spark, table, path=os.path.join(tmp, "table"), by_lote=True)
    write_csv(src, "a.csv", HEADER, _lines(0) + ["p1,abc,25,6,70,60,60,ON,2024-01-01 10:00:00"])
    with pytest.raises(StreamingQueryException, match="no quarantine folder"):
        ingest_stream(arriving_readings(spark, src), table, os.path.join(tmp, "ck")).awaitTermination()
    assert tables.count_rows(spark, table) == 0


def test_total_survives_a_lost_log(spark, tmp):
    src, table, log = os.path.join(tmp, "in"), "leituras_log", os.path.join(tmp, "log")
    tables.create_table(spark, table, path=os.path.join(tmp, "table"), by_lote=True)
    assert tables.insert_rows(spark, spark.createDataFrame([], "id_pivo string"
        ", umidade double, temperatura double, ph double, n int, p int, k int, estado_bomba string, capturado_em timestamp_ntz"), table) == 0
    for i in range(2):
        write_csv(src, f"lote_{i}.csv", HEADER, _lines(i))
    run = lambda: ingest_stream(arriving_readings(spark, src), table, os.path.join(tmp, "ck"), log_path=log).awaitTermination()
    run()
    os.rename(os.path.join(log, "batch_id=1"), os.path.join(tmp, "lost"))
    write_csv(src, "lote_2.csv", HEADER, _lines(2))
    run()
    assert [(r["batch_id"], r["acumulado"]) for r in batch_counts(spark, log).orderBy("batch_id").collect()] == [(0, 5), (2, 15)]
    assert spark.table(table).select("id_leitura").distinct().count() == 15
