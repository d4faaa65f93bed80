import os

import pytest
from pyspark.sql import functions as F

from campo.sources import files, tables
from campo.sources.models import load_models, save_models

HEADER = "ID_PIVO,UMIDADE,TEMPERATURA,PH,N,P,K,ESTADO_BOMBA,CAPTURADO_EM"
GOOD = ["p1,55.2,25.1,6.4,70,60,60,ON,2024-01-01 10:00:00",
        "p2,40.0,31.0,5.2,35,25,50,OFF,2024-01-01 11:00:00"]


def write_csv(folder, name, header, lines):
    os.makedirs(folder, exist_ok=True)
    p = os.path.join(folder, name)
    with open(p, "w") as f:
        f.write("\n".join([header] + lines) + "\n")
    return p


def test_strict_csv_ok_and_typed(spark, tmp):
    p = write_csv(tmp, "a.csv", HEADER, GOOD)
    df = files.read_csv_strict(spark, p)
    assert df.count() == 2
    assert dict(df.dtypes)["n"] == "int" and dict(df.dtypes)["umidade"] == "double"


@pytest.mark.parametrize("bad", ["p1,abc,25,6,70,60,60,ON,2024-01-01 10:00:00",
                                 "p1,,25,6,70,60,60,ON,2024-01-01 10:00:00",
                                 "p1,50,25,6,0.5,60,60,ON,2024-01-01 10:00:00"])
def test_strict_csv_rejects_bad_cells(spark, tmp, bad):
    p = write_csv(tmp, "b.csv", HEADER, GOOD + [bad])
    with pytest.raises(files.StrictLoadError):
        files.read_csv_strict(spark, p)


def test_strict_csv_by_name_and_missing(spark, tmp):
    hdr = "UMIDADE,ID_PIVO,TEMPERATURA,PH,N,P,K,ESTADO_BOMBA,CAPTURADO_EM"
    p = write_csv(tmp, "c.csv", hdr, ["55.5,p3,20,6,1,2,3,ON,2024-01-01 00:00:00"])
    r = files.read_csv_strict(spark, p).first()
    assert (r["id_pivo"], r["umidade"]) == ("p3", 55.5)
    with pytest.raises(FileNotFoundError):
        files.read_csv_strict(spark, os.path.join(tmp, "nope.csv"))
    p2 = write_csv(tmp, "d.csv", "ID_PIVO,UMIDADE", ["p1,1"])
    with pytest.raises(files.StrictLoadError):
        files.read_csv_strict(spark, p2)


def test_quarantine_split(spark, tmp):
    p = write_csv(tmp, "q.csv", HEADER, GOOD + ["p1,abc,25,6,70,60,60,ON,x"])
    valid, bad = files.read_csv_quarantine(spark, p)
    assert valid.count() == 2
    b = bad.first()
    assert b["erros"] == ["umidade"] and b["umidade"] == "abc"


def test_processed_round_trip(spark, tmp):
    from campo.operators.targets import prepare
    from campo.sources.fixtures import readings
    from tests.conftest import SF_SMALL
    df = prepare(readings(spark, SF_SMALL))
    pq = os.path.join(tmp, "ds.parquet")
    files.save_processed(df, pq)
    a = files.read_processed(spark, pq)
    files.save_processed(df, os.path.join(tmp, "ds.csv"), fmt="csv")
    b = files.read_processed(spark, os.path.join(tmp, "other.parquet"), os.path.join(tmp, "ds.csv"))
    assert a.schema == b.schema
    assert a.count() == b.count() == df.count()
    cols = ["id_leitura", "capturado_em", "hora", "estado_bomba"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    with pytest.raises(FileNotFoundError):
        files.read_processed(spark, os.path.join(tmp, "missing.parquet"))


def test_first_available_source(spark, tmp):
    p = write_csv(tmp, "raw.csv", HEADER, GOOD)
    df, label = files.load_first_available(spark, [("table", "no_such_table"),
                                                   ("parquet", os.path.join(tmp, "none.parquet")),
                                                   ("csv", p)])
    assert label.startswith("csv:") and df.count() == 2
    empty, label = files.load_first_available(spark, [("parquet", os.path.join(tmp, "x"))])
    assert label == "vazio" and empty.count() == 0


def test_table_ingest_reset_append(spark, tmp):
    from campo.operators.clean import parse_timestamp
    from campo.sources.fixtures import readings
    from tests.conftest import SF_SMALL
    name = "sensores_teste"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert tables.count_rows(spark, name) == 0
    src = parse_timestamp(readings(spark, SF_SMALL))
    n = tables.ingest_once(spark, src, name, reset=True)
    assert n == tables.count_rows(spark, name) > 0
    assert tables.ingest_once(spark, src, name, reset=True) == n
    assert tables.count_rows(spark, name) == n
    tables.ingest_once(spark, src, name, reset=False)
    assert tables.count_rows(spark, name) == 2 * n
    five = src.orderBy("id_leitura").limit(5)
    for _ in range(3):
        assert tables.insert_rows(spark, five, name) == 5
    assert tables.count_rows(spark, name) == 2 * n + 15
    assert tables.insert_rows(spark, five.where(F.lit(False)), name) == 0
    head = tables.read_table(spark, name, limit=3).collect()
    assert len(head) == 3 and head[0]["capturado_em"] <= head[1]["capturado_em"]
    assert not tables.create_table(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_metrics_round_trip(spark, tmp):
    doc = {"targets": {"ph": {"test_metrics": {"r2": 0.1}}}, "cv_folds": 5}
    files.write_metrics(spark, doc, os.path.join(tmp, "m"))
    assert files.read_metrics(spark, os.path.join(tmp, "m")) == doc
    assert files.read_metrics(spark, os.path.join(tmp, "absent")) == {}


def test_model_store(spark, tmp):
    from campo.operators.learn import linear
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.1), (3.0, 5.9)], "x double, ph double")
    m = linear("ph", ["x"]).fit(df)
    save_models({"ph": m}, tmp)
    got = load_models(tmp)
    assert list(got) == ["ph"]
    with pytest.raises(FileNotFoundError):
        load_models(os.path.join(tmp, "empty"))
    assert load_models(os.path.join(tmp, "empty"), required=False) == {}


def test_keyless_loads_get_unique_keys(spark, tmp):
    p = write_csv(tmp, "dup.csv", HEADER, GOOD + GOOD)   # exact duplicate rows
    from campo.operators.clean import parse_timestamp
    df = parse_timestamp(files.read_csv_strict(spark, p))
    name = "sensores_chave"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    assert tables.ingest_once(spark, df, name, reset=True) == 4
    assert tables.insert_rows(spark, df, name) == 4
    keys = [r[0] for r in spark.table(name).select("id_leitura").collect()]
    assert len(keys) == 8 and len(set(keys)) == 8
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_first_available_prefers_table(spark, tmp):
    from campo.operators.clean import parse_timestamp
    p = write_csv(tmp, "t.csv", HEADER, GOOD)
    name = "sensores_fonte"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.ingest_once(spark, parse_timestamp(files.read_csv_strict(spark, p)), name)
    df, label = files.load_first_available(spark, [("table", name), ("csv", p)])
    assert label == f"table:{name}" and df.count() == 2 and "id_leitura" in df.columns
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_damaged_model_is_an_error(spark, tmp):
    os.makedirs(os.path.join(tmp, "modelo_ph", "metadata"))
    with pytest.raises(Exception):
        load_models(tmp)
    assert load_models(os.path.join(tmp, "none"), required=False) == {}


def _names(spark, name):
    return sorted(r[0] for r in spark.table(name).select("id_pivo").collect())


def test_a_load_that_fails_leaves_the_old_rows(spark, tmp):
    from campo.operators.clean import parse_timestamp
    name = "sensores_troca"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = parse_timestamp(files.read_csv_strict(spark, write_csv(tmp, "a.csv", HEADER, GOOD)))
    for by_lote in (False, True):
        tables.create_table(spark, name, path=os.path.join(tmp, f"t{by_lote}"), by_lote=by_lote)
        assert tables.ingest_once(spark, df, name) == 2
        before = sorted(map(str, spark.table(name).collect()))
        bad = df.union(df).withColumn("umidade", F.when(F.rand(1) >= 0, F.raise_error(F.lit("lost")).cast("double")))
        with pytest.raises(Exception, match="lost"):
            tables.ingest_once(spark, bad, name)
        assert sorted(map(str, spark.table(name).collect())) == before
        assert tables.ingest_once(spark, df.limit(1), name) == 1 and tables.count_rows(spark, name) == 1
        assert tables.insert_rows(spark, df, name) == 2 and tables.count_rows(spark, name) == 3
        assert tables.drop_versions(spark, name) >= 1 and tables.count_rows(spark, name) == 3
        assert tables.ingest_once(spark, df.limit(0), name) == 0 and tables.count_rows(spark, name) == 0
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_a_count_that_does_not_hold_is_not_shown(spark, tmp, monkeypatch):
    from campo.operators.clean import parse_timestamp
    name = "sensores_conta"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    df = parse_timestamp(files.read_csv_strict(spark, write_csv(tmp, "a.csv", HEADER, GOOD)))
    assert tables.ingest_once(spark, df, name) == 2

    class Wrong(tables.Observation):
        @property
        def get(self):
            return {"n": 3}
    monkeypatch.setattr(tables, "Observation", Wrong)
    with pytest.raises(tables.LoadError):
        tables.ingest_once(spark, df, name)
    monkeypatch.undo()
    assert tables.count_rows(spark, name) == 2
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_writers_side_by_side_never_share_keys(spark, tmp):
    """Four appends at once, none reads the table, and two that draw the same
    block."""
    from concurrent.futures import ThreadPoolExecutor
    from campo.operators.clean import parse_timestamp
    name = "sensores_lado"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_table(spark, name, path=os.path.join(tmp, "lado"), by_lote=True)
    df = parse_timestamp(files.read_csv_strict(spark, write_csv(tmp, "a.csv", HEADER, GOOD * 50))).repartition(5)
    with ThreadPoolExecutor(4) as pool:
        assert list(pool.map(lambda _: tables.insert_rows(spark, df, name), range(4))) == [100] * 4
    spark.catalog.refreshTable(name)
    assert spark.table(name).select("id_leitura").distinct().count() == tables.count_rows(spark, name) == 400
    draws = iter([7, 7, 9])
    assert tables.reserve_blocks(spark, name, 1, lambda n: next(draws)) == [8]
    assert tables.reserve_blocks(spark, name, 1, lambda n: next(draws)) == [10]
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_an_append_does_not_read_the_table(spark, tmp):
    """The table's files may even be gone."""
    from campo.operators.clean import parse_timestamp
    name, path = "sensores_cega", os.path.join(tmp, "cega")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    tables.create_table(spark, name, path=path)
    df = parse_timestamp(files.read_csv_strict(spark, write_csv(tmp, "a.csv", HEADER, GOOD)))
    assert tables.insert_rows(spark, df, name) == 2
    for f in os.listdir(path):
        if f.endswith(".parquet"):
            with open(os.path.join(path, f), "wb") as broken:
                broken.write(b"not parquet")
    assert tables.insert_rows(spark, df, name) == 2
    spark.sql(f"DROP TABLE IF EXISTS {name}")
