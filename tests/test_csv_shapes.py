"""CSV folders whose files differ in column order, and rows that do not fit."""

import os

import pytest

from campo.sources import files
from tests.test_sources import GOOD, HEADER, write_csv

OTHER = "TEMPERATURA,UMIDADE,ID_PIVO,PH,N,P,K,ESTADO_BOMBA,CAPTURADO_EM"
SHORT = "p1,55.2,25.1"
LONG = "p1,55.2,25.1,6.4,70,60,60,ON,2024-01-01 10:00:00,9,9"
EMPTY_CELL = "p1,,25.1,6.4,70,60,60,ON,2024-01-01 10:00:00"


@pytest.fixture()
def two_orders(tmp):
    write_csv(tmp, "a.csv", HEADER, GOOD)
    write_csv(tmp, "b.csv", OTHER, ["25.0,55.0,p3,6,1,2,3,ON,2024-01-01 12:00:00"])
    return tmp


def by_pivot(df):
    return {r["id_pivo"]: (float(r["umidade"]), float(r["temperatura"])) for r in df.collect()}


EXPECT = {"p1": (55.2, 25.1), "p2": (40.0, 31.0), "p3": (55.0, 25.0)}


def test_column_order_by_file(spark, two_orders):
    assert by_pivot(files.read_csv_strict(spark, two_orders)) == EXPECT
    valid, bad = files.read_csv_quarantine(spark, two_orders)
    assert by_pivot(valid) == EXPECT and bad.count() == 0
    assert by_pivot(files.read_processed(spark, os.path.join(two_orders, "none"), two_orders)) == EXPECT
    df, label = files.load_first_available(spark, [("csv", two_orders)])
    assert by_pivot(df) == EXPECT and label.startswith("csv:")
    kinds = dict(df.dtypes)
    assert kinds["umidade"] == "double" and kinds["n"] == "int" and kinds["capturado_em"] == "timestamp_ntz"


@pytest.mark.parametrize("row", [SHORT, LONG, EMPTY_CELL])
def test_rows_that_do_not_fit(spark, tmp, row):
    path = write_csv(tmp, "a.csv", HEADER, [GOOD[0], row, GOOD[1]])
    with pytest.raises(files.StrictLoadError):
        files.read_csv_strict(spark, path)
    valid, bad = files.read_csv_quarantine(spark, path)
    assert valid.count() == 2
    got = bad.collect()
    assert len(got) == 1 and got[0]["erros"]
    if row != EMPTY_CELL:
        assert files.MALFORMED in got[0]["erros"] and got[0][files.MALFORMED] == row
        for read in (lambda: files.read_processed(spark, os.path.join(tmp, "none"), path),
                     lambda: files.load_first_available(spark, [("csv", path)])[0]):
            with pytest.raises(Exception, match="malformed CSV row"):
                read().collect()


def test_unknown_columns_are_kept(spark, tmp):
    path = write_csv(tmp, "a.csv", HEADER + ",LOTE", [g + ",x7" for g in GOOD])
    df = files.read_processed(spark, os.path.join(tmp, "none"), path)
    assert {r["lote"] for r in df.collect()} == {"x7"}
    files.save_processed(df, os.path.join(tmp, "ds.parquet"))
    again = files.read_processed(spark, os.path.join(tmp, "ds.parquet"), required=("lote",))
    assert "lote" in again.columns
    with pytest.raises(ValueError):
        files.read_processed(spark, os.path.join(tmp, "ds.parquet"), required=("rendimento",))


def test_empty_parquet_folder_is_the_next_candidate(spark, tmp):
    os.makedirs(os.path.join(tmp, "empty"))
    write_csv(os.path.join(tmp, "csv"), "a.csv", HEADER, GOOD)
    df, label = files.load_first_available(
        spark, [("parquet", os.path.join(tmp, "empty")), ("csv", os.path.join(tmp, "csv"))])
    assert label.startswith("csv:") and df.count() == 2
