"""Every SQL-checked named query against DuckDB on the smallest tables."""

import math
import os

import duckdb
import pytest

from tests.conftest import SF_SMALL

from __spark_entry__ import oracle_sql, queries  # noqa: E402

NAMES = sorted(oracle_sql())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for f in os.listdir(SF_SMALL):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{os.path.join(SF_SMALL, f)}')")
    return c


def _rows(pdf):
    import pandas as pd
    cols = sorted(pdf.columns)

    def norm(v):
        if v is None or pd.isna(v):
            return None
        if isinstance(v, float):
            return round(v, 6)
        return v.item() if hasattr(v, "item") else v
    return cols, sorted((tuple(norm(x) for x in r) for r in pdf[cols].itertuples(index=False)),
                        key=repr)


def _same(a, b):
    """Equal rows; floats may differ by one unit in the 6th decimal (a mean of
    grid-valued data can sit exactly on a rounding tie, and the two engines
    sum in different orders)."""
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if not math.isclose(x, y, rel_tol=1e-12, abs_tol=1.5e-6):
                return False
        elif x != y:
            return False
    return True


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    s = queries()[name](spark, SF_SMALL).toPandas()
    d = con.execute(oracle_sql()[name]).df()
    sc, sr = _rows(s)
    dc, dr = _rows(d)
    assert sc == dc
    assert len(sr) == len(dr)
    bad = [(x, y) for x, y in zip(sr, dr) if not _same(x, y)]
    assert not bad, bad[:3]


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert df.columns == ["id_pivo", "code", "ocorrencias"]
    assert df.count() > 0
