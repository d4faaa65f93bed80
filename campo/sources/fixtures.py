"""Readings derived from the driver's ``events`` table.

There is no farm data among the test tables, so a deterministic adapter maps
each event to one pivot reading.  It is a projection only (no shuffle): every
event becomes exactly one reading, so the work grows with the table.

The *dirty* variant injects the missing / malformed values the cleaning code
must handle: NULL pH, NULL and padded pump states, unparsable timestamps.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from campo.schema import KEY

EVENT_COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


# Row keys of the test tables, used to spread single-file inputs.
TABLE_KEYS = {"events": "event_id", "lineitem": "l_orderkey", "orders": "o_orderkey"}


def load_table(spark: SparkSession, sf_dir: str, name: str, spread: int | None = None) -> DataFrame:
    """One test table as it is scanned; with ``spread`` hash-spread over that
    many partitions by its row key (for heavy row work on a single-split file)."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.repartition(spread, TABLE_KEYS[name]) if spread else df


def readings_from_events(events: DataFrame, dirty: bool = True) -> DataFrame:
    """events(event_id, ts, user_id, event_type, value, props) -> raw readings.

    Output columns: id_leitura, id_pivo, umidade, temperatura, ph, n, p, k,
    estado_bomba, capturado_em (text in the dirty variant, TIMESTAMP_NTZ in the
    clean one).
    """
    e = events.select(*EVENT_COLUMNS)
    v = F.round(F.col("value") * F.lit(100.0)).cast("bigint")
    eid = F.col("event_id")
    uid = F.col("user_id")
    ph = F.lit(4.5) + ((F.lit(3) * v + F.lit(53) * uid + eid) % 400) / F.lit(100.0)
    on = F.col("event_type").isin("click", "purchase", "signup")
    pump = F.when(on, F.lit("ON")).otherwise(F.lit("OFF"))
    ts_text = F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss")
    if dirty:
        ph = F.when(eid % 97 == 0, F.lit(None).cast("double")).otherwise(ph)
        pump = (F.when(eid % 101 == 0, F.lit(None).cast("string"))
                .when(on & (eid % 5 == 0), F.lit(" on "))
                .otherwise(pump))
        ts_out = F.when(eid % 89 == 0, F.lit("bad")).otherwise(ts_text)
    else:
        ts_out = F.col("ts")
    return e.select(
        eid.alias(KEY),
        F.concat(F.lit("p"), (uid % 3 + 1).cast("string")).alias("id_pivo"),
        (F.lit(20.0) + ((F.lit(7) * v + eid) % 7000) / F.lit(100.0)).alias("umidade"),
        (F.lit(10.0) + ((v + F.lit(37) * uid) % 3000) / F.lit(100.0)).alias("temperatura"),
        ph.alias("ph"),
        ((v + uid) % 141).cast("int").alias("n"),
        ((F.lit(7) * v + eid) % 146).cast("int").alias("p"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        pump.alias("estado_bomba"),
        ts_out.alias("capturado_em"),
    )


def spoil(df: DataFrame) -> DataFrame:
    """Readings with values outside every limit, missing and unknown pivots,
    missing nutrients, NaN, and all spellings of the pump state."""
    i = F.col(KEY)
    null = lambda c: F.lit(None).cast(df.schema[c].dataType)
    return df.withColumns({
        "id_pivo": F.when(i % 31 == 0, null("id_pivo")).when(i % 37 == 0, F.lit("p9")).when(i % 41 == 0, F.lit(" P2 ")).otherwise(F.col("id_pivo")),
        "umidade": F.when(i % 43 == 0, F.lit(101.5)).when(i % 47 == 0, F.lit(float("nan"))).otherwise(F.col("umidade")),
        "temperatura": F.when(i % 53 == 0, F.lit(-11.0)).when(i % 59 == 0, null("temperatura")).otherwise(F.col("temperatura")),
        "ph": F.when(i % 61 == 0, F.lit(14.5)).otherwise(F.col("ph")),
        "n": F.when(i % 67 == 0, null("n")).when(i % 71 == 0, F.lit(201)).otherwise(F.col("n")),
        "p": F.when(i % 73 == 0, null("p")).when(i % 79 == 0, F.lit(-1)).otherwise(F.col("p")),
        "k": F.when(i % 83 == 0, null("k")).when(i % 103 == 0, F.lit(500)).otherwise(F.col("k")),
        "estado_bomba": F.when(i % 11 == 0, F.lit("1")).when(i % 13 == 0, F.lit("true")).when(i % 17 == 0, F.lit(" Ligada")).otherwise(F.col("estado_bomba")),
    })


def readings(spark: SparkSession, sf_dir: str, dirty: bool = True) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), dirty=dirty)
