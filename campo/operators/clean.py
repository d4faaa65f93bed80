"""Projections, predicates and data quality.

All operators here are narrow (per-row) except ``onehot_observed`` (one
distinct pass over the category column) and ``quality_counts`` / ``cohort_yield``
(partial + final hash aggregates).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.functions import as_col, flag_list, nan_to_null, norm_text, parse_wallclock
from campo.schema import (BOMBA_LIGADA, DEFAULTS, ID_PIVOS, LIMITES, PIVOT_COLUMN,
                          SOLO_BOM, SOLO_RUIM)

DOUBLE_READINGS = ("umidade", "temperatura", "ph")


def normalize_columns(df: DataFrame) -> DataFrame:
    """Strip + lower-case every column name."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


def nan_as_null(df: DataFrame, cols=None) -> DataFrame:
    """NaN -> NULL in floating columns, so comparisons treat it as missing."""
    cols = cols or [f.name for f in df.schema.fields
                    if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: nan_to_null(c) for c in cols})


def parse_timestamp(df: DataFrame, col: str = "capturado_em") -> DataFrame:
    """Text / zoned timestamp -> TIMESTAMP_NTZ, NULL on bad input."""
    dt = df.schema[col].dataType
    if isinstance(dt, T.TimestampNTZType):
        return df
    if isinstance(dt, T.StringType):
        return df.withColumn(col, parse_wallclock(col))
    return df.withColumn(col, F.col(col).cast("timestamp_ntz"))


def pump_flag_strict(c="estado_bomba") -> Column:
    """1 when strip+upper == 'ON', else 0 (NULL counts as off)."""
    return F.coalesce((norm_text(as_col(c)) == F.lit("ON")).cast("int"), F.lit(0))


def pump_flag_lenient(c="estado_bomba") -> Column:
    """1 for ON / 1 / TRUE / LIGADA (any case, padded), else 0."""
    return F.coalesce(norm_text(as_col(c).cast("string")).isin(*BOMBA_LIGADA).cast("int"),
                      F.lit(0))


def time_parts(df: DataFrame, ts: str = "capturado_em") -> DataFrame:
    """Hora (0–23) and dia_semana (Monday = 0)."""
    return df.withColumns({"hora": F.hour(ts), "dia_semana": F.weekday(ts)})


def time_defaults(df: DataFrame, ts: str = "capturado_em", hora: str = "hora",
                  dia: str = "dia_semana", default_hora: int = 12,
                  default_dia: int = 0) -> DataFrame:
    """P05 + M11: explicit hora / dia_semana win, else derived from the
    timestamp text (offset ignored, hour as written), else the default."""
    t = parse_wallclock(ts)
    h = F.col(hora).cast("int") if hora in df.columns else F.lit(None).cast("int")
    d = F.col(dia).cast("int") if dia in df.columns else F.lit(None).cast("int")
    return df.withColumns({
        hora: F.coalesce(h, F.hour(t), F.lit(default_hora)),
        dia: F.coalesce(d, F.weekday(t), F.lit(default_dia)),
    })


def engineer_features(df: DataFrame) -> DataFrame:
    """P01 + P02 + P04 in one projection (the preparation's feature step)."""
    df = parse_timestamp(df)
    return time_parts(df).withColumn("estado_bomba_bin", pump_flag_strict("estado_bomba"))


def onehot_fixed(df: DataFrame, col: str = PIVOT_COLUMN, values=ID_PIVOS,
                 prefix: str = PIVOT_COLUMN) -> DataFrame:
    """One-hot over a fixed vocabulary; unknown and missing values give all zeros."""
    v = F.lower(F.trim(F.col(col)))
    return df.withColumns({f"{prefix}_{x}": F.coalesce((v == F.lit(x)).cast("int"), F.lit(0)) for x in values})


def onehot_observed(df: DataFrame, col: str = PIVOT_COLUMN, prefix: str = PIVOT_COLUMN,
                    sparse: bool = False) -> DataFrame:
    """One-hot over the observed categories (sorted, NULL dropped).

    One column per category, so the distinct categories reach the driver as
    column names.  For a wide vocabulary ask for ``sparse``: one vector column
    ``<prefix>_vec`` by MLlib's indexer and encoder (all zeros for NULL)."""
    text = F.col(col).cast("string")
    if sparse:
        from pyspark.ml import Pipeline
        from pyspark.ml.feature import OneHotEncoder, StringIndexer
        # "keep" gives NULL an index of its own, the last, which dropLast leaves out
        stages = [StringIndexer(inputCol="_cat", outputCol="_idx", stringOrderType="alphabetAsc", handleInvalid="keep"),
                  OneHotEncoder(inputCol="_idx", outputCol=f"{prefix}_vec", dropLast=True)]
        named = df.withColumn("_cat", text)
        return Pipeline(stages=stages).fit(named).transform(named).drop("_cat", "_idx")
    vocab = [r["v"] for r in df.select(text.alias("v")).where(F.col("v").isNotNull()).distinct().orderBy("v").collect()]
    return df.withColumns({f"{prefix}_{x}": F.coalesce((text == F.lit(x)).cast("int"), F.lit(0))
                           for x in vocab})


def pivot_filter(df: DataFrame, pivo: str | None, col: str = PIVOT_COLUMN) -> DataFrame:
    """One pivot, or all for None / 'Todos'.  Pushed down to the scan."""
    if not pivo or pivo == "Todos":
        return df
    return df.where(F.col(col).cast("string") == F.lit(pivo))


def quality_reasons(df: DataFrame, required=("temperatura", "n", "p", "k"),
                    out: str = "motivos") -> DataFrame:
    """Array of reasons why a reading is outside the service contract."""
    checks = []
    for c in required:
        if c in df.columns:
            checks.append((f"{c}_ausente", F.col(c).isNull()))
    for c, (lo, hi) in LIMITES.items():
        if c in df.columns:
            x = F.col(c).cast("double")
            checks.append((f"{c}_fora_da_faixa", F.isnan(x) | (x < lo) | (x > hi)))
    if PIVOT_COLUMN in df.columns:
        checks.append(("id_pivo_invalido",
                       ~F.coalesce(F.lower(F.trim(F.col(PIVOT_COLUMN))).isin(*ID_PIVOS),
                                   F.lit(False))))
    if "capturado_em" in df.columns and isinstance(df.schema["capturado_em"].dataType, T.StringType):
        checks.append(("capturado_em_invalido", F.col("capturado_em").isNotNull()
                       & parse_wallclock("capturado_em").isNull()))
    return df.withColumn(out, flag_list(checks))


def quality_split(df: DataFrame, out: str = "motivos") -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine) frames.  Both come from one lineage; write or
    cache the tagged frame first when both sides are materialised."""
    tagged = quality_reasons(df, out=out)
    return (tagged.where(F.size(out) == 0).drop(out), tagged.where(F.size(out) > 0))


def quality_counts(df: DataFrame, out: str = "motivos") -> DataFrame:
    """Number of readings per reason (a reading may have several)."""
    tagged = quality_reasons(df, out=out)
    return (tagged.select(F.explode_outer(out).alias("motivo"))
            .where(F.col("motivo").isNotNull())
            .groupBy("motivo").agg(F.count(F.lit(1)).alias("leituras")))


def fill_defaults(df: DataFrame, profile: str = "service") -> DataFrame:
    """Default values for missing readings ("service" or "zero" profile)."""
    d = DEFAULTS[profile]
    out = {}
    for c, v in d.items():
        if c in df.columns:
            dt = df.schema[c].dataType
            out[c] = F.coalesce(F.col(c), F.lit(v).cast(dt))
    return df.withColumns(out)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Names of the numeric columns (schema only, no job)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def restamp(df: DataFrame, col: str = "capturado_em") -> DataFrame:
    """Replace the capture time by the arrival time (second precision)."""
    return df.withColumn(col, F.date_trunc("second", F.localtimestamp()).cast("timestamp_ntz"))


def period_of_day(c="hora") -> Column:
    """manhã 06–11, tarde 12–17, noite otherwise (NULL hour -> NULL)."""
    h = as_col(c)
    return (F.when(h.between(6, 11), F.lit("manhã"))
            .when(h.between(12, 17), F.lit("tarde"))
            .when(h.isNotNull(), F.lit("noite")))


def soil_cohorts(umidade="umidade", ph="ph") -> tuple[Column, Column]:
    """P19 predicates: good soil and bad soil."""
    u, p = as_col(umidade), as_col(ph)
    good = (u.between(*SOLO_BOM["umidade"]) & p.between(*SOLO_BOM["ph"]))
    bad = (u < SOLO_RUIM["umidade_lt"]) | (p < SOLO_RUIM["ph_lt"])
    return good, bad


def cohort_yield(df: DataFrame, target: str = "rendimento") -> DataFrame:
    """Mean target of the good-soil and bad-soil cohorts, one pass."""
    good, bad = soil_cohorts()
    y = F.col(target)
    return df.agg(
        F.avg(F.when(good, y)).alias("media_solo_bom"),
        F.avg(F.when(bad, y)).alias("media_solo_ruim"),
        F.count(F.when(good, 1)).alias("n_solo_bom"),
        F.count(F.when(bad, 1)).alias("n_solo_ruim"),
    )
