"""Schemas and fixed constants of the readings domain."""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must equal the original application's for equal results).
# Agronomic optimum / spread of the bell curves, nutrient ideals, irrigation
# target, rule thresholds, service limits, pivots and pump vocabulary.
# --------------------------------------------------------------------------
UMIDADE_OPT, UMIDADE_SD = 62.5, 12.0
PH_OPT, PH_SD = 6.5, 0.6
TEMP_OPT, TEMP_SD = 25.0, 7.0
N_IDEAL, P_IDEAL, K_IDEAL = 70.0, 60.0, 60.0
NPK_SD = 25.0
UMIDADE_ALVO_IRRIGACAO = 65.0

RENDIMENTO_MAX = 80.0
VOLUME_MAX = 40.0
FERTILIZACAO_MAX = 100.0
NOISE_SD = {"rendimento": 3.0, "volume_irrigacao": 1.5, "necessidade_fertilizacao": 3.0}

PH_BOM_MIN, PH_BOM_MAX = 6.0, 7.0
LIMIAR_IRRIGAR_MM = 5.0
LIMIAR_SOLO_ADEQUADO_MM = 1.0
LIMIAR_FERTILIZAR = 50.0
LIMIAR_FERTILIZAR_MODERADO = 20.0
LIMIAR_RENDIMENTO_BAIXO = 40.0
LIMIAR_UMIDADE_BAIXA = 55.0

# Service limits of one reading: column -> (low, high), inclusive.
LIMITES = {
    "temperatura": (-10.0, 60.0),
    "n": (0.0, 200.0),
    "p": (0.0, 200.0),
    "k": (0.0, 200.0),
    "umidade": (0.0, 100.0),
    "ph": (0.0, 14.0),
}
ID_PIVOS = ("p1", "p2", "p3")
BOMBA_LIGADA = ("ON", "1", "TRUE", "LIGADA")

# Cohorts of the invariant "good soil yields more than bad soil".
SOLO_BOM = {"umidade": (55.0, 70.0), "ph": (6.0, 7.0)}
SOLO_RUIM = {"umidade_lt": 40.0, "ph_lt": 4.5}

# Service defaults for missing values ("service" profile) vs. library ("zero").
DEFAULTS = {
    "service": {"umidade": 60.0, "ph": 6.5, "hora": 12, "dia_semana": 0,
                "estado_bomba_bin": 1, "id_pivo": "p1"},
    "zero": {"umidade": 0.0, "ph": 0.0, "temperatura": 0.0, "n": 0.0, "p": 0.0,
             "k": 0.0, "hora": 0, "dia_semana": 0, "estado_bomba_bin": 0,
             "id_pivo": "p1"},
}

# --------------------------------------------------------------------------
# Fixed values (must equal the original application's): column vocabulary,
# targets and the inputs of each target's model.
# --------------------------------------------------------------------------
KEY = "id_leitura"
RAW_COLUMNS = ["id_pivo", "umidade", "temperatura", "ph", "n", "p", "k",
               "estado_bomba", "capturado_em"]
TARGETS = ["rendimento", "volume_irrigacao", "necessidade_fertilizacao", "umidade", "ph"]
BASE_FEATURES = ["temperatura", "n", "p", "k", "estado_bomba_bin", "hora", "dia_semana"]
CONTEXT_FEATURES = ["umidade", "ph"]
TARGET_INPUTS = {
    "rendimento": ["temperatura", "n", "p", "k", "estado_bomba_bin", "hora", "dia_semana", "umidade", "ph"],
    "volume_irrigacao": ["temperatura", "n", "p", "k", "estado_bomba_bin", "hora", "dia_semana", "umidade", "ph"],
    "necessidade_fertilizacao": ["temperatura", "n", "p", "k", "estado_bomba_bin", "hora", "dia_semana", "umidade", "ph"],
    "umidade": ["temperatura", "n", "p", "k", "estado_bomba_bin", "hora", "dia_semana"],
    "ph": ["temperatura", "n", "p", "k", "estado_bomba_bin", "hora", "dia_semana"],
}
PIVOT_COLUMN = "id_pivo"
PIVOT_DUMMIES = [f"id_pivo_{p}" for p in ID_PIVOS]
FEATURE_COLUMNS = BASE_FEATURES + CONTEXT_FEATURES + PIVOT_DUMMIES

# Raw readings as they arrive in a CSV / table (timestamp still text).
READINGS_RAW = T.StructType([
    T.StructField("id_pivo", T.StringType(), False),
    T.StructField("umidade", T.DoubleType()),
    T.StructField("temperatura", T.DoubleType()),
    T.StructField("ph", T.DoubleType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("p", T.IntegerType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("estado_bomba", T.StringType()),
    T.StructField("capturado_em", T.StringType()),
])

# Stored table: a row key plus typed readings.
READINGS_TABLE = T.StructType(
    [T.StructField(KEY, T.LongType(), False)]
    + [f if f.name != "capturado_em" else T.StructField("capturado_em", T.TimestampNTZType())
       for f in READINGS_RAW.fields])

ADVICE_ITEM = T.StructType([
    T.StructField("code", T.StringType(), False),
    T.StructField("value", T.DoubleType()),
    T.StructField("detail", T.StringType()),
    T.StructField("text", T.StringType(), False),
])
