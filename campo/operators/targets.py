"""Engineered agronomic targets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campo.functions import bell, clip, gaussian_noise, mean_of, relu
from campo.operators.clean import engineer_features, nan_as_null, normalize_columns
from campo.schema import (FERTILIZACAO_MAX, K_IDEAL, KEY, N_IDEAL, NOISE_SD, NPK_SD,
                          P_IDEAL, PH_OPT, PH_SD, RENDIMENTO_MAX, TEMP_OPT, TEMP_SD,
                          UMIDADE_ALVO_IRRIGACAO, UMIDADE_OPT, UMIDADE_SD, VOLUME_MAX)


def target_expressions(noise: bool = False, key: str = KEY, seed: int = 42,
                       clipped: bool = True) -> dict:
    """Column expressions of the three simulated targets.

    ``noise=True`` adds reproducible Gaussian noise keyed by the row key
    (independent of partitioning, unlike a seeded generator over row order).
    """
    u, ph, t = F.col("umidade"), F.col("ph"), F.col("temperatura")
    n, p, k = F.col("n"), F.col("p"), F.col("k")

    def eps(name):
        return gaussian_noise(key, name, NOISE_SD[name], seed) if noise else F.lit(0.0)

    f_npk = mean_of(bell(n, N_IDEAL, NPK_SD), bell(p, P_IDEAL, NPK_SD), bell(k, K_IDEAL, NPK_SD))
    rend = (F.lit(RENDIMENTO_MAX) * bell(u, UMIDADE_OPT, UMIDADE_SD) * bell(ph, PH_OPT, PH_SD)
            * f_npk * bell(t, TEMP_OPT, TEMP_SD))
    vol = (relu(F.lit(UMIDADE_ALVO_IRRIGACAO) - u) * F.lit(0.8)
           + F.lit(0.15) * relu(t - F.lit(20.0)))
    fert = ((relu(F.lit(N_IDEAL) - n) + relu(F.lit(P_IDEAL) - p) + relu(F.lit(K_IDEAL) - k))
            / F.lit(N_IDEAL + P_IDEAL + K_IDEAL) * F.lit(100.0))
    raw = {"rendimento": rend + eps("rendimento"),
           "volume_irrigacao": vol + eps("volume_irrigacao"),
           "necessidade_fertilizacao": fert + eps("necessidade_fertilizacao")}
    if not clipped:
        return raw
    return {t: clip(e, 0.0, _MAX[t]) for t, e in raw.items()}


_MAX = {"rendimento": RENDIMENTO_MAX, "volume_irrigacao": VOLUME_MAX,
        "necessidade_fertilizacao": FERTILIZACAO_MAX}


def engineer_targets(df: DataFrame, noise: bool = False, key: str = KEY,
                     seed: int = 42) -> DataFrame:
    """Unclipped values in one projection, clipped in the next.

    The clip reads a column reference, so the (expensive) formula is computed
    once per row; Catalyst keeps the two projections apart because the raw
    value is non-trivial and referenced twice, and both run in the same
    whole-stage-codegen function."""
    raw = target_expressions(noise, key, seed, clipped=False)
    tmp = {t: f"_{t}_bruto" for t in raw}
    return (df.withColumns({tmp[t]: e for t, e in raw.items()})
            .withColumns({t: clip(F.col(tmp[t]), 0.0, _MAX[t]) for t in raw})
            .drop(*tmp.values()))


def prepare(df: DataFrame, noise: bool = False, key: str = KEY, seed: int = 42) -> DataFrame:
    """Raw readings -> processed dataset (15 columns + key).

    normalise names -> NaN as NULL -> timestamp, hour, weekday, pump flag ->
    targets.  A single narrow stage; write it with ``sources.files.save_processed``.
    """
    df = nan_as_null(normalize_columns(df))
    return engineer_targets(engineer_features(df), noise=noise, key=key, seed=seed)
