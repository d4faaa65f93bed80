"""Live scoring and advice on arriving readings (ST6) and a windowed trend.

The very same DataFrame transformations as the batch path (features ->
models -> advice) are applied to a streaming frame; nothing here is
stream-specific except the sink and the optional watermark."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from campo.operators.advice import advice
from campo.operators.clean import engineer_features, fill_defaults, nan_as_null
from campo.operators.learn import score


def score_readings(df: DataFrame, models: dict[str, PipelineModel],
                   defaults: str | None = None) -> DataFrame:
    """Readings (batch or stream) -> features -> predictions -> advice list.

    Predictions absent for a target (no model) leave its rule silent; pH
    advice falls back to the measured pH."""
    x = engineer_features(nan_as_null(df))
    if defaults:
        x = fill_defaults(x, defaults)
    x = score(x, models)

    def pred(t):
        return f"pred_{t}" if t in models else None

    return x.withColumn("sugestoes", advice(
        volume=pred("volume_irrigacao"), necessity=pred("necessidade_fertilizacao"),
        yield_=pred("rendimento"), ph_pred=pred("ph"), ph_reading="ph"))


def windowed_trend(df: DataFrame, value: str = "rendimento", ts: str = "capturado_em",
                   window: str = "1 day", watermark: str = "1 day", by=("id_pivo",)) -> DataFrame:
    """A14 in streaming form: mean per pivot and event-time window, with a
    watermark bounding the state kept for late readings.  Watermarks need a
    zoned timestamp, so the wall-clock NTZ column is cast to one in the
    session time zone; windows align to UTC midnight, so day windows follow
    the wall-clock days when the session zone is UTC (campo's default)."""
    t = F.col(ts).cast("timestamp")
    return (df.withColumn("_ts", t).withWatermark("_ts", watermark)
            .groupBy(F.window("_ts", window).alias("janela"), *by)
            .agg(F.avg(value).alias("media"), F.count(F.lit(1)).alias("leituras")))
