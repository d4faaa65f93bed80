"""Model store (S13): one MLlib PipelineModel directory per target.

The assembler stage inside each pipeline records the model's feature list, so
scoring can align any frame to it (P10)."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from campo.schema import TARGETS


def model_path(base: str, target: str) -> str:
    return f"{base.rstrip('/')}/modelo_{target}"


def save_models(models: dict[str, PipelineModel], base: str) -> dict[str, str]:
    """Save every model (overwrite); returns target -> path."""
    out = {}
    for t, m in models.items():
        p = model_path(base, t)
        m.write().overwrite().save(p)
        out[t] = p
    return out


def _present(spark: SparkSession, path: str) -> bool:
    """Whether the folder exists (a listing, no file is read)."""
    try:
        spark.read.format("binaryFile").load(path)
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return False
        raise


def load_models(base: str, targets=TARGETS, required: bool = True) -> dict[str, PipelineModel]:
    """Load the models present, skip those without a folder; raise when none is
    found (unless ``required=False``, where the caller falls back to stub
    scores).  A folder that is there but cannot be loaded is an error."""
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    out = {t: PipelineModel.load(model_path(base, t)) for t in targets if _present(spark, model_path(base, t))}
    if not out and required:
        raise FileNotFoundError(f"no model 'modelo_<alvo>' under {base!r}")
    return out
