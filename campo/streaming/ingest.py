"""Readings arriving as files -> the readings table (ST1–ST5).

* ST1: ``readStream`` over a folder of CSV (or Parquet) files, at most
  ``max_files_per_trigger`` files per micro-batch.  CSV cells arrive as text and
  are checked like a quarantine load: bad rows go to a folder with their
  reasons, valid ones to the catalog table, with a row key.  Without a folder
  a batch with a bad row fails before anything of it is written.
* ST2: ``available_now=True`` runs a bounded catch-up and stops.
* ST3: exactly-once into the table: a micro-batch overwrites its own ``lote``
  partition, so a batch replayed after a failure (its commit not yet in the
  checkpoint) replaces itself instead of duplicating rows.
* ST4: optional arrival-time restamp.
* ST5: per-batch counts with the running total go to a small log, one folder a
  batch; a batch adds its rows to the total of the batch before it, and counts
  the earlier batches in the table where that log is gone.
* With a summaries folder, each batch's rows are summarised by pivot from its
  partition (:mod:`campo.operators.sketches`); a replayed batch replaces its
  summaries too.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from campo.operators import sketches
from campo.operators.clean import parse_timestamp, restamp as _restamp
from campo.schema import KEY, READINGS_RAW
from campo.sources.files import MALFORMED, StrictLoadError, split_tagged, tag_readings
from campo.sources.tables import LOTE, create_table, replace_lote, with_row_key


def arriving_readings(spark: SparkSession, source: str, schema: T.StructType = READINGS_RAW,
                      fmt: str = "csv", max_files_per_trigger: int | None = 1) -> DataFrame:
    """ST1 source: a streaming frame over files landing in ``source``.

    CSV cells stay text, with ``MALFORMED`` for rows that do not fit.  Headers
    are checked against the schema by name (``enforceSchema`` off), so a
    reordered file fails instead of silently swapping columns."""
    if fmt == "csv":
        schema = T.StructType([*[T.StructField(f.name, T.StringType()) for f in schema.fields],
                               T.StructField(MALFORMED, T.StringType())])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "csv":
        return r.options(header=True, enforceSchema=False, mode="PERMISSIVE", columnPruning=False,
                         columnNameOfCorruptRecord=MALFORMED).csv(source)
    return r.format(fmt).load(source)


def _total_before(spark: SparkSession, log_path: str, batch_id: int, table: str) -> int:
    """The running total of the batch before; where its log is gone, the rows
    of the earlier batches in the table."""
    if batch_id == 0:
        return 0
    try:
        row = spark.read.parquet(f"{log_path}/batch_id={batch_id - 1}").first()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        row = None
    if row is not None:
        return int(row["acumulado"])
    spark.catalog.refreshTable(table)
    earlier = (F.col(LOTE) >= _lote(0)) & (F.col(LOTE) < _lote(batch_id))
    return spark.table(table).where(earlier).count()


def _lote(batch_id: int) -> str:
    return f"fluxo-{batch_id:012d}"


#: columns summarised for each batch
SUMMARISED = ("umidade", "temperatura", "ph", "n", "p", "k")


def _writer(table: str, quarantine: str | None, log_path: str | None, restamp: bool, summaries: str | None = None):
    def write_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        valid = batch
        if MALFORMED in batch.columns:
            tagged = tag_readings(batch).persist()
            valid, bad = split_tagged(tagged)
            if quarantine:
                bad.write.mode("overwrite").parquet(f"{quarantine}/batch_id={batch_id}")
            elif first := bad.first():
                tagged.unpersist()
                raise StrictLoadError(f"bad row in batch {batch_id} and no quarantine folder: {first}")
        valid = parse_timestamp(valid)
        if restamp:
            valid = _restamp(valid)
        lote = _lote(batch_id)
        keyed = valid if KEY in valid.columns else with_row_key(spark, valid, table)
        obs = Observation(f"lote_{batch_id}")
        replace_lote(spark, keyed.observe(obs, F.count(F.lit(1)).alias("n")), lote, table)
        n = int(obs.get.get("n", 0) or 0)
        if MALFORMED in batch.columns:
            tagged.unpersist()
        if summaries:
            spark.catalog.refreshTable(table)
            sketches.store(spark.table(table).where(F.col(LOTE) == lote), summaries, lote, SUMMARISED)
        if log_path:
            total = _total_before(spark, log_path, batch_id, table) + n
            spark.createDataFrame([(n, total)], "linhas long, acumulado long") \
                .coalesce(1).write.mode("overwrite").parquet(f"{log_path}/batch_id={batch_id}")
    return write_batch


def ingest_stream(stream: DataFrame, table: str, checkpoint: str, quarantine: str | None = None,
                  log_path: str | None = None, restamp: bool = False,
                  available_now: bool = True, interval: str = "10 seconds",
                  summaries: str | None = None) -> StreamingQuery:
    """ST1–ST5: start the ingest query into the catalog table ``table`` (made
    with ``lote`` partitions if absent); idempotent per batch."""
    spark = stream.sparkSession
    create_table(spark, table, by_lote=True)
    if LOTE not in spark.table(table).columns:
        raise ValueError(f"table {table!r} has no {LOTE!r} partitions to replace a batch in")
    w = (stream.writeStream.foreachBatch(_writer(table, quarantine, log_path, restamp, summaries))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)
    return w.start()


def batch_counts(spark: SparkSession, log_path: str) -> DataFrame:
    """ST5: rows per batch and the running total (one row per batch)."""
    return spark.read.parquet(log_path).select(F.col("batch_id").cast("long").alias("batch_id"), "linhas", "acumulado")
