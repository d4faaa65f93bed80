"""File sources and sinks.

CSV pitfalls handled here:
* columns are matched by header *name* (never by position), file by file: files
  of one folder may differ in column order, and are read per distinct header;
* a row with too few or too many cells is kept aside as malformed, it is never
  padded or cut without a word;
* a strict load parses every cell of every column — Spark's FAILFAST is lazy
  and column-pruned, and an empty numeric cell is NULL even under FAILFAST —
  so strictness is an explicit validation aggregate;
* a quarantine load keeps bad rows aside with the reasons instead of failing;
* the other readers raise on the first malformed row they meet.
"""

from __future__ import annotations

import csv
import json
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.functions import flag_list
from campo.operators.clean import normalize_columns, parse_timestamp
from campo.schema import READINGS_RAW

PROCESSED_SCHEMA = T.StructType([
    T.StructField("id_leitura", T.LongType()),
    T.StructField("id_pivo", T.StringType()),
    T.StructField("umidade", T.DoubleType()),
    T.StructField("temperatura", T.DoubleType()),
    T.StructField("ph", T.DoubleType()),
    T.StructField("n", T.IntegerType()),
    T.StructField("p", T.IntegerType()),
    T.StructField("k", T.IntegerType()),
    T.StructField("estado_bomba", T.StringType()),
    T.StructField("capturado_em", T.TimestampNTZType()),
    T.StructField("hora", T.IntegerType()),
    T.StructField("dia_semana", T.IntegerType()),
    T.StructField("estado_bomba_bin", T.IntegerType()),
    T.StructField("rendimento", T.DoubleType()),
    T.StructField("volume_irrigacao", T.DoubleType()),
    T.StructField("necessidade_fertilizacao", T.DoubleType()),
])


#: As ``PROCESSED_SCHEMA``, with capture times as text: they are parsed after.
PROCESSED_SCHEMA_TEXT_TIME = T.StructType([
    f if f.name != "capturado_em" else T.StructField(f.name, T.StringType()) for f in PROCESSED_SCHEMA.fields])


class StrictLoadError(ValueError):
    """Raised when a strict CSV load finds missing columns or bad cells."""


MALFORMED = "_linha_malformada"


#: More than any file has: keeps every file of a header scan in a task of its own.
_ONE_FILE = 1 << 44


def _headers(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """First line -> files of ``path`` that start with it.  Each file is a task
    that stops after its first rows, so what is read does not grow with the
    files' length.  The driver gets one row per file, as it does for Spark's own
    file listing."""
    def first(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    scan = spark.newSession()  # settings of its own
    scan.conf.set("spark.sql.files.openCostInBytes", _ONE_FILE)
    scan.conf.set("spark.sql.files.maxPartitionBytes", _ONE_FILE)
    scan.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 16)
    lines = scan.read.text(path).select("value", F.col("_metadata.file_path").alias("arquivo")).mapInArrow(first, "value string, arquivo string")
    out: dict[str, list[str]] = {}
    for r in sorted(lines.collect(), key=lambda r: r["arquivo"]):
        out.setdefault(r["value"], []).append(r["arquivo"])
    return out


def _text_csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, by normalised header name (strip + lower), plus
    ``MALFORMED``: the whole line where its cells do not fit the header."""
    try:
        headers = _headers(spark, path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(path) from e
        raise
    if not headers:
        raise FileNotFoundError(f"no CSV file with a header under {path}")
    parts = []
    for header, names in headers.items():
        columns = next(csv.reader([header.lstrip("\ufeff")]))
        schema = T.StructType([*[T.StructField(c.strip().lower(), T.StringType()) for c in columns],
                               T.StructField(MALFORMED, T.StringType())])
        part = spark.read.schema(schema).options(
            header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=MALFORMED, columnPruning=False,
            enforceSchema=True).csv(path if len(headers) == 1 else names)
        parts.append(part)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _wellformed(raw: DataFrame) -> DataFrame:
    """``raw`` without ``MALFORMED``; raises when a malformed row is read."""
    # Spark parses whole rows only where a data column is asked for as well
    first = next(c for c in raw.columns if c != MALFORMED)
    ok = F.when(F.col(MALFORMED).isNull() | (F.col(first) == F.lit("\0")), True).otherwise(
        F.raise_error(F.concat(F.lit("malformed CSV row: "), F.col(MALFORMED))).cast("boolean"))
    return raw.where(ok).drop(MALFORMED)


def _typed_by_name(raw: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` that are there in their type (NULL for a cell that
    does not parse), all other columns as they are."""
    types = {f.name: f.dataType for f in schema.fields}
    return raw.select(*[
        F.trim(F.col(c)).try_cast(types[c]).alias(c)
        if c in types and not isinstance(types[c], T.StringType) else F.col(c) for c in raw.columns])


def _typed(raw: DataFrame, schema: T.StructType) -> tuple[DataFrame, list]:
    """Cast by name; returns the typed frame and per-column 'bad cell' predicates."""
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise StrictLoadError(f"missing columns: {missing}")
    cols, bad = [], []
    if MALFORMED in raw.columns:
        bad.append((MALFORMED, F.col(MALFORMED).isNotNull()))
    for f in schema.fields:
        txt = F.trim(F.col(f.name))
        if isinstance(f.dataType, T.StringType):
            cols.append(F.col(f.name).alias(f.name))
            if not f.nullable:
                bad.append((f.name, F.col(f.name).isNull() | (txt == "")))
            continue
        val = txt.try_cast(f.dataType)
        cols.append(val.alias(f.name))
        # empty or unparsable numeric text is an error in the strict contract
        bad.append((f.name, F.col(f.name).isNull() | (txt == "") | val.isNull()))
    return raw.select(*cols), bad


def read_csv_strict(spark: SparkSession, path: str,
                    schema: T.StructType = READINGS_RAW) -> DataFrame:
    """Typed CSV scan that fails on a missing file, a missing column, an
    empty or unparsable number.  One validation aggregate over all columns
    (partial counts per task), then the typed frame is returned lazily."""
    raw = _text_csv(spark, path)
    typed, bad = _typed(raw, schema)
    if bad:
        counts = raw.agg(*[F.sum(b.cast("bigint")).alias(n) for n, b in bad]).first().asDict()
        errs = {k: v for k, v in counts.items() if v}
        if errs:
            raise StrictLoadError(f"bad cells per column: {errs}")
    return typed


def tag_readings(raw: DataFrame, schema: T.StructType = READINGS_RAW) -> DataFrame:
    """All-text rows -> ``_raw`` (the row as it came), ``erros`` (columns whose
    cell does not parse, and ``MALFORMED`` for a row that does not fit its
    header) and the typed columns as ``_t_<name>``."""
    _, bad = _typed(raw, schema)
    typed_exprs = [F.col(f.name) if isinstance(f.dataType, T.StringType)
                   else F.trim(F.col(f.name)).try_cast(f.dataType) for f in schema.fields]
    return raw.select(F.struct(*[F.col(c) for c in raw.columns]).alias("_raw"),
                      flag_list(bad).alias("erros"),
                      *[e.alias(f"_t_{n}") for e, n in zip(typed_exprs, schema.names)])


def split_tagged(tagged: DataFrame, schema: T.StructType = READINGS_RAW) -> tuple[DataFrame, DataFrame]:
    """(valid typed rows, bad rows as they came + ``erros``)."""
    valid = tagged.where(F.size("erros") == 0).select(
        *[F.col(f"_t_{n}").alias(n) for n in schema.names])
    return valid, tagged.where(F.size("erros") > 0).select("_raw.*", "erros")


def read_csv_quarantine(spark: SparkSession, path: str,
                        schema: T.StructType = READINGS_RAW) -> tuple[DataFrame, DataFrame]:
    """S01 (lenient form): (valid typed rows, quarantined raw rows + ``erros``).

    One pass tags every row; both outputs derive from it (write or persist
    the tagged frame when materialising both)."""
    return split_tagged(tag_readings(_text_csv(spark, path), schema), schema)


def save_processed(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Write the processed dataset (Parquet preferred, CSV alternative).

    Overwrite goes through the committer: readers never see a half-written
    directory.  Returns the path written."""
    w = df.write.mode("overwrite")
    if fmt == "parquet":
        w.parquet(path)
    elif fmt == "csv":
        # keep padded text as is (the writer trims by default)
        (w.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
         .csv(path))
    else:
        raise ValueError(f"unknown format {fmt!r}")
    return path


def read_processed(spark: SparkSession, path: str, csv_path: str | None = None,
                   required: tuple[str, ...] = ()) -> DataFrame:
    """Parquet first, else the CSV sibling, else FileNotFoundError.

    Columns of ``PROCESSED_SCHEMA`` come in its types from either form, all
    other columns as they are stored (text, from a CSV).  A column named in
    ``required`` that is not there is an error."""
    def checked(df: DataFrame) -> DataFrame:
        absent = [c for c in required if c not in df.columns]
        if absent:
            raise ValueError(f"processed dataset lacks columns: {absent}")
        return df

    try:
        df = spark.read.parquet(path)
        types = {f.name: f.dataType for f in PROCESSED_SCHEMA.fields}
        return checked(df.select(*[F.col(f"`{c}`").cast(types[c]).alias(c) if c in types else F.col(f"`{c}`")
                                   for c in df.columns]))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
    csv_path = csv_path or (path[:-8] + ".csv" if path.endswith(".parquet") else path + ".csv")
    try:
        raw = _text_csv(spark, csv_path)
    except FileNotFoundError:
        raise FileNotFoundError(f"processed dataset not found: {path} nor {csv_path}") from None
    return checked(_typed_by_name(_wellformed(raw), PROCESSED_SCHEMA))


def load_first_available(spark: SparkSession, candidates: list[tuple[str, str]],
                         empty_schema: T.StructType = READINGS_RAW) -> tuple[DataFrame, str]:
    """First source that exists and has rows, in order.

    ``candidates`` is a list of (kind, location) with kind in
    {"table", "parquet", "csv"}; the answer is (frame, label).  Every kind
    gives typed columns and a parsed ``capturado_em``.  A missing source or an
    empty folder is skipped; any other error propagates.  Emptiness is probed with
    ``isEmpty`` (reads at most one row)."""
    for kind, loc in candidates:
        try:
            if kind == "table":
                if not spark.catalog.tableExists(loc):
                    continue
                df = normalize_columns(spark.table(loc))
            elif kind == "parquet":
                df = normalize_columns(spark.read.parquet(loc))
            elif kind == "csv":
                df = _typed_by_name(_wellformed(_text_csv(spark, loc)), PROCESSED_SCHEMA_TEXT_TIME)
            else:
                raise ValueError(f"unknown source kind {kind!r}")
        except FileNotFoundError:
            continue
        except AnalysisException as e:
            if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
                continue
            raise
        if "capturado_em" in df.columns:
            df = parse_timestamp(df)
        if not df.isEmpty():
            return df, f"{kind}:{loc}"
    return spark.createDataFrame([], empty_schema), "vazio"


def write_metrics(spark: SparkSession, doc: dict, path: str, frame: DataFrame | None = None) -> None:
    """The metrics document as one JSON file (``path``/document) and,
    when given, the flat metrics frame as Parquet (``path``/frame).  The
    document has one entry per target: bounded and tiny."""
    spark.createDataFrame([(json.dumps(doc, ensure_ascii=False),)], "value string") \
        .coalesce(1).write.mode("overwrite").text(f"{path}/document")
    if frame is not None:
        frame.write.mode("overwrite").parquet(f"{path}/frame")


def read_metrics(spark: SparkSession, path: str) -> dict:
    """The metrics document, {} when absent."""
    try:
        rows = spark.read.text(f"{path}/document").collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return {}
        raise
    return json.loads("".join(r["value"] for r in rows)) if rows else {}
