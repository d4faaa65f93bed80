"""Catalog-table sources and sinks.

The readings table is a Parquet table in the session catalog (or an external
table at a shared path).  Writes go through the output committer, so a
failed task or lost executor never leaves partial files behind.
"""

from __future__ import annotations

import re
import secrets
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.operators.clean import restamp as _restamp
from campo.schema import KEY, READINGS_TABLE

TABLE = "sensores_campo"
LOTE = "lote"  # partition of one load or one micro-batch
BLOCK_BITS = 32                # keys of a reserved block: 2^32
BLOCKS = 1 << 31               # blocks in all; block 0 is left to rows that bring their key
VERSIONS = "__v"               # versions of a table's rows lie beside its first location
RESERVED = "__chaves"          # one empty file for each reserved block


def create_table(spark: SparkSession, name: str = TABLE,
                 schema: T.StructType = READINGS_TABLE, path: str | None = None,
                 by_lote: bool = False) -> bool:
    """Idempotent CREATE TABLE IF NOT EXISTS ... USING parquet; with
    ``by_lote`` partitioned by load, as streams need it.

    Returns True when the table was created by this call."""
    if spark.catalog.tableExists(name):
        return False
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                     + ("" if f.nullable else " NOT NULL") for f in schema.fields)
    loc = f" LOCATION '{path}'" if path else ""
    cols, part = (cols + f", `{LOTE}` string", f" PARTITIONED BY ({LOTE})") if by_lote else (cols, "")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{part}{loc}")
    return True


def _align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select the table's columns by name with the table's types; rows of a
    table by ``lote`` get one of their own where they name none."""
    if LOTE in schema.names and LOTE not in df.columns:
        df = df.withColumn(LOTE, F.lit(f"carga-{uuid.uuid4().hex}"))
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def _base(spark: SparkSession, name: str) -> str:
    """The table's first location, whichever version it shows now."""
    return re.sub(rf"{VERSIONS}/[^/]+/?$", "", _location(spark, name)).rstrip("/")


def _path(spark: SparkSession, path: str):
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def reserve_blocks(spark: SparkSession, name: str, n: int, draw=secrets.randbelow) -> list[int]:
    """Reserve ``n`` blocks of keys for one load of the table.

    A block is drawn at random and is this load's if its file, made only where
    there is none, could be made; else another is drawn.  The cost does not
    depend on the table or on the loads before, and loads side by side get
    different blocks (as surely as the file system makes a file only once)."""
    got: list[int] = []
    while len(got) < n:
        block = 1 + draw(BLOCKS - 1)
        fs, path = _path(spark, f"{_base(spark, name)}{RESERVED}/{block}")
        if fs.createNewFile(path):
            got.append(block)
    return got


def with_row_key(spark: SparkSession, df: DataFrame, name: str = TABLE, key: str = KEY) -> DataFrame:
    """Give keyless readings a row key once, at load time (it is then stored).

    Raw readings have no natural key and may contain exact duplicates, so a
    content hash cannot serve.  A key is a reserved block and the row's number
    in the load: the start of its partition, from one count of the load's rows
    by partition, plus its place there.  The table is never read.  A partition
    that yields more rows than were counted (an input that changes while it is
    read) fails the load instead of repeating keys."""
    if key in df.columns:
        return df
    if "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        df = df.persist(StorageLevel.MEMORY_AND_DISK)  # so that both passes see the same partitions
    counts = sorted((r["p"], r["n"]) for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for p, n in counts:
        starts.append((p, total, n))
        total += n
    blocks = reserve_blocks(spark, name, max(1, -(-total >> BLOCK_BITS)))
    # a row for each partition of the load: small, and the rows are not moved
    where = F.broadcast(spark.createDataFrame(starts, "_parte int, _inicio long, _quantas long"))
    at = F.col("_inicio") + F.col("_lugar")
    block = F.element_at(F.array(*[F.lit(b) for b in blocks]), (F.shiftright(at, BLOCK_BITS) + 1).cast("int")).cast("long")
    value = F.shiftleft(block, BLOCK_BITS) + at.bitwiseAND(F.lit((1 << BLOCK_BITS) - 1))
    placed = df.withColumns({"_da": F.spark_partition_id(), "_lugar": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    joined = placed.join(where, F.col("_da") == F.col("_parte"), "left")
    fine = F.coalesce(F.col("_lugar") < F.col("_quantas"), F.lit(False))
    out = joined.withColumn(key, F.when(fine, value).otherwise(F.raise_error(F.lit("the load's rows changed while they were read")).cast("long")))
    return out.drop("_da", "_lugar", "_parte", "_inicio", "_quantas")


def _append(spark: SparkSession, df: DataFrame, name: str) -> int:
    """Append keyed rows; the count is taken by an ``Observation`` during the
    write itself.

    Rows of a table by ``lote`` that name no lote are a load of their own: they
    are written to that partition's folder, so that loads side by side share no
    temporary folder, and shown when they are whole."""
    schema = spark.table(name).schema
    obs = Observation("inseridas")
    count = F.count(F.lit(1)).alias("n")
    if LOTE in schema.names and LOTE not in df.columns:
        lote = f"carga-{uuid.uuid4().hex}"
        path = f"{_base(spark, name)}/{LOTE}={lote}"
        columns = T.StructType([f for f in schema.fields if f.name != LOTE])
        _align(df, columns).observe(obs, count).write.parquet(path)
        spark.sql(f"ALTER TABLE {name} ADD PARTITION ({LOTE} = '{lote}') LOCATION '{path}'")
    else:
        _align(df, schema).observe(obs, count).write.mode("append").insertInto(name)
    return int(obs.get.get("n", 0) or 0)


def insert_rows(spark: SparkSession, df: DataFrame, name: str = TABLE) -> int:
    """Append rows; returns the number written (0 for an empty frame).

    Several writers may append to a table by ``lote`` at once; other tables take
    one writer at a time, as their loads share a folder."""
    create_table(spark, name)
    return _append(spark, with_row_key(spark, df, name), name)


def replace_lote(spark: SparkSession, df: DataFrame, lote: str, name: str = TABLE) -> None:
    """ST3: overwrite the one partition ``lote`` of a table made ``by_lote``."""
    rows = _align(df.withColumn(LOTE, F.lit(lote)), spark.table(name).schema).drop(LOTE)
    spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION ({LOTE} = '{lote}') SELECT * FROM {{rows}}", rows=rows)


class LoadError(RuntimeError):
    """A load whose written rows are not those that were counted."""


def ingest_once(spark: SparkSession, df: DataFrame, name: str = TABLE, reset: bool = True,
                restamp: bool = False) -> int:
    """Full load.  ``reset=True`` replaces the table's content, ``False``
    appends.  Returns rows written.

    A replacing load is written aside, counted again from what was written, and
    only then shown: a table is switched to the new location in one step; a
    table by ``lote`` gets the new partition and then loses the others.  A load
    that fails or is killed before that leaves the old rows as they were, and one
    killed between the two steps of a table by ``lote`` leaves old and new rows,
    which the next replacing load puts right.  The version before stays for
    readers that are still on it; :func:`drop_versions` removes it."""
    create_table(spark, name)
    if restamp:
        df = _restamp(df)
    df = with_row_key(spark, df, name)
    if not reset:
        return _append(spark, df, name)
    schema = spark.table(name).schema
    obs = Observation("carga")
    rows = _align(df, schema).observe(obs, F.count(F.lit(1)).alias("n"))
    aside = f"{_base(spark, name)}{VERSIONS}/{uuid.uuid4().hex}"
    rows.write.parquet(aside)
    n, written = int(obs.get.get("n", 0) or 0), spark.read.schema(schema).parquet(aside)
    if written.count() != n:
        raise LoadError(f"{name}: {n} rows were written to {aside}, other rows are read")
    if LOTE in schema.names:
        _switch_partitions(spark, name, aside, written)
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{aside}'")
    spark.catalog.refreshTable(name)
    return n


def _switch_partitions(spark: SparkSession, name: str, aside: str, written: DataFrame) -> None:
    """Show the rows of ``aside`` as partitions by ``lote``, then leave out the
    partitions that were there before."""
    old = [r["partition"].split("=", 1)[1] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    lotes = [r[0] for r in written.select(LOTE).distinct().collect()]  # loads, not rows
    for lote in lotes:
        path = f"{aside}-{lote}"
        written.where(F.col(LOTE) == lote).drop(LOTE).write.parquet(path)
        if lote in old:
            spark.sql(f"ALTER TABLE {name} PARTITION ({LOTE} = '{lote}') SET LOCATION '{path}'")
        else:
            spark.sql(f"ALTER TABLE {name} ADD PARTITION ({LOTE} = '{lote}') LOCATION '{path}'")
    gone = ", ".join(f"PARTITION ({LOTE} = '{x}')" for x in old if x not in lotes)
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP {gone}")


def drop_versions(spark: SparkSession, name: str = TABLE) -> int:
    """Remove all versions but the one that the table (or a partition of it)
    shows; returns how many.  No load may be under way."""
    folder = f"{_base(spark, name)}{VERSIONS}"
    fs, path = _path(spark, folder)
    if not fs.exists(path):
        return 0
    shown = {_location(spark, name).rstrip("/").rsplit("/", 1)[1]}
    if LOTE in spark.table(name).columns:
        for r in spark.sql(f"SHOW PARTITIONS {name}").collect():
            lote = r["partition"].split("=", 1)[1]
            at = spark.sql(f"DESCRIBE TABLE EXTENDED {name} PARTITION ({LOTE} = '{lote}')").where("col_name = 'Location'").first()
            shown.add(at["data_type"].rstrip("/").rsplit("/", 1)[1])
    gone = [f.getPath() for f in fs.listStatus(path) if f.getPath().getName() not in shown]
    for p in gone:
        fs.delete(p, True)
    return len(gone)


def read_ordered(df: DataFrame, limit: int | None = None, ts: str = "capturado_em",
                 key: str = KEY) -> DataFrame:
    """Readings by capture time (missing last), key as tie-breaker.

    With a limit Catalyst plans a TakeOrderedAndProject: each partition keeps
    its own top rows, only limit x partitions rows reach the final merge."""
    out = df.orderBy(F.asc_nulls_last(ts), F.asc(key))
    return out.limit(limit) if limit else out


def latest(df: DataFrame, n: int = 50, ts: str = "capturado_em", key: str = KEY) -> DataFrame:
    """The n most recent readings (top-k, no full sort)."""
    if n < 1:
        raise ValueError("n must be >= 1")
    return df.orderBy(F.desc_nulls_last(ts), F.desc(key)).limit(n)


def _fresh(spark: SparkSession, name: str) -> DataFrame:
    """The table with its files listed anew: a stream writes in a session of
    its own."""
    spark.catalog.refreshTable(name)
    return spark.table(name)


def count_rows(spark: SparkSession, name: str = TABLE) -> int:
    """Number of rows, 0 when the table does not exist."""
    if not spark.catalog.tableExists(name):
        return 0
    return _fresh(spark, name).count()


def read_table(spark: SparkSession, name: str = TABLE, limit: int | None = None) -> DataFrame:
    """S09 over the catalog table."""
    return read_ordered(_fresh(spark, name), limit)
