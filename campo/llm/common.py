"""Small Spark helpers of the training-data operators."""

from __future__ import annotations

import uuid
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from campo.session import scratch_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(docs: DataFrame, column: str = "text") -> Column:
    """The text as a string, empty for null."""
    return F.coalesce(docs[column].cast("string"), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: the work is done
    once, and a lost executor costs no recomputation of what came before."""
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def remainder(docs: DataFrame, modulus: int) -> Column:
    """crc32 of doc_id as text, modulo ``modulus`` (null doc_id: of '')."""
    return F.crc32(F.coalesce(docs["doc_id"].cast("string"), F.lit("")).cast("binary")) % modulus


def running(df: DataFrame, group: list[str], order: str, ties: list[str], values: dict[str, str],
            chunk: int | None = None, total: int | None = None) -> DataFrame:
    """Sums of ``values`` (new column -> summed column, or '1' for a row
    number) over the rows before each row of its group, without one task per
    group.

    ``order`` is a BIGINT column spread over the whole 64-bit range (a hash),
    ``ties`` the columns after it.  Groups are cut at equal steps of ``order``
    into chunks of about ``chunk`` rows (default: a quarter of a shuffle
    partition's share of ``total``), the chunks' totals are summed, and rows
    are then summed within their chunk: a group that holds a third of all rows
    is spread over many tasks."""
    spark = df.sparkSession
    if chunk is None:
        n = df.count() if total is None else total
        chunk = max(1, n // (4 * partitions(spark)))
    names = [f"_g{i}" for i in range(len(group))]
    match = lambda left: reduce(and_, [left[g].eqNullSafe(F.col(k)) for g, k in zip(group, names)])
    renamed = [F.col(g).alias(k) for g, k in zip(group, names)]
    sizes = df.groupBy(*renamed).agg(F.ceil(F.count(F.lit(1)) / chunk).cast("long").alias("_cuts"))
    #: top 31 bits of the order, as a fraction of the range, times the cuts
    cut = df.join(sizes, match(df), "left").select(*[df[c] for c in df.columns], F.shiftright(
        (F.shiftright(df[order], 33) + (1 << 30)) * F.col("_cuts"), 31).alias("_chunk"))
    one = lambda c: F.lit(1) if c == "1" else F.col(c)
    sums = cut.groupBy(*renamed, F.col("_chunk").alias("_of")).agg(
        *[F.sum(one(c)).alias(f"_sum_{k}") for k, c in values.items()])
    over = Window.partitionBy(*names).orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*names, "_of", *[
        F.coalesce(F.sum(f"_sum_{k}").over(over), F.lit(0)).alias(f"_base_{k}") for k in values])
    inside = Window.partitionBy(*group, "_chunk").orderBy(order, *ties).rowsBetween(Window.unboundedPreceding, -1)
    part = cut.select("*", *[F.coalesce(F.sum(one(c)).over(inside), F.lit(0)).alias(f"_in_{k}") for k, c in values.items()])
    return part.join(sums, match(part) & (part["_chunk"] == F.col("_of")), "left").select(
        *[part[c] for c in df.columns],
        *[(F.col(f"_in_{k}") + F.coalesce(F.col(f"_base_{k}"), F.lit(0))).cast("long").alias(k) for k in values])


def least_hashes(df: DataFrame, key: str, total: int, n: int) -> DataFrame:
    """The ``n`` rows of least hash of ``key``, of ``total`` rows.  Rows far
    above the hash that is wanted are left out first, so that what tasks send
    together is about twice the sample, not the sample from each."""
    h = F.xxhash64(key)
    if total > 4 * n:
        df = df.where(h < F.lit(-(1 << 63) + (1 << 64) * 2 * n // total))
    return df.orderBy(h, key).limit(n)


def select_rows(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``decisions`` (doc_id, text_hash, copies)
    name: each (doc_id, text_hash) comes out ``copies`` times in all, however
    often it is in ``docs``, with the columns of ``docs``.

    ``text_hash`` is :func:`text_hash`.  Null doc_ids match each other."""
    pre = "__llm_"
    # plain keys without nulls: the window below then takes the join's partitions
    # as they are, and texts are shuffled once
    key = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))
    named = decisions.where("copies > 0").select(
        key(F.col("doc_id")).alias(pre + "id"), F.col("text_hash").alias(pre + "of"), F.col("copies").cast("int").alias(pre + "copies"))
    joined = docs.withColumns({pre + "key": key(docs["doc_id"]), pre + "hash": text_hash(docs)}).join(
        named, (F.col(pre + "id") == F.col(pre + "key")) & (F.col(pre + "of") == F.col(pre + "hash")), "inner")
    nth = F.row_number().over(Window.partitionBy(pre + "id", pre + "of").orderBy(F.lit(0)))
    return (joined.withColumn(pre + "nth", nth).where(F.col(pre + "nth") == 1)
            .withColumn(pre + "copy", F.explode(F.sequence(F.lit(1), F.col(pre + "copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def text_hash(docs: DataFrame) -> Column:
    return F.xxhash64(text_of(docs))


#: Bits of :func:`key_bitmap`: 8 MB in all, whatever the number of keys.
BITMAP_BITS = 1 << 26


def key_bitmap(keys: DataFrame, key: str) -> DataFrame:
    """A bitmap of BIGINT keys as rows (bucket, bits), 8 MB at most."""
    x = F.pmod(F.col(key), F.lit(BITMAP_BITS)) + 1
    return keys.groupBy(F.bitmap_bucket_number(x).alias("__llm_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(x)).alias("__llm_bits"))


def flagged(df: DataFrame, key: Column, bitmap: DataFrame) -> DataFrame:
    """``df`` with ``__llm_flag``: false where the key is surely not in the
    bitmap.  Rows of text are thus told apart before any shuffle; more keys
    than bits only make the flag less selective."""
    x = F.pmod(key, F.lit(BITMAP_BITS)) + 1
    at = F.bitmap_bit_position(x)
    joined = df.withColumn("__llm_of", F.bitmap_bucket_number(x)).withColumn("__llm_at", at).join(
        F.broadcast(bitmap), F.col("__llm_of") == F.col("__llm_bucket"), "left")  # bounded: BITMAP_BITS
    byte = F.conv(F.hex(F.substring("__llm_bits", (F.col("__llm_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.expr("shiftleft(1, cast(__llm_at % 8 as int))")) != 0, F.lit(False))
    return joined.withColumn("__llm_flag", flag).drop("__llm_of", "__llm_at", "__llm_bucket", "__llm_bits")


def keep_rows(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``found`` (doc_id, text_hash, kept: one row
    a document) keeps, with the columns of ``docs``.  Texts without a dropped
    row are not shuffled."""
    pre = "__llm_"
    counted = found.groupBy(F.col("doc_id").alias(pre + "id"), F.col("text_hash").alias(pre + "of")).agg(
        F.sum(F.col("kept").cast("int")).alias(pre + "copies"), F.count(F.lit(1)).alias(pre + "n"))
    changed = stage(counted.where(F.col(pre + "copies") < F.col(pre + "n")).drop(pre + "n"), "changed-rows")
    marked = flagged(docs.withColumn(pre + "hash", text_hash(docs)), F.col(pre + "hash"), stage(key_bitmap(changed, pre + "of"), "changed-bits"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    maybe = marked.where(F.col(pre + "flag"))
    joined = maybe.join(changed, F.col(pre + "id").eqNullSafe(maybe["doc_id"]) & (F.col(pre + "of") == F.col(pre + "hash")), "left")
    nth = F.row_number().over(Window.partitionBy("doc_id", pre + "hash").orderBy(F.lit(0)))
    left = joined.withColumn(pre + "nth", nth).where(F.col(pre + "copies").isNull() | (F.col(pre + "nth") <= F.col(pre + "copies")))
    return marked.where(~F.col(pre + "flag")).select(*columns).union(left.select(*columns))
