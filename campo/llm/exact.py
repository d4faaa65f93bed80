"""Exact dedup: incoming digests are screened by static binary fuse filters of
immutable snapshots; positives join their exact bucket, where bytes decide;
copies inside the new batch are grouped on their own.

Texts are equal when identical after lower-casing A-Z.  Of equal texts the row
with the largest doc_id stays (null is the least; of rows with the same doc_id
one stays).  Null text counts as empty, and empty texts are equal to each other.

Tables in the shared folder: ``prints`` (one narrow row a document), ``groups``
(one row for each distinct text of a batch) and ``filters`` (one fuse filter
for each bucket of a snapshot's digests).  Buckets are cut by the digest, so
their size does not depend on how often a text is repeated.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm import fuse
from campo.llm.common import flagged, keep_rows, key_bitmap, lower_ascii, partitions, stage, text_hash, text_of

KEYS_PER_FILTER = 100_000  #: digests in a bucket, about


def prints_of(docs: DataFrame, snapshot: Column) -> DataFrame:
    """One row a document: a row key, doc_id, whether it is in the snapshot,
    a 64-bit digest, SHA-256 and length of the normalised text."""
    norm = lower_ascii(text_of(docs))
    return docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"),
                       F.coalesce(snapshot, F.lit(True)).alias("old"), norm.alias("norm"), text_hash(docs).alias("text_hash")).select(
        "row", "doc_id", "old", F.xxhash64("norm").alias("digest"), F.sha2("norm", 256).alias("sha"),
        F.octet_length("norm").cast("long").alias("bytes"), "text_hash")


def grouped(prints: DataFrame) -> DataFrame:
    """Distinct texts of each batch, with the row that stays and the count."""
    return prints.groupBy("old", "digest", "sha", "bytes").agg(
        F.max(F.struct("doc_id", "row")).alias("last"), F.count(F.lit(1)).alias("size"))


def _build_filter(key, table):
    import pyarrow as pa
    seed, length, segments, cells = fuse.build(table.column("digest").to_numpy().view(np.uint64))
    return pa.table({"bucket": pa.array([key[0].as_py()], pa.int64()), "seed": pa.array([seed], pa.int64()),
                     "length": pa.array([length], pa.int64()), "segments": pa.array([segments], pa.int64()),
                     "cells": pa.array([cells], pa.binary())})


FILTER_SCHEMA = "bucket long, seed long, length long, segments long, cells binary"


def _bucketed(groups: DataFrame, buckets: int) -> DataFrame:
    return groups.select(F.pmod(F.shiftright("digest", 7), F.lit(buckets)).alias("bucket"), "digest")


def build_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """A snapshot's fuse filters, one a bucket of digests."""
    return _bucketed(groups, buckets).groupBy("bucket").applyInArrow(_build_filter, FILTER_SCHEMA)


def _screen(key, incoming, filters):
    import pyarrow as pa
    digests = incoming.column("digest").to_numpy().view(np.uint64)
    hit = np.zeros(len(digests), bool)
    for f in filters.to_pylist():
        hit |= fuse.contains(digests, f["seed"], f["length"], f["segments"], f["cells"])
    return pa.table({"digest": pa.array(digests[hit].view(np.int64), pa.int64())})


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Digests of ``groups`` that a filter of their bucket may hold."""
    return _bucketed(groups, buckets).groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(
        _screen, "digest long")


def byte_equal(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of the candidate ``pairs`` (new_id, old_id, digest, sha), those whose
    normalised texts are the same bytes."""
    ids = pairs.select(F.explode(F.array("new_id", "old_id")).alias("id"), "digest", "sha").distinct()
    norm = lower_ascii(text_of(docs))
    ids = stage(ids, "exact-ids")
    bitmap = stage(key_bitmap(ids.select(F.xxhash64("id").alias("k")), "k"), "exact-bits")
    texts = flagged(docs.select(docs["doc_id"].alias("doc_id"), norm.alias("norm")), F.xxhash64("doc_id"), bitmap).where("__llm_flag")
    texts = texts.join(ids, texts["doc_id"].eqNullSafe(ids["id"])).where(
        (F.xxhash64("norm") == F.col("digest")) & (F.sha2("norm", 256) == F.col("sha")))
    # one text a representative, then both sides of a pair by their digest
    sides = texts.groupBy("id", "digest", "sha").agg(F.min("norm").alias("norm"))
    new, old = sides.select("sha", "digest", F.col("id").alias("n_id"), F.col("norm").alias("n_text")), \
        sides.select(F.col("sha").alias("o_sha"), F.col("digest").alias("o_digest"), F.col("id").alias("o_id"), F.col("norm").alias("o_text"))
    met = pairs.select("new_id", "old_id", F.col("digest").alias("d"), F.col("sha").alias("s"))
    met = met.join(new, (met["s"] == new["sha"]) & (met["d"] == new["digest"]) & met["new_id"].eqNullSafe(new["n_id"])).drop("sha", "digest")
    met = met.join(old, (met["s"] == old["o_sha"]) & (met["d"] == old["o_digest"]) & met["old_id"].eqNullSafe(old["o_id"]))
    return met.where(F.col("n_text") == F.col("o_text")).select(F.col("d").alias("digest"), F.col("s").alias("sha")).distinct()


def assign(docs: DataFrame, snapshot: Column) -> DataFrame:
    """Every row with its group: row, doc_id, text_hash, keep_id, group_size,
    kept, text_sha256.  Rows with ``snapshot`` true form the immutable
    snapshot, the others the incoming batch."""
    prints = stage(prints_of(docs, snapshot), "exact-prints")
    groups = stage(grouped(prints), "exact-groups")
    old, new = groups.where("old"), groups.where("not old")
    buckets = max(partitions(docs.sparkSession) * 4, 1 + groups.count() // KEYS_PER_FILTER)
    filters = stage(build_filters(old, buckets), "exact-filters")
    positive = stage(screen(new, filters, buckets), "exact-positives").distinct()
    side = lambda g, name: g.select("digest", "sha", "bytes", F.col("last.doc_id").alias(name))
    bucket = side(new, "new_id").join(positive, "digest", "left_semi")
    pairs = bucket.join(side(old, "old_id"), ["digest", "sha", "bytes"]).select("new_id", "old_id", "digest", "sha")
    equal = stage(byte_equal(docs, stage(pairs, "exact-pairs")), "exact-equal")
    same = groups.join(equal.withColumn("in_old", F.lit(True)), ["digest", "sha"], "left")
    root = Window.partitionBy("digest", "sha", "bytes", F.col("old") | F.coalesce("in_old", F.lit(False)))
    classes = same.select("old", "digest", "sha", "bytes", F.max("last").over(root).alias("keep"),
                          F.sum("size").over(root).alias("group_size"))
    classes = stage(classes.where("group_size > 1").select(
        F.col("old").alias("c_old"), F.col("digest").alias("c_digest"), F.col("sha").alias("c_sha"), "keep", "group_size"), "exact-classes")
    rows = prints.join(classes, (F.col("digest") == F.col("c_digest")) & (F.col("sha") == F.col("c_sha"))
                       & (F.col("old") == F.col("c_old")), "left")
    return rows.select(
        "row", "doc_id", "text_hash", F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("keep.row") == F.col("row"), F.lit(True)).alias("kept"), F.col("sha").alias("text_sha256"))


def older_half(docs: DataFrame) -> Column:
    """Snapshot rows of one table: integer doc_ids up to the middle of their
    range, about half of the doc_ids of any other type, by hash.  Rows without
    a doc_id are in the snapshot."""
    if not isinstance(docs.schema["doc_id"].dataType, T.IntegralType):
        return F.xxhash64(docs["doc_id"]) >= 0
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return docs["doc_id"] <= F.lit(0 if low is None else (low + high) // 2)


def dedup(docs: DataFrame, snapshot: Column | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    found = assign(docs, older_half(docs) if snapshot is None else snapshot)
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    return keep_rows(docs, assign(docs, older_half(docs)))
