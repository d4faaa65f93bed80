"""Token-id files: frequency-ranked ids in a byte-aligned variable-length code
with separate control bytes, decoded by numpy table lookup.

A shard holds documents of one range of doc_id in ascending order, cut into
blocks.  A block has its own dictionary (its ids by falling frequency); an id
is written as its place there, little-endian in one to four bytes, and its
length minus one in two bits of a control byte that serves four ids.  Control
bytes and data bytes lie apart, so both are decoded with array look-ups.
Shards are Parquet rows, one a block, with the document index beside the bytes:
Spark's committer makes them safe against lost tasks.

Null text counts as empty (the end id alone).  Rows with the same doc_id keep
the order of their texts; null doc_ids come first.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.common import partitions, text_of

BLOCK_IDS = 1 << 20   #: a block is closed once it holds so many ids
_WIDTHS = np.array([[1 + (c >> 2 * k & 3) for k in range(4)] for c in range(256)], np.int64)
_BEGINS = np.concatenate([np.zeros((256, 1), np.int64), np.cumsum(_WIDTHS, axis=1)[:, :3]], axis=1)
_TOTALS = _WIDTHS.sum(axis=1)


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned 32-bit values."""
    values = values.astype("<u4")
    width = 1 + (values > 0xFF).view(np.uint8) + (values > 0xFFFF).view(np.uint8) + (values > 0xFFFFFF).view(np.uint8)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    codes[:len(values)] = width - 1
    codes = codes.reshape(-1, 4)
    control = codes[:, 0] | codes[:, 1] << 2 | codes[:, 2] << 4 | codes[:, 3] << 6
    raw, begins = values.view(np.uint8).reshape(-1, 4), np.cumsum(width, dtype=np.int64) - width
    data = np.empty(int(width.sum(dtype=np.int64)), np.uint8)
    data[begins] = raw[:, 0]
    for k in (1, 2, 3):
        wide = np.flatnonzero(width > k)
        if len(wide):
            data[begins[wide] + k] = raw[wide, k]
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of :func:`encode_values`."""
    code = np.frombuffer(control, np.uint8)
    total = _TOTALS[code]
    first = np.cumsum(total) - total
    at = (first[:, None] + _BEGINS[code]).ravel()[:n]
    width = _WIDTHS[code].ravel()[:n]
    raw = np.frombuffer(data + b"\0\0\0\0", np.uint8)
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        wide = np.flatnonzero(width > k)
        if len(wide):
            out[wide] |= raw[at[wide] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encode_block(ids: np.ndarray) -> bytes:
    """Dictionary, control bytes and data bytes of a block of ids."""
    numbers, at = None, ids
    if len(ids) and int(ids.max()) > 4 * len(ids) + 0xFFFF:  # a table of all numbers would outgrow the block
        numbers, at = np.unique(ids, return_inverse=True)
    counts = np.bincount(at)
    kinds = np.flatnonzero(counts)
    kinds = kinds[np.lexsort((kinds, -counts[kinds]))]
    rank = np.zeros(len(counts), np.uint32)
    rank[kinds] = np.arange(len(kinds))
    control, data = encode_values(rank[at])
    kinds = kinds if numbers is None else numbers[kinds]
    return struct.pack("<III", len(kinds), len(ids), len(control)) + kinds.astype("<u4").tobytes() + control + data


def decode_block(block: bytes) -> np.ndarray:
    kinds, n, size = struct.unpack_from("<III", block)
    at = 12 + 4 * kinds
    return np.frombuffer(block, "<u4", kinds, 12)[decode_values(block[at:at + size], block[at + size:], n)]


def _file_schema(docs: DataFrame) -> T.StructType:
    return T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("block", T.IntegerType()), T.StructField("before", T.LongType()),
        T.StructField("n_ids", T.LongType()), T.StructField("doc_ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("bytes", T.BinaryType())])


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Write the ids of every whole text, each followed by ``end_id``."""
    end = np.array([end_id], "<u2").tobytes()

    def encode(batches):
        from pyspark import TaskContext

        from campo.llm.tokens import chunks
        coder = chunks(tokenizer, "H", spaced=False, fold=True)
        shard, block, before = TaskContext.get().partitionId(), 0, 0
        held, ids_of, counts, size = [], [], [], 0

        def close():
            ids, number = np.concatenate(held), np.concatenate(counts)
            return pa.record_batch({
                "shard": pa.array([shard], pa.int32()), "block": pa.array([block], pa.int32()), "before": pa.array([before], pa.int64()),
                "n_ids": pa.array([len(ids)], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(number)], pa.int32()), pa.concat_arrays(ids_of)),
                "counts": pa.ListArray.from_arrays(pa.array([0, len(number)], pa.int32()), pa.array(number, pa.int64())),
                "bytes": pa.array([encode_block(ids)], pa.binary())})

        for batch in batches:
            for row, ids, number in coder.batches(batch.column("text"), end):
                ends, first = np.cumsum(number), 0
                while first < len(number):
                    begin = int(ends[first - 1]) if first else 0
                    stop = min(int(np.searchsorted(ends, begin + BLOCK_IDS - size)) + 1, len(number))
                    held.append(ids[begin:ends[stop - 1]])
                    counts.append(number[first:stop])
                    ids_of.append(batch.column("doc_id").slice(row + first, stop - first))
                    size += len(held[-1])
                    if size >= BLOCK_IDS:
                        yield close()
                        block, before = block + 1, before + size
                        held, ids_of, counts, size = [], [], [], 0
                    first = stop
        if counts:
            yield close()

    ordered = docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text")).repartitionByRange(
        partitions(docs.sparkSession), "doc_id").sortWithinPartitions("doc_id", "text")
    ordered.mapInArrow(encode, _file_schema(docs)).write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """Documents of the files: doc_id, start (ids of all documents before),
    n_tokens, and ids (little-endian unsigned 32-bit) or, with ``digest``,
    ids_crc32."""
    files = spark.read.parquet(path)
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    over = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select(F.col("shard").alias("of"), F.coalesce(F.sum("n").over(over), F.lit(0)).alias("base"))
    files = files.join(F.broadcast(bases), F.col("shard") == F.col("of"))  # one row a shard, of shuffle partitions

    def decode(batches):
        for batch in batches:
            for r in range(batch.num_rows):
                ids = decode_block(batch.column("bytes")[r].as_py())
                counts = np.array(batch.column("counts")[r].as_py(), np.int64)
                ends = np.cumsum(counts)
                starts, raw = ends - counts, memoryview(ids.astype("<u4").tobytes())
                parts = [raw[4 * a:4 * b] for a, b in zip(starts, ends)]
                base = batch.column("base")[r].as_py() + batch.column("before")[r].as_py()
                last = pa.array([zlib.crc32(p) for p in parts], pa.int64()) if digest else pa.array([bytes(p) for p in parts], pa.binary())
                yield pa.record_batch([batch.column("doc_ids")[r].values, pa.array(starts + base), pa.array(counts), last],
                                      names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])

    schema = T.StructType([
        T.StructField("doc_id", files.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_crc32", T.LongType()) if digest else T.StructField("ids", T.BinaryType())])
    return files.select("base", "before", "doc_ids", "counts", "bytes").mapInArrow(decode, schema)
