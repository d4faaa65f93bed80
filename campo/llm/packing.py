"""Best-fit packing by few-document length patterns.

Documents become token ids plus an end id; a longer one than a sequence is cut
into full pieces, the first piece taking what is left over.  Patterns of two or
three pieces that fill a sequence exactly are fitted to the histogram of piece
lengths by non-negative least squares; the repeat counts are rounded down, and
the residual histogram is packed best-fit decreasing, all of it on counts by
length (at most one per token of a sequence), never on documents.  Pieces then
find their place by their rank among the pieces of their length.

Null and empty texts are one-token documents (the end id).  Repeated rows are
packed as often as they occur.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.common import running, stage, text_of

CAPACITY = 1024
END_ID = 2
PATTERNS_PER_LENGTH = 4    #: three-piece patterns enumerated for each length
SWEEPS = 60                #: rounds of coordinate descent


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every text."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches):
        from campo.llm.tokens import chunks
        coder = chunks(tokenizer)
        for batch in batches:
            row, piece, start, length, crc = [], [], [], [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                ids = coder.encode(text) + end
                n = len(ids) // 4
                at, stop = 0, n % capacity or capacity
                view = memoryview(ids)
                while at < n:
                    row.append(k)
                    piece.append(len(piece) - first if at else 0)
                    if not at:
                        first = len(piece) - 1
                    start.append(at)
                    length.append(stop - at)
                    crc.append(zlib.crc32(view[4 * at:4 * stop]))
                    at, stop = stop, stop + capacity
            yield pa.record_batch({
                "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())})

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           *[T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32")]])
    return docs.select(docs["doc_id"].alias("doc_id"), text_of(docs).alias("text")).mapInArrow(cut, schema)


def patterns(capacity: int) -> list[tuple[int, ...]]:
    """Pairs, and a few triples for each length, that fill a sequence; each in
    falling order."""
    out = {(capacity - a, a) for a in range(1, capacity // 2 + 1)}
    for a in range(1, capacity - 1):
        rest = capacity - a
        for k in range(1, PATTERNS_PER_LENGTH + 1):
            b = max(1, rest * k // (2 * PATTERNS_PER_LENGTH + 1))
            if rest - b >= 1:
                out.add(tuple(sorted((a, b, rest - b), reverse=True)))
    return sorted(out, reverse=True)


def fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns with their repeat counts: non-negative least squares by
    coordinate descent, rounded down and never above what is there."""
    left = np.zeros(capacity + 1)
    for length, n in histogram.items():
        left[length] = n
    have = [p for p in patterns(capacity) if all(left[x] for x in p)]
    rows = [np.unique(p, return_counts=True) for p in have]
    repeat = [0.0] * len(have)
    flat = [([int(x) for x in of], [int(m) for m in often], float((often ** 2).sum())) for of, often in rows]
    rest = left.tolist()
    for _ in range(SWEEPS):
        moved = 0.0
        for k, (of, often, norm) in enumerate(flat):
            slope = sum(m * rest[x] for x, m in zip(of, often)) / norm
            step = max(slope, -repeat[k])
            if step:
                repeat[k] += step
                moved = max(moved, abs(step))
                for x, m in zip(of, often):
                    rest[x] -= m * step
        if moved < 0.25:
            break
    out, free = [], left.astype(int).tolist()
    for p, r, (of, often, _) in zip(have, repeat, flat):
        n = min([int(r), *(free[x] // m for x, m in zip(of, often))])
        if n > 0:
            out.append((p, n))
            for x, m in zip(of, often):
                free[x] -= m * n
    return out


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit decreasing on counts: fillings with their repeat counts."""
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for length in sorted(histogram, reverse=True):
        n = histogram[length]
        for space in sorted(s for s in open_ if s >= length):
            while n and open_.get(space):
                filling, often = open_[space].pop()
                per = min(space // length, -(-n // often))
                use = min(often, n // per)
                if use < often:
                    open_[space].append((filling, often - use))
                open_.setdefault(space - per * length, []).append((filling + (length,) * per, use))
                n -= use * per
            if not open_.get(space):
                open_.pop(space, None)
            if not n:
                break
        per = capacity // length
        for often, each in ((n // per, per), (1 if n % per else 0, n % per)):
            if often:
                open_.setdefault(capacity - each * length, []).append(((length,) * each, often))
    return [x for space in sorted(open_) for x in open_[space]]


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> dict[str, np.ndarray]:
    """Slots by (length, rank): the ``count`` pieces of a length from rank
    ``first`` on go to sequences ``sequence``, ``sequence`` + 1, ... at
    ``offset``.  At most a few slots for each pattern and length."""
    fitted = fit({x: n for x, n in histogram.items() if x < capacity}, capacity)
    rest = dict(histogram)
    for p, n in fitted:
        for x in p:
            rest[x] -= n
    fillings = fitted + best_fit({x: n for x, n in rest.items() if n}, capacity)
    used: dict[int, int] = {}
    slots, sequence = [], 0
    for filling, n in fillings:
        offset = 0
        for x in filling:
            slots.append((x, used.get(x, 0), n, sequence, offset))
            used[x] = used.get(x, 0) + n
            offset += x
        sequence += n
    slots.sort()
    columns = np.array(slots, np.int64).reshape(-1, 5).T
    return dict(zip(("length", "first", "count", "sequence", "offset"), columns))


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Add sequence_id and offset to pieces (see :func:`pieces`)."""
    cut = stage(cut, "pack-pieces").withColumn("_place", F.xxhash64("doc_id", "piece", "ids_crc32"))
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = cut.sparkSession.sparkContext.broadcast(plan(histogram, capacity))  # bounded by the capacity, not by rows
    ranked = running(cut, ["length"], "_place", ["doc_id", "piece", "ids_crc32"], {"_rank": "1"}, total=sum(histogram.values()))

    def place(batches):
        s = slots.value
        step = 1 << 44  # ranks stay below
        keys = s["length"] * step + s["first"]
        for batch in batches:
            rank, length = batch.column("_rank").to_numpy(), batch.column("length").to_numpy()
            at = np.searchsorted(keys, length * step + rank, "right") - 1
            names = [c for c in batch.schema.names if c not in ("_rank", "_place")]
            yield pa.record_batch({**{c: batch.column(c) for c in names},
                                   "sequence_id": s["sequence"][at] + rank - s["first"][at], "offset": s["offset"][at]})

    schema = T.StructType([*[f for f in cut.schema.fields if f.name != "_place"],
                           T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.mapInArrow(place, schema)


def packed(docs: DataFrame, tokenizer: str) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    return pack(pieces(docs, tokenizer))
