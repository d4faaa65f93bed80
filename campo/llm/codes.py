"""Vector code compression: each vector is cut into equal consecutive parts,
each part becomes the number of its nearest codebook entry, and codebooks are
refined for a fixed number of rounds, all in integers.

Norm-of-sum bounds spare most distance computations.  A part keeps an upper
bound on the distance to its entry and a lower bound on the distance to every
other entry, each with the round it was made in.  All codebooks so far are kept
(rounds x parts x entries, a fixed number), so a bound of round t is widened in
round T by the true net displacement of an entry between the two codebooks,
never by the sum of the steps in between.  Where the widened bounds do not
settle a part, its upper bound is made exact; where that is not enough, all
entries are rescanned.  Bounds are rounded outwards and compared strictly, so a
tie is always rescanned and goes to the lower entry.

The driver sees one codebook a round.  Rows, bounds and sums of a round are
one table in the shared folder; sums are taken per Arrow batch before they are
shuffled.

Rows whose vector is null or holds a null or non-finite component take no
part.  Null ids come after all others when the first codebook is taken; of rows
with one id the lesser vector comes first.  A vector is filled up with zeros to
the longest vector's length, and that to a multiple of the parts.  An empty
table gives no rows.  With fewer rows than entries, codebooks have an entry a
row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.common import partitions, stage
from campo.llm.vectors import doubles, integers, packed, unpacked, usable

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
_WIDER, _NARROWER = 1 + 1e-12, 1 - 1e-12   #: outward rounding of float64 bounds


class Bounds:
    """Bounds of one part position over a batch: entry, upper and lower bound
    and the rounds they were made in."""

    def __init__(self, n: int):
        self.entry = np.zeros(n, np.uint8)
        self.upper_at, self.lower_at = np.zeros(n, np.uint8), np.zeros(n, np.uint8)
        self.upper, self.lower = np.zeros(n, np.float32), np.zeros(n, np.float32)

    def rescan(self, x: np.ndarray, rows: np.ndarray, entries: np.ndarray, now: int) -> None:
        d = ((x[rows][:, None, :] - entries[None]) ** 2).sum(axis=2)
        nearest = d.argmin(axis=1)
        at = np.arange(len(rows))
        first = d[at, nearest]
        if d.shape[1] > 1:
            d[at, nearest] = np.iinfo(np.int64).max
            other = np.sqrt(d.min(axis=1).astype(np.float64)) * _NARROWER
        else:
            other = np.full(len(rows), np.inf)
        self.entry[rows] = nearest
        self.upper[rows] = np.nextafter((np.sqrt(first.astype(np.float64)) * _WIDER).astype(np.float32), np.float32(np.inf))
        self.lower[rows] = np.nextafter(other.astype(np.float32), np.float32(-np.inf))
        self.upper_at[rows] = self.lower_at[rows] = now

    def settle(self, x: np.ndarray, history: list[np.ndarray]) -> int:
        """Move to the newest codebook; the number of parts rescanned."""
        now, entries = len(history) - 1, history[-1]
        moved = np.stack([np.sqrt(((entries - old) ** 2).sum(axis=1).astype(np.float64)) * _WIDER for old in history])
        rest = np.stack([np.delete(moved, k, axis=1).max(axis=1, initial=0.0) for k in range(len(entries))], axis=1)
        lower = (self.lower.astype(np.float64) - rest[self.lower_at, self.entry]) * _NARROWER
        upper = (self.upper.astype(np.float64) + moved[self.upper_at, self.entry]) * _WIDER
        rows = np.flatnonzero(~(upper < lower))
        exact = np.sqrt(((x[rows] - entries[self.entry[rows]]) ** 2).sum(axis=1).astype(np.float64)) * _WIDER
        self.upper[rows] = np.nextafter(exact.astype(np.float32), np.float32(np.inf))
        self.upper_at[rows] = now
        rows = rows[~(self.upper[rows].astype(np.float64) < lower[rows])]
        if len(rows):
            self.rescan(x, rows, entries, now)
        return len(rows)


def _state(bounds: list[Bounds]) -> np.ndarray:
    """The bounds of all positions, a row of bytes for each vector."""
    cells = [np.stack([getattr(b, name) for b in bounds], axis=1) for name in ("entry", "upper_at", "lower_at", "upper", "lower")]
    return np.concatenate([np.ascontiguousarray(c).view(np.uint8).reshape(len(c), -1) for c in cells], axis=1)


def _from_state(rows: np.ndarray, parts: int) -> list[Bounds]:
    small = [rows[:, k * parts:(k + 1) * parts] for k in range(3)]
    wide = np.ascontiguousarray(rows[:, 3 * parts:]).view(np.float32).reshape(len(rows), 2 * parts)
    out = []
    for p in range(parts):
        b = Bounds(0)
        b.entry, b.upper_at, b.lower_at = (np.array(s[:, p]) for s in small)
        b.upper, b.lower = np.array(wide[:, p]), np.array(wide[:, parts + p])
        out.append(b)
    return out


def _settled(x: np.ndarray, state: np.ndarray | None, history: np.ndarray, parts: int) -> list[Bounds]:
    """Bounds of a batch (n, parts, m) under the newest codebook."""
    bounds = [Bounds(len(x)) for _ in range(parts)] if state is None else _from_state(state, parts)
    for p, b in enumerate(bounds):
        if state is None:
            b.rescan(x[:, p], np.arange(len(x)), history[-1][p], len(history) - 1)
        else:
            b.settle(x[:, p], [h[p] for h in history])
    return bounds


def _refined(rows: DataFrame, history: list[np.ndarray], width: int, parts: int, scale: int, first: bool) -> DataFrame:
    """One round: rows with their bounds, and the sums of each entry's parts
    over the batch on the batch's first row."""
    label = rows.schema["label"]
    n_entries, m = history[0].shape[1:]

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            if first:
                flat = integers(batch.column("x"), scale, width)
                if m * (2.0 * np.abs(flat).max(initial=0)) ** 2 >= 2.0 ** 62 or np.abs(flat).max(initial=0) >= 2 ** 31:
                    raise ValueError("vector components are too large for exact squared distances")
                state = None
            else:
                flat = unpacked(batch.column("v"), "<i4", width).astype(np.int64)
                state = unpacked(batch.column("state"), np.uint8, 11 * parts)
            x = flat.reshape(len(flat), parts, m)
            bounds = _settled(x, state, history, parts)
            sums = np.zeros((parts, n_entries, m + 1), np.int64)
            for p, b in enumerate(bounds):
                sums[p, :, 0] = np.bincount(b.entry, minlength=n_entries)
                np.add.at(sums[p, :, 1:], b.entry, x[:, p])
            once = pa.array([sums.ravel()] + [None] * (len(x) - 1), pa.list_(pa.int64()))
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "label": batch.column("label"),
                                   "v": packed(flat.astype("<i4")), "state": packed(_state(bounds)), "sums": once})

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", label.dataType),
                           T.StructField("v", T.BinaryType()), T.StructField("state", T.BinaryType()),
                           T.StructField("sums", T.ArrayType(T.LongType()))])
    return rows.mapInArrow(run, schema)


def _assigned(rows: DataFrame, history: list[np.ndarray], width: int, parts: int) -> DataFrame:
    """vec_id, label, code and exact error under the newest codebook."""
    m = history[0].shape[2]

    def run(batches):
        for batch in batches:
            x = unpacked(batch.column("v"), "<i4", width).astype(np.int64).reshape(batch.num_rows, parts, m)
            bounds = _settled(x, unpacked(batch.column("state"), np.uint8, 11 * parts), history, parts)
            error = sum(((x[:, p] - history[-1][p][b.entry]) ** 2).sum(axis=1) for p, b in enumerate(bounds))
            code = np.stack([b.entry for b in bounds], axis=1)
            yield pa.record_batch({"vec_id": batch.column("vec_id"), "label": batch.column("label"),
                                   "code": pa.array([r.tobytes().hex() for r in code], pa.string()),
                                   "error": pa.array(error, pa.int64())})

    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("label", rows.schema["label"].dataType),
                           T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    return rows.mapInArrow(run, schema)


def _next_codebook(codebook: np.ndarray, table: DataFrame) -> np.ndarray:
    """Every used entry becomes the floor of the mean of its parts."""
    cells = table.where("sums is not null").select(F.posexplode("sums")).groupBy("pos").agg(F.sum("col").alias("s")).collect()
    flat = np.zeros(codebook.shape[0] * codebook.shape[1] * (codebook.shape[2] + 1), np.int64)
    for r in cells:  # parts x entries x (1 + components), whatever the rows
        flat[r["pos"]] = r["s"]
    sums = flat.reshape(*codebook.shape[:2], -1)
    used = sums[..., 0] > 0
    out = codebook.copy()
    out[used] = sums[..., 1:][used] // sums[..., :1][used]
    return out


def _with_label_error(coded: DataFrame) -> DataFrame:
    """Add the error summed over each label.  Labels with more than a task's
    share of the rows are few (four a shuffle partition at most) and are
    broadcast, so no task gets all rows of a common label."""
    by = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n"))
    by = stage(by, "code-labels")
    total = by.agg(F.sum("n")).first()[0] or 0
    share = F.col("n") * (4 * partitions(coded.sparkSession))
    hot, cold = by.where(share > total), by.where(share <= total)
    same = F.col("label").eqNullSafe(F.col("of"))
    rest = coded.join(F.broadcast(hot.select("of")), same, "left_anti").join(cold, same)
    return coded.join(F.broadcast(hot), same).union(rest).drop("of", "n")


def codebooks_text(codebook: np.ndarray) -> str:
    return ",".join(str(int(x)) for x in codebook.ravel())


def compress(vectors: DataFrame, column: str = "embedding", id_column: str = "vec_id", label_column: str = "label",
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE):
    """The codes of all usable vectors and the codebook they refer to.

    Returns (rows, codebook): vec_id, label, code, error; parts x entries x
    components (None for a table without usable vectors)."""
    base = vectors.where(usable(vectors, column)).select(
        vectors[id_column].cast("long").alias("vec_id"), vectors[label_column].alias("label"), doubles(vectors, column).alias("x"))
    longest = base.agg(F.max(F.size("x"))).first()[0]
    if longest is None:
        return None, None
    width = max(1, -(-longest // parts)) * parts
    start = base.orderBy(F.col("vec_id").asc_nulls_last(), "x").limit(entries).select("x").collect()
    flat = integers(pa.array([r["x"] for r in start], pa.list_(pa.float64())), scale, width)
    history = [np.ascontiguousarray(flat.reshape(len(flat), parts, -1).transpose(1, 0, 2))]
    table = base
    for _ in range(rounds):
        table = stage(_refined(table, history, width, parts, scale, first=table is base), "code-round")
        history.append(_next_codebook(history[-1], table))
    return stage(_assigned(table, history, width, parts), "code-final"), history[-1]


OUTPUT = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def coded(vectors: DataFrame) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error,
    codebooks_sha256."""
    rows, codebook = compress(vectors)
    if rows is None:
        return vectors.sparkSession.createDataFrame([], OUTPUT)
    digest = hashlib.sha256(codebooks_text(codebook).encode()).hexdigest()
    return _with_label_error(rows).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """DuckDB SQL, the rounds written one after the other."""
    square = "list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    out = [f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (
  SELECT vec_id, label, p, v[p * (len(v) // {parts}) + 1:(p + 1) * (len(v) // {parts})] AS x FROM kept, range({parts}) AS r(p)),
c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c FROM parts
  WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries}))"""]
    for r in range(rounds + 1):
        out.append(f"""a{r} AS MATERIALIZED (
  SELECT vec_id, label, p, any_value(x) AS x, min({square} * {entries} + k) AS best FROM parts JOIN c{r} USING (p) GROUP BY vec_id, label, p)""")
        if r < rounds:
            out.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT p, k, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (
    SELECT p, k, list(floor(s / n)::BIGINT ORDER BY i) AS c FROM (
      SELECT p, best % {entries} AS k, i, sum(x[i])::DOUBLE AS s, count(*) AS n FROM a{r}, range(1, 4096) AS t(i) WHERE i <= len(x) GROUP BY ALL)
    GROUP BY p, k) m USING (p, k))""")
    return ",\n".join(out) + f""",
coded AS (SELECT vec_id, label, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code, sum(best // {entries})::BIGINT AS error
          FROM a{rounds} GROUP BY vec_id, label),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c{rounds})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded, books"""


SQL = _sql()
