"""Exact top-k inner products by block-at-a-time pruning.

Vectors are put in an order in which neighbours are alike: a binary tree of
median cuts, fitted on a bounded sample (``SAMPLE`` rows of least hash), gives
every vector a cell and a place in it.  A cell is dealt into shards of about
``SHARD`` vectors by a row hash, so a vector that fills a third of the table is
spread over as many shards as its rows need.  A shard is an ordered range of
vectors cut into blocks of ``BLOCK``: its forward index (the integer vectors)
and, for each block and component, the largest and the least value.

A query's bound for a block is the sum over its components of the component
times the block's maximum (where the component is positive) or minimum.  Blocks
are taken in falling order of the bound and scored through the forward index,
until the next bound is below the k-th score found.

1. Every query searches its own shard, where its neighbours are.  That gives
   k scores, and the k-th is a floor for all other shards.
2. Queries, a shard's at a time, meet summaries of all shards (maxima and minima
   over the whole shard) and go on only to shards whose bound reaches the floor.
3. There they search again, block by block, from that floor on.
4. The best k of a query's results stay.

Groups of steps 2 and 3 hold one shard, or some summaries, and at most
``TOGETHER`` batches of queries on average.

Rows whose vector is null or holds a null or non-finite component take no part
(neither as query nor as candidate).  Shorter vectors count as filled up with
zeros.  Rows are told apart by row, not by id: of two rows with one id each is a
candidate of the other.  A null id is never a query; as a candidate it comes
after all other ids at equal score.  Scores must stay below 2^48.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from campo.llm.common import least_hashes, stage
from campo.llm.vectors import doubles, integers, usable

K, SCALE = 20, 64
SHARD, BLOCK = 4096, 64
SAMPLE = 8192               #: rows the order is fitted on
LEAST_CELL = 32             #: of them in a cell, at least
TOGETHER = 64               #: batches of queries in a group
WAVE = 1 << 21              #: scores held at once
_IDS = 1 << 14              #: ids of a shard are ranked below this
_NONE = -(1 << 62)          #: no score yet


# ------------------------------------------------------------------ the order
def fit_order(sample: np.ndarray, depth: int) -> list[tuple[np.ndarray, float] | None]:
    """Median cuts along main directions: a node of a heap-shaped tree each,
    None where a node can't be cut."""
    nodes: list = [None] * ((1 << depth) - 1)
    parts = {0: sample}
    for node in range(len(nodes)):
        x = parts.pop(node, None)
        if x is None or len(x) < 2:
            continue
        mean = x.mean(axis=0)
        y = x - mean
        at = y[np.argmax((y * y).sum(axis=1))]
        for _ in range(8):
            at = y.T @ (y @ at)
            norm = np.linalg.norm(at)
            if norm == 0:
                break
            at = at / norm
        along = x @ at
        cut = float(np.median(along))
        nodes[node] = (at, cut)
        parts[2 * node + 1], parts[2 * node + 2] = x[along <= cut], x[along > cut]
    return nodes


def place(x: np.ndarray, nodes: list, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Cell and place inside it of each vector."""
    node = np.zeros(len(x), np.int64)
    along = np.zeros(len(x))
    for _ in range(depth):
        for n in np.unique(node):
            rows = np.flatnonzero(node == n)
            if n >= len(nodes) or nodes[n] is None:
                node[rows] = 2 * n + 1
                continue
            at, cut = nodes[n]
            along[rows] = x[rows] @ at - cut
            node[rows] = 2 * n + 1 + (along[rows] > 0)
    return node - ((1 << depth) - 1), along


# ------------------------------------------------------------------ one shard
class Shard:
    """Blocks of one ordered range of vectors."""

    def __init__(self, x: np.ndarray, ids: np.ndarray, no_id: np.ndarray):
        n, width = x.shape
        blocks = -(-n // BLOCK)
        # sums of products below 2^24 are exact in float32
        self.most = float(np.abs(x).max(initial=0))
        exact = np.float32 if width * self.most ** 2 < 1 << 24 else np.float64
        pad = np.concatenate([x, np.repeat(x[-1:], blocks * BLOCK - n, axis=0)]).astype(exact)
        self.n, self.x = n, pad.reshape(blocks, BLOCK, width)
        self.high, self.low = self.x.max(axis=1), self.x.min(axis=1)
        order = np.lexsort((ids, no_id))  # null ids last
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n)
        self.by_rank = order
        self.tie = np.full(blocks * BLOCK, -1, np.int64)
        self.tie[:n] = _IDS - 1 - rank

    def search(self, q: np.ndarray, own: np.ndarray, floor: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Best k candidates of each query (own: its row in the shard, or -1)
        with a score of at least its floor: query, row, score; and the blocks
        scored."""
        if self.x.dtype == np.float32 and q.shape[1] * float(np.abs(q).max(initial=0)) * self.most >= 1 << 24:
            self.x, self.high, self.low = (a.astype(np.float64) for a in (self.x, self.high, self.low))
        q = q.astype(self.x.dtype)
        bound = (np.maximum(q, 0) @ self.high.T + np.minimum(q, 0) @ self.low.T).astype(np.float64)
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, axis=1)
        best = np.full((len(q), k), _NONE, np.int64)   # score and tie in one number, falling
        kth = floor.astype(np.float64)
        at, step, scored = 0, 1, 0
        blocks, size, _ = self.x.shape
        while at < blocks:
            active = np.flatnonzero(bound[:, at] >= kth)
            if not len(active):
                break
            taken = min(step, blocks - at)
            for rows in np.array_split(active, -(-len(active) * taken * size // WAVE)):
                self._wave(q, own, rows, order[rows, at:at + taken], kth, best, k)
            scored += taken * len(active)
            least = best[active, -1]
            kth[active] = np.maximum(kth[active], np.where(least > _NONE, least // _IDS, -np.inf))
            at, step = at + taken, min(step * 2, 8)
        query, slot = np.nonzero(best > _NONE)
        found = best[query, slot]
        return query, self.by_rank[_IDS - 1 - found % _IDS], found // _IDS, scored

    def _wave(self, q, own, rows, which, kth, best, k) -> None:
        """Score the next blocks (``which``) of some queries, all queries that
        want a block together, and merge what reaches the k-th into ``best``."""
        size = self.x.shape[1]
        query, block = np.repeat(rows, which.shape[1]), which.ravel()
        turn = np.argsort(block, kind="stable")
        query, block = query[turn], block[turn]
        first = np.flatnonzero(np.diff(block, prepend=-1))
        score = np.empty((len(block), size), self.x.dtype)
        for start, stop in zip(first, np.append(first[1:], len(block))):
            np.matmul(q[query[start:stop]], self.x[block[start]].T, out=score[start:stop])
        near = np.flatnonzero(score.max(axis=1) >= kth[query])
        pair, slot = np.nonzero(score[near] >= kth[query[near], None])
        pair = near[pair]
        of, row = query[pair], block[pair] * size + slot
        fine = (self.tie[row] >= 0) & (row != own[of])
        of, key = of[fine], score[pair[fine], slot[fine]].astype(np.int64) * _IDS + self.tie[row[fine]]
        mine = np.unique(of)
        of, key = np.append(of, np.repeat(mine, k)), np.append(key, best[mine].ravel())
        sort = np.lexsort((-key, of))
        of, key = of[sort], key[sort]
        rank = np.arange(len(of)) - np.searchsorted(of, of, "left")
        keep = rank < k
        best[of[keep], rank[keep]] = key[keep]


def _kind(x: np.ndarray):
    most = np.abs(x).max(initial=0)
    return np.dtype("<i2") if most < 1 << 15 else np.dtype("<i4") if most < 1 << 31 else np.dtype("<i8")


def _blob(x: np.ndarray) -> tuple[int, bytes]:
    kind = _kind(x)
    return kind.itemsize, x.astype(kind).tobytes()


def _matrix(size: int, raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, f"<i{size}").reshape(-1, width).astype(np.int64)


INDEX = ("shard int, n int, size int, x binary, ids binary, no_id binary, high binary, low binary, "
         "q_n int, q_size int, q binary, q_rows binary, q_ids binary, q_floor binary, "
         "home array<struct<query_row: long, query_id: long, vec_id: long, score: long>>")
FOUND = "query_row long, query_id long, vec_id long, score long"


def _found(rows, ids, of, near, no_id, who, score) -> dict:
    return {"query_row": pa.array(rows[of], pa.int64()), "query_id": pa.array(ids[of], pa.int64()),
            "vec_id": pa.array(near[who], pa.int64(), mask=no_id[who]), "score": pa.array(score, pa.int64())}


def _build(width: int, scale: int, k: int):
    def build(key, table):
        table = table.sort_by([("along", "ascending"), ("row", "ascending")]).combine_chunks()
        x = integers(table.column("x").combine_chunks(), scale, width)
        if width * float(np.abs(x).max(initial=0)) ** 2 >= 2.0 ** 48:
            raise ValueError("scores of 2^48 and above are not supported")
        no_id = table.column("vec_id").is_null().to_numpy()
        ids = table.column("vec_id").fill_null(0).to_numpy().astype(np.int64)
        rows = table.column("row").to_numpy().astype(np.int64)
        asked = np.flatnonzero(table.column("asked").fill_null(False).to_numpy(zero_copy_only=False))
        shard = Shard(x, ids, no_id)
        q = x[asked]
        of, who, score, _ = shard.search(q, asked, np.full(len(q), -np.inf), k)
        floor = np.full(len(q), _NONE, np.int64)
        full = np.bincount(of, minlength=len(q)) >= k
        least = np.full(len(q), np.iinfo(np.int64).max)
        np.minimum.at(least, of, score)
        floor[full] = least[full]
        size, raw = _blob(x)
        q_size, q_raw = _blob(q)
        home = pa.table(_found(rows[asked], ids[asked], of, ids, no_id, who, score)).to_pylist()
        one = {"shard": int(key[0].as_py()), "n": len(x), "size": size, "x": raw, "ids": ids.tobytes(), "no_id": no_id.tobytes(),
               "high": x.max(axis=0).astype("<i8").tobytes(), "low": x.min(axis=0).astype("<i8").tobytes(),
               "q_n": len(q), "q_size": q_size, "q": q_raw, "q_rows": rows[asked].tobytes(), "q_ids": ids[asked].tobytes(),
               "q_floor": floor.tobytes(), "home": home}
        return pa.table({f: pa.array([one[f]], t) for f, t in _index_types().items()})
    return build


def _index_types() -> dict[str, pa.DataType]:
    found = pa.struct([(c, pa.int64()) for c in ("query_row", "query_id", "vec_id", "score")])
    ints = {c: pa.int32() for c in ("shard", "n", "size", "q_n", "q_size")}
    names = ["shard", "n", "size", "x", "ids", "no_id", "high", "low", "q_n", "q_size", "q", "q_rows", "q_ids", "q_floor", "home"]
    return {c: ints.get(c) or (pa.list_(found) if c == "home" else pa.binary()) for c in names}


BATCH = "shard int, turn int, q_size int, q binary, q_rows binary, q_ids binary, q_floor binary"


def _route(width: int):
    def route(key, summaries, batches):
        """The queries of each batch that must go on to each shard."""
        out: dict[str, list] = {c.split()[0]: [] for c in BATCH.split(", ")}
        shards = summaries.column("shard").to_numpy()
        high, low = (np.frombuffer(b"".join(summaries.column(c).to_pylist()), "<i8").reshape(-1, width).astype(np.float64)
                     for c in ("high", "low"))
        for b in batches.to_pylist():
            q = _matrix(b["q_size"], b["q"], width)
            floor = np.frombuffer(b["q_floor"], np.int64)
            f = q.astype(np.float64)
            reach = np.maximum(f, 0) @ high.T + np.minimum(f, 0) @ low.T >= floor[:, None]
            reach[:, shards == b["home_shard"]] = False
            rows, ids = np.frombuffer(b["q_rows"], np.int64), np.frombuffer(b["q_ids"], np.int64)
            for s in np.flatnonzero(reach.any(axis=0)):
                go = reach[:, s]
                for name, value in (("shard", int(shards[s])), ("turn", b["turn"]), ("q_size", b["q_size"]),
                                    ("q", q[go].astype(f"<i{b['q_size']}").tobytes()), ("q_rows", rows[go].tobytes()),
                                    ("q_ids", ids[go].tobytes()), ("q_floor", floor[go].tobytes())):
                    out[name].append(value)
        kinds = {"shard": pa.int32(), "turn": pa.int32(), "q_size": pa.int32()}
        return pa.table({c: pa.array(v, kinds.get(c, pa.binary())) for c, v in out.items()})
    return route


def _visit(width: int, k: int):
    def visit(key, shards, batches):
        parts = []
        for s in shards.to_pylist():  # one, or none
            ids, no_id = np.frombuffer(s["ids"], np.int64), np.frombuffer(s["no_id"], bool)
            shard = Shard(_matrix(s["size"], s["x"], width), ids, no_id)
            for b in batches.to_pylist():
                q = _matrix(b["q_size"], b["q"], width)
                floor = np.frombuffer(b["q_floor"], np.int64)
                of, who, score, _ = shard.search(q, np.full(len(q), -1), floor, k)
                parts.append(pa.table(_found(np.frombuffer(b["q_rows"], np.int64), np.frombuffer(b["q_ids"], np.int64), of, ids, no_id, who, score)))
        types = {c: pa.int64() for c in ("query_row", "query_id", "vec_id", "score")}
        return pa.concat_tables(parts) if parts else pa.table({c: pa.array([], t) for c, t in types.items()})
    return visit


def search(vectors: DataFrame, asked: Column, k: int = K, column: str = "embedding", id_column: str = "vec_id",
           scale: int = SCALE) -> DataFrame:
    """The k best other rows of every row with ``asked`` true, by integer inner
    product: query_row, query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    base = vectors.where(usable(vectors, column)).select(
        F.monotonically_increasing_id().alias("row"), vectors[id_column].cast("long").alias("vec_id"),
        doubles(vectors, column).alias("x"), (asked & vectors[id_column].isNotNull()).alias("asked"))
    base = stage(base, "topk-vectors")
    n, width = base.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    empty = "query_row long, query_id long, rank int, vec_id long, score long"
    if not n:
        return spark.createDataFrame([], empty)
    width = max(1, width)
    depth = 0
    while (n >> (depth + 1)) >= SHARD and (min(n, SAMPLE) >> (depth + 1)) >= LEAST_CELL:
        depth += 1
    rows = least_hashes(base, "row", n, SAMPLE).select("x").collect() if depth else []
    nodes = fit_order(integers(pa.array([r["x"] for r in rows], pa.list_(pa.float64())), scale, width).astype(np.float64), depth) if depth else []

    def put(batches):
        for batch in batches:
            cell, along = place(integers(batch.column("x"), scale, width).astype(np.float64), nodes, depth)
            yield pa.record_batch([*batch.columns, pa.array(cell, pa.int32()), pa.array(along)], names=[*batch.schema.names, "cell", "along"])

    placed = stage(base.mapInArrow(put, "row long, vec_id long, x array<double>, asked boolean, cell int, along double"), "topk-placed")
    # at most 2^depth cells, and depth is bounded by the sample
    sizes = {r["cell"]: r["n"] for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    first, deal, shards = {}, {}, 0
    for cell in sorted(sizes):
        first[cell], deal[cell] = shards, -(-sizes[cell] // SHARD)
        shards += deal[cell]
    cells = F.broadcast(spark.createDataFrame([(c, first[c], deal[c]) for c in sizes], "cell int, first int, deal int"))
    dealt = placed.join(cells, "cell").withColumn("shard", (F.col("first") + F.pmod(F.xxhash64("row"), F.col("deal"))).cast("int"))
    index = dealt.select("shard", "row", "vec_id", "x", "asked", "along").groupBy("shard").applyInArrow(_build(width, scale, k), INDEX)
    index = stage(index, "topk-index")
    home = index.select(F.inline("home"))
    turns = -(-shards // TOGETHER)
    some = -(-shards // 1024)     # summaries: 1,024 shards a group
    turn = F.explode(F.sequence(F.lit(0), F.lit(turns - 1)))
    summaries = index.select("shard", "high", "low", F.pmod("shard", F.lit(some)).alias("g"), turn.alias("turn"))
    asked_by = index.where("q_n > 0").select(
        F.col("shard").alias("home_shard"), F.pmod(F.xxhash64("shard"), F.lit(turns)).cast("int").alias("turn"),
        "q_size", "q", "q_rows", "q_ids", "q_floor").withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(some - 1))))
    routed = summaries.groupBy("g", "turn").cogroup(asked_by.groupBy("g", "turn")).applyInArrow(_route(width), BATCH)
    routed = stage(routed, "topk-routed")
    targets = index.select("shard", "size", "x", "ids", "no_id", turn.alias("turn"))
    away = targets.groupBy("shard", "turn").cogroup(routed.groupBy("shard", "turn")).applyInArrow(_visit(width, k), FOUND)
    by = Window.partitionBy("query_row").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last())
    return home.union(away).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select(
        "query_row", "query_id", "rank", "vec_id", "score")


SQL = """
WITH v AS MATERIALIZED (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.x, d.x)::BIGINT AS score
      FROM v q JOIN v d ON q.vec_id <> d.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""
