"""Ranked lexical search: exact inner products of sparse vectors over ball trees.

A document is the sparse vector of its terms' impacts, (10^9 tf) div (1000 tf +
12 m), a query that of its terms' weights times their repeats; the score is
their inner product, in 64-bit integers.  Only terms of the queries count in an
inner product, so a document's vector holds just those; document lengths, term
totals and document frequencies come from all terms of all documents.

Tree: its top is fitted on a bounded sample (``SAMPLE`` documents of least
hash), each node cutting between two far documents; every document goes down to
a region.  A region is dealt by a row hash into groups of about ``GROUP``
documents (so a region that holds a third of all rows is many groups), and in
its task a group is cut further the same way, down to leaves of ``LEAF``
documents.  A node has the centroid of its documents and the radius around it,
in coordinates where a term's impact is multiplied by its weight (and the query's
weight divided by it, which leaves the product as it is): of the powers of the
weight tried, 0 to 2, this left out most leaves for the nodes it made.

Search: a subtree's bound is query . centroid + |query| radius, rounded up by
more than floating point can err.  Subtrees are opened best first; at a leaf all
documents are scored in integers; the rest of the tree is left out when its best
bound is below the k-th score found.  The search starts from the k-th score
within the sample, which is a floor for all groups.

Queries are taken in batches of about ``BATCH`` term occurrences, so that what
is broadcast (terms, weights, cutting planes) is bounded whatever their number.

A null text has no terms.  Every item row is a query of its own, also where an
item_id or a text repeats; an item without a matching document has no rows.  Of
documents with one doc_id each row is ranked; null doc_ids come after others at
equal score.  Terms are told apart by a 64-bit hash of their bytes.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.blocks import Block, per_text, slices
from campo.llm.common import least_hashes, stage, text_of

K = 20
BATCH = 1 << 18             #: term occurrences of queries at a time, about
SAMPLE = 2048               #: documents the top of the tree is fitted on
LEAST_REGION = 16           #: of them in a region, at least
GROUP = 8192                #: documents of a group, about
LEAF = 128
SLICE = 1 << 20             #: bytes of text at a time
_SAFE = 1 + 1e-9            #: far above the rounding error of a bound

#: bytes of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]``
TERM_BYTE = np.zeros(256, bool)
TERM_BYTE[0x80:] = True
for _lo, _hi in (("0", "9"), ("A", "Z"), ("a", "z")):
    TERM_BYTE[ord(_lo):ord(_hi) + 1] = True


def terms_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each term (A-Z as a-z), and the number of terms of each text."""
    starts, ends, counts = block.spans(TERM_BYTE)
    return block.hashes(starts, ends, fold=True), counts


# ------------------------------------------------------------------ queries
def query_terms(items: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """item (row), item_id, term, often: the distinct terms of each item."""
    kind = items.schema[id_column].dataType

    def run(batches):
        for batch, block in slices(batches, size=SLICE):
            hashes, counts = terms_of(block)
            of = per_text(counts)
            pairs, often = np.unique(np.stack([of, hashes.view(np.int64)]), axis=1, return_counts=True)
            yield pa.record_batch({"item": batch.column("item").take(pa.array(pairs[0])), "item_id": batch.column("item_id").take(pa.array(pairs[0])),
                                   "term": pa.array(pairs[1], pa.int64()), "often": pa.array(often, pa.int64())})

    schema = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", kind),
                           T.StructField("term", T.LongType()), T.StructField("often", T.LongType())])
    return items.select(F.monotonically_increasing_id().alias("item"), items[id_column].alias("item_id"),
                        text_of(items, text_column).alias("text")).mapInArrow(run, schema)


class Queries:
    """A batch of queries: sorted vocabulary, and a row of ``start`` an item."""

    def __init__(self, rows):
        rows = sorted(rows, key=lambda r: (r["item"], r["term"]))
        term = np.array([r["term"] for r in rows], np.int64).view(np.uint64)
        self.vocabulary = np.unique(term)
        self.term = np.searchsorted(self.vocabulary, term)
        self.often = np.array([r["often"] for r in rows], np.int64)
        item = np.array([r["item"] for r in rows], np.int64)
        self.items, first = np.unique(item, return_index=True)
        self.start = np.append(first, len(rows))

    def __len__(self):
        return len(self.items)

    def of(self, q: int) -> tuple[np.ndarray, np.ndarray]:
        s = slice(self.start[q], self.start[q + 1])
        return self.term[s], self.often[s]


# ------------------------------------------------------------------ documents
COUNTS = "row long, n long, terms binary, often binary"


def counts_of(docs: DataFrame, vocabulary: np.ndarray, doc_column: str, text_column: str) -> DataFrame:
    """Per document: row, doc_id, the number of its terms, and the numbers of
    the vocabulary's terms in it with their occurrences."""
    def run(batches):
        for batch, block in slices(batches, size=SLICE):
            hashes, counts = terms_of(block)
            at = np.searchsorted(vocabulary, hashes)
            at[at == len(vocabulary)] = 0
            known = vocabulary[at] == hashes
            pair, often = np.unique(per_text(counts)[known] * len(vocabulary) + at[known], return_counts=True)
            cut = np.searchsorted(pair, np.arange(block.n + 1) * len(vocabulary)) * 4
            yield pa.record_batch({
                "row": batch.column("row"), "doc_id": batch.column("doc_id"), "n": pa.array(counts, pa.int64()),
                "terms": _cells((pair % len(vocabulary)).astype("<i4"), cut), "often": _cells(often.astype("<i4"), cut)})

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema[doc_column].dataType),
                           T.StructField("n", T.LongType()), T.StructField("terms", T.BinaryType()), T.StructField("often", T.BinaryType())])
    return docs.select(F.monotonically_increasing_id().alias("row"), docs[doc_column].alias("doc_id"),
                       text_of(docs, text_column).alias("text")).mapInArrow(run, schema)


def _cells(flat: np.ndarray, cut: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer(cut.astype(np.int32).tobytes()), pa.py_buffer(flat.tobytes())])


def _flat(column) -> tuple[np.ndarray, np.ndarray]:
    """All values of a binary column of int32 lists, and each row's start."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    flat = np.frombuffer(bytes(memoryview(raw)[offsets[0]:offsets[-1]]) if raw is not None else b"", "<i4")
    return flat, (offsets - offsets[0]) // 4


def document_frequency(counts: DataFrame) -> DataFrame:
    """term, df: summed over Arrow batches before the shuffle."""
    def run(batches):
        for batch in batches:
            flat, _ = _flat(batch.column("terms"))
            term, n = np.unique(flat, return_counts=True)
            yield pa.record_batch({"term": pa.array(term, pa.int32()), "df": pa.array(n, pa.int64())})

    return counts.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df"))


def weights_of(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


def impacts(often: np.ndarray, n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Of a term that is ``often`` in a document of ``n`` terms."""
    often, n = often.astype(np.int64), n.astype(np.int64)
    if len(n) and 25 * int(n.max()) * n_docs >= 1 << 63:  # beyond 64 bits: exact, but slow
        m = np.array([75 + (25 * int(x) * n_docs) // n_terms for x in n], np.int64)
    else:
        m = 75 + (25 * n * n_docs) // n_terms
    return (1_000_000_000 * often) // (1000 * often + 12 * m)


# ------------------------------------------------------------------ trees
class Sparse:
    """Documents as rows of (term, value); coordinates scaled for distances."""

    def __init__(self, term: np.ndarray, impact: np.ndarray, start: np.ndarray, root: np.ndarray):
        self.term, self.impact, self.start, self.n = term, impact, start, len(start) - 1
        self.of = np.repeat(np.arange(self.n), np.diff(start))
        self.value = impact * root[term]
        self.norm2 = np.bincount(self.of, self.value * self.value, self.n)

    def entries(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the entries of ``rows``, and for each its row's index."""
        n = self.start[rows + 1] - self.start[rows]
        of = np.repeat(np.arange(len(rows)), n)
        return np.arange(len(of)) + np.repeat(self.start[rows] - (np.cumsum(n) - n), n), of

    def dense(self, rows: np.ndarray, width: int) -> np.ndarray:
        """Sum of the rows."""
        at, _ = self.entries(rows)
        return np.bincount(self.term[at], self.value[at], width)

    def dot(self, rows: np.ndarray, dense: np.ndarray) -> np.ndarray:
        at, of = self.entries(rows)
        return np.bincount(of, self.value[at] * dense[self.term[at]], len(rows))


def far_cut(docs: Sparse, rows: np.ndarray, width: int) -> tuple[np.ndarray, float] | None:
    """A plane half way between two far documents: the one farthest from the
    centroid and the one farthest from that; None if all are the same."""
    centre = docs.dense(rows, width) / len(rows)
    far = docs.norm2[rows] - 2 * docs.dot(rows, centre)
    a = rows[np.argmax(far)]
    at = docs.dense(np.array([a]), width)
    far = docs.norm2[rows] - 2 * docs.dot(rows, at)
    b = rows[np.argmax(far)]
    plane = docs.dense(np.array([b]), width) - at
    if not plane.any():
        return None
    return plane, float(docs.norm2[b] - docs.norm2[a]) / 2


def fit_top(docs: Sparse, width: int, depth: int) -> list[tuple[np.ndarray, float] | None]:
    nodes: list = [None] * ((1 << depth) - 1)
    parts = {0: np.arange(docs.n)}
    for node in range(len(nodes)):
        rows = parts.pop(node, None)
        if rows is None or len(rows) < 2 or (cut := far_cut(docs, rows, width)) is None:
            continue
        nodes[node] = (cut[0].astype(np.float32), cut[1])
        side = docs.dot(rows, nodes[node][0]) > cut[1]
        parts[2 * node + 1], parts[2 * node + 2] = rows[~side], rows[side]
    return nodes


def region_of(docs: Sparse, nodes: list, depth: int) -> np.ndarray:
    node = np.zeros(docs.n, np.int64)
    for _ in range(depth):
        for n in np.unique(node):
            rows = np.flatnonzero(node == n)
            cut = nodes[n] if n < len(nodes) else None
            node[rows] = 2 * n + 1 + (0 if cut is None else (docs.dot(rows, cut[0]) > cut[1]))
    return node - ((1 << depth) - 1)


class BallTree:
    """Nodes of one group: centroid, radius, children or documents."""

    def __init__(self, docs: Sparse, width: int, leaf: int = LEAF):
        self.docs, self.width = docs, width
        self.centre, self.radius, self.children, self.rows = [], [], [], []
        self._grow(np.arange(docs.n), leaf)
        self.centre = np.array(self.centre)
        self._leaves = {}

    def _grow(self, rows: np.ndarray, leaf: int) -> None:
        todo = [(rows, None)]
        while todo:
            rows, parent = todo.pop()
            me = len(self.radius)
            centre = self.docs.dense(rows, self.width) / len(rows)
            norm2 = float(centre @ centre)
            top = float(self.docs.norm2[rows].max()) + norm2
            square = float((self.docs.norm2[rows] - 2 * self.docs.dot(rows, centre)).max()) + norm2
            self.centre.append(centre)
            self.radius.append(math.sqrt(max(square, 0.0) + 1e-10 * top) * _SAFE)
            self.children.append([])
            self.rows.append(rows)
            if parent is not None:
                self.children[parent].append(me)
            if len(rows) <= leaf or (cut := far_cut(self.docs, rows, self.width)) is None:
                continue
            side = self.docs.dot(rows, cut[0]) > cut[1]
            if side.all() or not side.any():
                continue
            todo += [(rows[side], me), (rows[~side], me)]

    def _leaf(self, node: int):
        """A leaf's entries by term."""
        if node not in self._leaves:
            at, of = self.docs.entries(self.rows[node])
            order = np.argsort(self.docs.term[at], kind="stable")
            self._leaves[node] = self.docs.term[at][order], of[order], self.docs.impact[at][order]
        return self._leaves[node]

    def scores(self, node: int, term: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Exact integer scores of a leaf's documents."""
        terms, of, impact = self._leaf(node)
        low, high = np.searchsorted(terms, term, "left"), np.searchsorted(terms, term, "right")
        n = high - low
        at = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        out = np.zeros(len(self.rows[node]), np.int64)
        each = np.repeat(weight, n) * impact[at]
        if float(weight.sum()) * 1e6 < 2.0 ** 53:
            out[:] = np.bincount(of[at], each, len(out))  # exact in doubles
        else:
            np.add.at(out, of[at], each)
        return out

    def bounds(self, term: np.ndarray, value: np.ndarray) -> np.ndarray:
        """Upper bounds of all nodes for a query in scaled coordinates."""
        return (self.centre[:, term] @ value + math.sqrt(float(value @ value)) * np.array(self.radius)) * _SAFE + 1.0

    def search(self, term: np.ndarray, weight: np.ndarray, value: np.ndarray, floor: int, k: int, tie: np.ndarray):
        """Rows and scores of the best k documents with a score of at least
        ``floor`` (and above 0), and the number of leaves scored.  ``tie``
        orders documents of equal score."""
        bound = self.bounds(term, value)
        heap, rows, scores, leaves = [(-bound[0], 0)], np.empty(0, np.int64), np.empty(0, np.int64), 0
        floor = max(floor, 1)
        while heap and -heap[0][0] >= floor:
            above, node = heapq.heappop(heap)
            if self.children[node]:
                for c in self.children[node]:
                    heapq.heappush(heap, (max(above, -bound[c]), c))
                continue
            leaves += 1
            got = self.scores(node, term, weight)
            good = np.flatnonzero(got >= floor)
            if len(good):
                rows, scores = np.append(rows, self.rows[node][good]), np.append(scores, got[good])
                if len(rows) > k:
                    keep = np.lexsort((tie[rows], -scores))[:k]
                    rows, scores = rows[keep], scores[keep]
                if len(rows) == k:
                    floor = max(floor, int(scores.min()))
        return rows, scores, leaves


def _ids_of(kind: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("q", T.IntegerType()), T.StructField("row", T.LongType()),
                         T.StructField("doc_id", kind), T.StructField("score", T.LongType())])


def _search_batch(docs: DataFrame, queries: Queries, k: int, doc_column: str, text_column: str) -> DataFrame | None:
    """q (number of the query), row, doc_id, score of candidates that hold each
    query's best k."""
    spark = docs.sparkSession
    kind = docs.schema[doc_column].dataType
    width = len(queries.vocabulary)
    vocabulary = spark.sparkContext.broadcast(queries.vocabulary)  # bounded by BATCH
    counts = stage(counts_of(docs, vocabulary.value, doc_column, text_column), "lexical-counts")
    has = F.octet_length("terms") > 0
    n_docs, n_terms, n_held = counts.agg(F.count(F.when(F.col("n") > 0, 1)), F.sum("n"), F.count(F.when(has, 1))).first()
    if not n_held:
        return None
    df = np.zeros(width, np.int64)
    for r in document_frequency(counts).collect():  # a row for each term of the batch
        df[r["term"]] = r["df"]
    weight = weights_of(df, n_docs)
    root = np.maximum(weight, 1).astype(np.float64)
    value = [queries.of(q)[1] * weight[queries.of(q)[0]] / root[queries.of(q)[0]] for q in range(len(queries))]

    def sparse(table) -> Sparse:
        term, start = _flat(table.column("terms"))
        often, _ = _flat(table.column("often"))
        n = np.repeat(table.column("n").to_numpy(), np.diff(start))
        return Sparse(term, impacts(often, n, n_docs, n_terms), start, root)

    held = counts.where(has)
    rows = least_hashes(held, "row", n_held, SAMPLE).select("n", "terms", "often").collect()
    sample = sparse(pa.table({"n": pa.array([r["n"] for r in rows], pa.int64()), "terms": pa.array([bytes(r["terms"]) for r in rows], pa.binary()),
                              "often": pa.array([bytes(r["often"]) for r in rows], pa.binary())}))
    depth = 0
    while (n_held >> (depth + 1)) >= GROUP and (sample.n >> (depth + 1)) >= LEAST_REGION:
        depth += 1
    nodes = fit_top(sample, width, depth)
    floors = np.zeros(len(queries), np.int64)
    tree = BallTree(sample, width)
    for q in range(len(queries)):
        term, often = queries.of(q)
        found = tree.search(term, often * weight[term], value[q], 1, k, np.arange(sample.n))[1]
        floors[q] = found.min() if len(found) == k else 1

    def put(batches):
        for batch in batches:
            region = region_of(sparse(batch), nodes, depth)
            yield pa.record_batch([*batch.columns, pa.array(region, pa.int32())], names=[*batch.schema.names, "region"])

    schema = T.StructType([*held.schema.fields, T.StructField("region", T.IntegerType())])
    placed = held.mapInArrow(put, schema) if depth else held.withColumn("region", F.lit(0))
    placed = stage(placed, "lexical-regions") if depth else placed
    # at most 2^depth regions, and depth is bounded by the sample
    sizes = [(r["region"], -(-r["n"] // GROUP)) for r in placed.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()]
    deal = F.broadcast(spark.createDataFrame(sizes, "of int, deal int"))
    dealt = placed.join(deal, F.col("region") == F.col("of")).withColumn("part", F.pmod(F.xxhash64("row"), F.col("deal")).cast("int"))
    out = _ids_of(kind)
    arrow = [("q", pa.int32()), ("row", pa.int64()), ("score", pa.int64())]

    def visit(key, table):
        docs_ = sparse(table)
        tree = BallTree(docs_, width)
        row = table.column("row").to_numpy()
        tie = np.empty(docs_.n, np.int64)
        ids = pa.table({"doc_id": table.column("doc_id").combine_chunks(), "row": table.column("row").combine_chunks()})
        tie[pa.compute.sort_indices(ids, [("doc_id", "ascending"), ("row", "ascending")], null_placement="at_end").to_numpy()] = np.arange(docs_.n)
        q_, at, score = [], [], []
        for q in range(len(queries)):
            term, often = queries.of(q)
            rows, scores, _ = tree.search(term, often * weight[term], value[q], int(floors[q]), k, tie)
            q_.append(np.full(len(rows), q))
            at.append(rows)
            score.append(scores)
        at = np.concatenate(at)
        columns = {"q": np.concatenate(q_), "row": row[at], "score": np.concatenate(score)}
        found = {c: pa.array(columns[c], t) for c, t in arrow}
        found["doc_id"] = table.column("doc_id").combine_chunks().take(pa.array(at, pa.int64()))
        return pa.table({f.name: found[f.name] for f in out.fields})

    return dealt.select("region", "part", "row", "doc_id", "n", "terms", "often").groupBy("region", "part").applyInArrow(visit, out)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_column: str = "doc_id", text_column: str = "text",
           id_column: str = "item_id", item_text: str = "text") -> DataFrame:
    """The k documents of highest score above 0 for each item row: item (row
    number), item_id, rank, doc_id, score."""
    spark = docs.sparkSession
    asked = stage(query_terms(items, id_column, item_text), "lexical-items")
    total = asked.agg(F.count(F.lit(1))).first()[0]
    batches = -(-total // BATCH)
    found = None
    for b in range(batches):
        mine = asked.where(F.pmod(F.xxhash64("item"), F.lit(batches)) == b)
        queries = Queries(mine.select("item", "term", "often").collect())
        if not len(queries):
            continue
        one = _search_batch(docs, queries, k, doc_column, text_column)
        if one is None:
            continue
        names = spark.createDataFrame([(q, int(i)) for q, i in enumerate(queries.items)], "q int, item long")
        one = one.join(F.broadcast(names), "q").drop("q")  # bounded by BATCH
        one = stage(one, "lexical-found") if batches > 1 else one
        found = one if found is None else found.union(one)
    ids = asked.groupBy("item").agg(F.first("item_id").alias("item_id"))
    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema[doc_column].dataType),
                           T.StructField("score", T.LongType()), T.StructField("item", T.LongType())])
    found = spark.createDataFrame([], schema) if found is None else found.select("row", "doc_id", "score", "item")
    by = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    best = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return best.join(ids, "item").select("item", "item_id", "rank", "doc_id", "score")


_TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = f"""
WITH d AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '{_TERMS}') AS t FROM documents
  WHERE regexp_matches(text, '{_TERMS}')),
s AS MATERIALIZED (SELECT count(*)::BIGINT AS n_docs, sum(len(t))::BIGINT AS l FROM d),
q AS MATERIALIZED (
  SELECT item_id, term, count(*)::BIGINT AS often FROM (
    SELECT item_id, unnest(regexp_extract_all({_LOWER.format('text')}, '{_TERMS}')) AS term FROM benchmark) GROUP BY ALL),
p AS MATERIALIZED (
  SELECT doc_id, term, n, count(*)::BIGINT AS tf FROM (SELECT doc_id, len(t)::BIGINT AS n, unnest(t) AS term FROM d)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL),
w AS MATERIALIZED (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, s GROUP BY term),
r AS (
  SELECT item_id, doc_id, sum(often * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term), s GROUP BY item_id, doc_id)
SELECT item_id, (row_number() OVER o)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0
WINDOW o AS (PARTITION BY item_id ORDER BY score DESC, doc_id)
QUALIFY row_number() OVER o <= {K}
"""
