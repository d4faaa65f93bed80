"""Top-k search, vector codes and ranked search against brute force."""

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm import codes, lexical, topk
from tests.llm.conftest import SF_SMALL, table

VECTORS = T.StructType([
    T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType()),
    T.StructField("row", T.StringType()), T.StructField("x", T.LongType()), T.StructField("shard", T.StringType()),
    T.StructField("code", T.LongType()), T.StructField("n", T.StringType()), T.StructField("asked", T.StringType())])


def odd_rows():
    rng = np.random.default_rng(3)
    out = []
    for k in range(60):
        v = [float(x) for x in rng.normal(size=16)]
        out.append((k * 5, v, k % 4 if k % 7 else None))
    out += [(1000, out[3][1], 9), (1000, out[3][1], 9), (1020, out[3][1], None)]  # repeated rows and vectors
    out += [(2000, None, 1), (2020, [float("nan")] * 16, 1), (2040, [0.5] * 15 + [float("inf")], 1), (2060, [0.5, None] * 8, 1)]
    out += [(None, out[5][1], 2), (2080, [0.0] * 16, 2), (2100, [1.0, 2.0], 3), (2120, [], 3)]
    out += [(3000 + k, [0.25] * 16, 5) for k in range(30)]  # a common vector, all ties
    return out


@pytest.fixture(scope="module")
def odd_vectors(spark):
    return spark.createDataFrame([(*r, "r", 1, "s", 2, "n", None) for r in odd_rows()], VECTORS).repartition(3)


def as_ints(rows, scale, width):
    kept = [(i, v, lab) for i, v, lab in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    return [(i, [math.floor(scale * float(np.float32(c))) for c in v] + [0] * (width - len(v)), lab) for i, v, lab in kept]


def table_rows(df):
    return [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]


def brute_topk(rows, every, k, width):
    have = as_ints(rows, 64, width)
    ids = [i for i, _, _ in have]
    x = np.array([v for _, v, _ in have])
    out = []
    for n, i in enumerate(ids):
        if i is None or i % every:
            continue
        score = x @ x[n]
        others = sorted((-int(score[m]), ids[m] is None, ids[m] or 0) for m in range(len(ids)) if m != n)
        out += [(i, rank + 1, None if null else vid, -s) for rank, (s, null, vid) in enumerate(others[:k])]
    return sorted(out, key=repr)


def found_topk(df):
    return sorted(((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()), key=repr)


@pytest.mark.parametrize("shard,block,sample", [(4096, 64, 8192), (16, 4, 64)])
def test_topk_equals_brute_force(spark, odd_vectors, monkeypatch, shard, block, sample):
    monkeypatch.setattr(topk, "SHARD", shard)
    monkeypatch.setattr(topk, "BLOCK", block)
    monkeypatch.setattr(topk, "SAMPLE", sample)
    monkeypatch.setattr(topk, "LEAST_CELL", 4)
    monkeypatch.setattr(topk, "TOGETHER", 2)
    got = topk.search(odd_vectors, odd_vectors["vec_id"] % 20 == 0, k=5)
    assert found_topk(got) == brute_topk(odd_rows(), 20, 5, 16)


def test_topk_whole_table(spark, monkeypatch):
    vectors = table(spark, SF_SMALL, "embeddings")
    monkeypatch.setattr(topk, "SHARD", 64)
    got = topk.search(vectors, vectors["vec_id"] % 20 == 0)
    assert found_topk(got) == brute_topk(table_rows(vectors), 20, 20, 64)


def test_topk_large_components_stay_exact(spark):
    """Scores above 2^24 are no longer exact in float32."""
    rng = np.random.default_rng(0)
    rows = [(k, [float(x) for x in rng.normal(size=4) * 5000], None) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert found_topk(topk.search(df, df["vec_id"] % 20 == 0, k=7)) == brute_topk(rows, 20, 7, 4)


def test_blocks_below_the_kth_score_are_left_out():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.integers(50, 60, (64, 8)), rng.integers(-60, -50, (640, 8))])
    shard = topk.Shard(x, np.arange(len(x)), np.zeros(len(x), bool))
    of, row, score, scored = shard.search(x[:1], np.array([0]), np.array([-np.inf]), 5)
    assert scored < len(shard.x) and set(row) < set(range(1, 64)) and len(of) == 5


def test_empty_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert topk.search(none, none["vec_id"] % 20 == 0).count() == 0
    assert codes.coded(none).count() == 0
    bad = spark.createDataFrame([(1, None, 1), (2, [float("nan")], 1)], "vec_id long, embedding array<float>, label int")
    assert topk.search(bad, bad["vec_id"] % 1 == 0).count() == 0 and codes.coded(bad).count() == 0


# ------------------------------------------------------------------ codes
def brute_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    longest = max(len(v) for _, v, _ in as_ints(rows, scale, 0))
    width = -(-longest // parts) * parts
    have = as_ints(rows, scale, width)
    m = width // parts
    x = np.array([v for _, v, _ in have], np.int64).reshape(len(have), parts, m)
    raw = {n: [float(np.float32(c)) for c in v] for n, (_, v, _) in enumerate(
        [r for r in rows if r[1] is not None and all(c is not None and math.isfinite(c) for c in r[1])])}
    order = sorted(range(len(have)), key=lambda n: (have[n][0] is None, have[n][0] or 0, raw[n]))[:entries]
    book = np.stack([x[order, p] for p in range(parts)])
    for step in range(rounds + 1):
        d = ((x[:, :, None, :] - book[None]) ** 2).sum(axis=3)
        code = d.argmin(axis=2)
        if step == rounds:
            break
        for p in range(parts):
            for e in range(len(order)):
                mine = x[code[:, p] == e, p]
                if len(mine):
                    book[p, e] = mine.sum(axis=0) // len(mine)
    error = np.take_along_axis(d, code[:, :, None], axis=2)[:, :, 0].sum(axis=1)
    by = Counter()
    for n, (_, _, lab) in enumerate(have):
        by[lab] += int(error[n])
    digest = hashlib.sha256(",".join(str(int(c)) for c in book.ravel()).encode()).hexdigest()
    return sorted(((i, bytes(code[n].astype(np.uint8)).hex(), int(error[n]), by[lab], digest)
                   for n, (i, _, lab) in enumerate(have)), key=repr)


def found_codes(df):
    return sorted((tuple(r) for r in df.select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=repr)


def test_codes_equal_brute_force(spark, odd_vectors):
    assert found_codes(codes.coded(odd_vectors)) == brute_codes(odd_rows())


def test_codes_whole_table(spark):
    vectors = table(spark, SF_SMALL, "embeddings")
    assert found_codes(codes.coded(vectors)) == brute_codes(table_rows(vectors))


def test_codes_of_few_rows(spark):
    rows = [(2, [0.5] * 8, None), (1, [0.25] * 8, 3), (1, [0.125] * 8, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    assert found_codes(codes.coded(df)) == brute_codes(rows)
    one = df.limit(1)
    assert found_codes(codes.coded(one)) == brute_codes(table_rows(one))


def test_bounds_stay_right_and_spare_rescans():
    """Entries after each codebook equal a full scan, with fewer rescans; net
    displacement brings a codebook that moves there and back to nothing."""
    rng = np.random.default_rng(2)
    x = rng.integers(-4000, 4000, (4000, 8)).astype(np.int64)
    book = x[:16].copy()
    bounds = codes.Bounds(len(x))
    bounds.rescan(x, np.arange(len(x)), book, 0)
    history, first, rescans = [book], bounds.entry.copy(), []
    for step in (300, -300, 7, 0):
        history.append(history[-1] + step)
        rescans.append(bounds.settle(x, history))
        d = ((x[:, None] - history[-1][None]) ** 2).sum(axis=2)
        assert (bounds.entry == d.argmin(axis=1)).all()
    assert rescans[0] > 0 and rescans[1] < rescans[0] and rescans[-1] < len(x) // 10
    assert (history[2] == history[0]).all() and len(first)


# ------------------------------------------------------------------ ranked search
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return TERM.findall(low)


def brute_ranked(docs, items, k=20):
    bags = [(d, terms(t)) for d, t in docs]
    n_docs, total = sum(1 for _, t in bags if t), sum(len(t) for _, t in bags)
    df = Counter(w for _, t in bags for w in set(t))
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * c + 1))) for w, c in df.items()}
    out = []
    for item, text in items:
        asked = Counter(terms(text))
        scores = []
        for d, t in bags:
            tf = Counter(t)
            m = 75 + (25 * len(t) * n_docs) // total if total else 0
            s = sum(n * weight[w] * ((1_000_000_000 * tf[w]) // (1000 * tf[w] + 12 * m)) for w, n in asked.items() if w in tf)
            if s > 0:
                scores.append((-s, d is None, d or 0))
        out += [(item, r + 1, None if null else d, -s) for r, (s, null, d) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def found_ranked(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


ITEMS = [(1, "the quick brown fox Fox FOX"), (2, None), (3, ""), (4, "日本語 Ünïcode ünïcode"), (5, "word one two two"), (None, "lazy dog0"),
         (6, "nowhere_else zzz"), (5, "word one two two"), (7, "x" * 30000 + " 1")]


@pytest.mark.parametrize("group,leaf,batch", [(8192, 128, 1 << 18), (4, 2, 4)])
def test_ranked_equals_brute_force_on_odd_rows(spark, odd, monkeypatch, group, leaf, batch):
    monkeypatch.setattr(lexical, "GROUP", group)
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "BATCH", batch)
    monkeypatch.setattr(lexical, "LEAST_REGION", 2)
    monkeypatch.setattr(lexical.BallTree.__init__, "__defaults__", (leaf,))
    items = spark.createDataFrame([(*r, 1, "t") for r in ITEMS], "item_id long, text string, item long, term string")
    docs = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    assert found_ranked(lexical.search(odd, items, k=4)) == brute_ranked(docs, ITEMS, 4)


def test_ranked_whole_tables(spark):
    docs, items = table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "benchmark")
    got = found_ranked(lexical.search(docs, items))
    assert got == brute_ranked([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])


def test_ranked_empty_tables(spark, none):
    items = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert lexical.search(none, items).count() == 0
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert lexical.search(docs, items.where("false")).count() == 0
    assert lexical.search(docs, items).count() == brute_len([(1, "a b"), (2, None)], [(1, "a b")])


def brute_len(docs, items):
    return len(brute_ranked(docs, items))


def test_ball_bounds_hold():
    """No document of a node scores above the node's bound."""
    rng = np.random.default_rng(4)
    start = np.concatenate([[0], np.cumsum(rng.integers(1, 12, 300))])
    term = np.concatenate([np.sort(rng.permutation(40)[:b - a]) for a, b in zip(start, start[1:])])
    impact = rng.integers(1, 1_000_000, start[-1])
    weight = rng.integers(0, 9000, 40)
    root = np.sqrt(np.maximum(weight, 1).astype(float))
    tree = lexical.BallTree(lexical.Sparse(term, impact, start, root), 40, leaf=8)
    for _ in range(20):
        asked = np.sort(rng.permutation(40)[:6])
        bound = tree.bounds(asked, weight[asked] / root[asked])
        for node, rows in enumerate(tree.rows):
            exact = [sum(int(weight[t]) * int(i) for t, i in zip(term[start[r]:start[r + 1]], impact[start[r]:start[r + 1]]) if t in asked) for r in rows]
            assert max(exact) <= bound[node]
