"""Exact dedup and near-dedup against brute force."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campo.llm import blocks, exact, fuse, near
from tests.llm.conftest import SF_SMALL, prose, table

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def collected(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def brute_exact(rows):
    groups = defaultdict(list)
    for i, text in rows:
        groups[(text or "").translate(FOLD)].append(i)
    out = []
    for norm, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i))
        seen = False
        for i in ids:
            kept = i == keep and not seen
            seen |= kept
            out.append((i, keep, len(ids), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


def brute_bag(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))
    if len(words) < 5:
        return Counter([tuple(words)]) if words else Counter()
    return Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))


def brute_classes(rows):
    bags = [brute_bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                both, all_ = sum((bags[i] & bags[j]).values()), sum((bags[i] | bags[j]).values())
                if both >= 0.8 * all_ - 1e-9:
                    parent[root(i)] = root(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        r = root(k)
        least[r] = min(least.get(r, (True, float("inf"))), (i is not None, i if i is not None else -1))
    sizes = Counter(root(k) for k in range(len(rows)))
    value = lambda k: least[root(k)][1] if least[root(k)][0] else None
    return sorted(((i, value(k), sizes[root(k)]) for k, (i, _) in enumerate(rows)), key=repr)


@pytest.mark.parametrize("cut", [-1, 6, 100])
def test_exact_on_odd_rows(odd, cut):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = exact.dedup(odd, F.col("doc_id") <= cut)
    assert collected(got, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(rows)


def test_exact_survivors_keep_columns_and_one_row_a_text(odd):
    left = exact.survivors(odd)
    assert left.columns == odd.columns
    texts = [(r["text"] or "").translate(FOLD) for r in left.collect()]
    assert len(texts) == len(set(texts)) == len({(r["text"] or "").translate(FOLD) for r in odd.collect()})


def test_empty_tables(none):
    assert exact.dedup(none).collect() == []
    assert exact.survivors(none).collect() == []
    assert near.near_dedup(none).collect() == []
    assert near.survivors(none).collect() == []


def test_a_digest_collision_is_settled_by_bytes(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "A"), (3, "b")], "doc_id long, text string")
    digest, sha = F.xxhash64(F.lit("a")), F.sha2(F.lit("a"), 256)
    pairs = spark.createDataFrame([(2, 1), (3, 1)], "new_id long, old_id long").select("*", digest.alias("digest"), sha.alias("sha"))
    assert exact.byte_equal(docs, pairs.where("new_id = 2")).count() == 1
    assert exact.byte_equal(docs, pairs.where("new_id = 3")).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.lists(st.integers(0, 2 ** 64 - 1), max_size=300))
def test_fuse_filter_has_no_false_negatives(keys):
    keys = np.array(keys, np.uint64)
    assert fuse.contains(np.unique(keys), *fuse.build(keys)).all()


def test_fuse_filter_rate_and_size():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2 ** 63, 20_000, dtype=np.uint64)
    made = fuse.build(keys)
    assert fuse.contains(rng.integers(0, 2 ** 63, 100_000, dtype=np.uint64), *made).mean() < 0.006
    assert len(made[3]) < 1.4 * len(keys)


def test_near_on_odd_rows(odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = near.near_dedup(odd)
    assert collected(got, "doc_id", "class_id", "class_size") == brute_classes(rows)
    kept = got.where("kept")
    assert kept.count() == len({(c, i if n == 1 else None, n) for i, c, n in brute_classes(rows)})
    assert near.survivors(odd).columns == odd.columns


def test_near_chain_and_large_group(spark):
    """A chain whose ends are far apart, and a group of near copies of one
    text next to texts that share half of it."""
    base = prose(120).split()
    rows = []
    for k in range(12):
        rows.append((k, " ".join(base[:100 + k] + [f"t{j}" for j in range(k)])))
    for k in range(40):
        words = [f"w{j}" for j in range(150)]
        words[3 * k + 5] = f"changed{k}"
        rows.append((100 + k, " ".join(words)))
    for k in range(25):
        rows.append((200 + k, " ".join([f"s{j}" for j in range(60)] + [f"own{k}_{j}" for j in range(60)])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert collected(near.near_dedup(docs), "doc_id", "class_id", "class_size") == brute_classes(rows)


def test_near_on_documents(spark):
    docs = table(spark, SF_SMALL, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert collected(near.near_dedup(docs), "doc_id", "class_id", "class_size") == brute_classes(rows)


@settings(max_examples=8, deadline=None)
@given(st.integers(0, 10 ** 6))
def test_signature_estimates_weighted_jaccard(seed):
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 40, 200)
    b = np.where(rng.random(200) < 0.2, rng.integers(0, 40, 200), a)
    block = blocks.text_block(pa.array([" ".join(f"w{x}" for x in v) for v in (a, b)]))
    s, e, n = block.words()
    text, gram = blocks.per_text(n), block.hashes(s, e)
    kinds, often = np.unique(np.stack([text.astype(np.uint64), gram]), axis=1, return_counts=True)
    signs = near.signatures(kinds[0].astype(np.int64), kinds[1], often, 2, 3000)
    ca, cb = Counter(a.tolist()), Counter(b.tolist())
    true = sum((ca & cb).values()) / sum((ca | cb).values())
    assert abs((signs[0] == signs[1]).mean() - true) < 0.05


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="aB \n\té<", max_size=30), max_size=6))
def test_blocks_find_words(texts):
    block = blocks.text_block(pa.array(texts, pa.string()))
    starts, ends, words = block.words()
    expect = [re.findall(r"[^\x20\x09-\x0D]+", t) for t in texts]
    raw = block.data.tobytes()
    assert [raw[a:b].decode() for a, b in zip(starts, ends)] == [w for x in expect for w in x]
    assert words.tolist() == [len(x) for x in expect]
    assert block.hashes(starts, ends, True).tolist() == [blocks.hash_text(w, True) for x in expect for w in x]


@pytest.mark.parametrize("kind", ["string", "double", "timestamp_ntz", "int"])
def test_exact_dedup_screens_ids_of_any_type(spark, kind):
    """Both halves have rows, copies across them are met, and nothing else changes."""
    texts = [f"text {k % 40}" for k in range(100)] + [None, "", "Text 3"]
    value = {"timestamp_ntz": "timestamp_seconds(id)"}.get(kind, "id")
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string").selectExpr(f"cast({value} as {kind}) AS doc_id", "text")
    docs = docs.union(spark.sql(f"SELECT cast(NULL AS {kind}), 'text 1'"))
    halves = {r[0] for r in docs.where("doc_id is not null").select(exact.older_half(docs)).collect()}
    assert halves == {True, False}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert collected(exact.dedup(docs), "doc_id", "keep_id", "group_size", "kept", "text_sha256") == brute_exact(rows)
