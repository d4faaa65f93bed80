"""Mixing against SQL and packing against its rules."""

import zlib
from collections import defaultdict

import duckdb
import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campo.llm import common, mixing, packing
from tests.llm.conftest import SF_SMALL, table


def sql_mix(docs):
    con = duckdb.connect()
    con.register("documents", docs.select("doc_id", "text", "source").toPandas().astype({"doc_id": "Int64"}))
    return con.execute(mixing.SQL).df()


def as_rows(frame):
    cols = ["doc_id", "size", "source_size", "target", "taken"]
    num = lambda v: None if v != v or v is None else float(v)
    return sorted((tuple(num(x) if not str(x) == "<NA>" else None for x in r) for r in frame[cols].itertuples(index=False)), key=repr)


def test_mix_matches_sql(spark, odd):
    for docs in (odd, table(spark, SF_SMALL, "documents")):
        got = mixing.mix(docs)
        assert as_rows(got.toPandas()) == as_rows(sql_mix(docs))
        assert got.agg(F.sum("taken")).first()[0] <= got.agg(F.sum("size")).first()[0]
        assert got.where("taken > 3 * size or taken % greatest(size, 1) <> 0").count() == 0


def test_mix_does_not_depend_on_partitions(spark, odd):
    a, b = mixing.mix(odd).toPandas(), mixing.mix(odd.repartition(7)).toPandas()
    assert as_rows(a) == as_rows(b)


def test_mixed_rows(spark, odd, none):
    counts = {}
    for r in mixing.mix(odd).collect():
        counts[r["doc_id"]] = counts.get(r["doc_id"], 0) + r["copies"]
    out = mixing.mixed(odd)
    assert out.columns == odd.columns
    got = defaultdict(int)
    for r in out.collect():
        got[r["doc_id"]] += 1
    assert got == {k: v for k, v in counts.items() if v}
    assert mixing.mix(none).collect() == [] and mixing.mixed(none).collect() == []


def test_running_is_exact_for_a_hot_group(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).otherwise((F.col("id") % 50).cast("string")).alias("g"),
        F.xxhash64("id").alias("o"), "id", (F.col("id") % 7).alias("v"))
    got = common.running(df, ["g"], "o", ["id"], {"s": "v", "n": "1"}, chunk=16).collect()
    want = defaultdict(lambda: [0, 0])
    for r in sorted(got, key=lambda r: (r["o"], r["id"])):
        w = want[r["g"]]
        assert (r["s"], r["n"]) == tuple(w)
        w[0] += r["v"]
        w[1] += 1
    assert len(got) == 3000


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_pack_ids_and_places(spark, odd, none, vocabularies):
    path = f"{vocabularies}/byte_bpe_50k.json"
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    for docs in (odd, table(spark, SF_SMALL, "documents")):
        rows = packing.packed(docs, path).collect()
        used = check_packing(rows, 1024)
        total = sum(r["length"] for r in rows)
        assert used <= 1.03 * -(-total // 1024) + 1
        want = defaultdict(list)
        for r in docs.collect():
            ids = np.array([*whole.encode(r["text"] or "", add_special_tokens=False).ids, 2], "<u4")
            cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
            for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                want[r["doc_id"]].append((k, a, b - a, zlib.crc32(ids[a:b].tobytes())))
        got = defaultdict(list)
        for r in rows:
            got[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
        assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.packed(none, path).collect() == []


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300), max_size=25))
def test_plan_places_every_piece_once(histogram):
    slots = packing.plan(histogram, 40)
    for length, n in histogram.items():
        on = slots["length"] == length
        spans = sorted(zip(slots["first"][on], slots["count"][on]))
        at = 0
        for first, count in spans:
            assert first == at
            at += count
        assert at == n
    rows = [{"sequence_id": s + k, "offset": o, "length": x}
            for x, c, s, o in zip(slots["length"], slots["count"], slots["sequence"], slots["offset"]) for k in range(c)]
    assert check_packing(rows, 40) <= sum(histogram.values())


def test_patterns_fill_a_sequence():
    assert all(sum(p) == 64 and 2 <= len(p) <= 3 for p in packing.patterns(64))
    uniform = {x: 200 for x in range(1, 64)}
    fitted = packing.fit(uniform, 64)
    assert sum(len(p) * n for p, n in fitted) > 0.8 * sum(uniform.values())


def test_selected_texts_are_shuffled_once(spark):
    from campo.llm.common import select_rows, text_hash
    docs = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, "c"), (None, "c"), (2, None), (3, "d")], "doc_id long, text string")
    asked = docs.distinct().select("doc_id", text_hash(docs).alias("text_hash"), F.when(F.col("text") == "d", 0).otherwise(2).alias("copies"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = select_rows(docs, asked)
        got = sorted([tuple(r) for r in found.collect()], key=repr)
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted([(1, "a"), (1, "b"), (None, "c"), (2, None)] * 2, key=repr)
    final = plan.split("Initial Plan")[0]
    window = final[final.index("Window ["):]
    assert "Exchange" not in window[:window.index("SortMergeJoin")]
