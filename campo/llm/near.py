"""Near-dedup by BagMinHash: weighted-Jaccard signatures of the multiset of
word 5-grams, banding, and exact verification of multiset overlap.

Signature (after Ertl, "BagMinHash", 2018).  Weights are cut at 1, 2, 4, 8, ...;
each (shingle, weight interval) runs a Poisson process of points whose rate is
the interval's width.  A point has a register, a time and a level inside its
interval, and counts where the level is below the shingle's weight.  A register
keeps the least time; two texts agree in a register with probability equal to
their weighted Jaccard similarity.  A process stops when its time has passed
all of its text's registers.

Texts with the same multiset are one node.  A bucket (equal band) compares all
members with its least and greatest; both then leave it.  One minus weighted
Jaccard is a metric, so a member within 0.2 of such a pivot can't be within 0.2
of one that is farther than 0.4 from it: where no member lies in between, the
pivot's near members leave as well.  Some members of a bucket's largest
component are then compared with the members of its other components.  What
is left of buckets with several components is compared in blocks of ``BLOCK``
members inside tasks, each pair in the first band it shares, and only links
come out: no candidate pair that could join two components goes unexamined,
and no task or table lists all pairs of a bucket.  A pair
is first compared by one byte a register: an estimate ``SLACK`` below the
threshold, or ``SLACK`` below 0.6, is off by more than five deviations.

Components come from minimum labels with pointer jumping over written tables.

Words are runs without ASCII white space, A-Z as a-z.  A text of one to four
words has one shingle, the whole; a text without words (null, empty) is a class
of its own.  The least doc_id of a class stays (null is least), one row of it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.blocks import Block, mix64, per_text, slices, windows
from campo.llm.common import flagged, keep_rows, key_bitmap, stage, text_hash, text_of

WIDTH, THRESHOLD = 5, 0.8
BANDS, ROWS = 32, 5     #: a pair at similarity 0.8 shares no band with probability 3e-6
TURNS = 3               #: how often a member of a bucket's largest component is compared with the others
SLICE = 1 << 20         #: bytes of text signed at a time
BLOCK = 512             #: members of a bucket that meet in a task
SLACK = 0.2             #: a pair whose estimate is lower than the threshold by this is not verified
_STEP = np.uint64(0x9E3779B97F4A7C15)


def bags(block: Block, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles: text number, hash and multiplicity, by text and hash."""
    starts, ends, words = block.words()
    hashes = block.hashes(starts, ends, fold=True)
    grams, first = windows(hashes, words, width)
    text = per_text(words)[first] if len(first) else np.empty(0, np.int64)
    short = np.flatnonzero((words > 0) & (words < width))
    if len(short):
        begin = np.concatenate([[0], np.cumsum(words)])[short]
        whole = np.zeros(len(short), np.uint64)
        for k in range(width - 1):
            has = words[short] > k
            whole[has] = mix64(whole[has] * _STEP + hashes[begin[has] + k] + np.uint64(k + 1))
        grams, text = np.concatenate([grams, mix64(whole)]), np.concatenate([text, short])
    order = np.lexsort((grams, text))
    grams, text = grams[order], text[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], grams[at], np.diff(np.append(at, len(grams)))


def signatures(text: np.ndarray, grams: np.ndarray, weight: np.ndarray, n: int, size: int = BANDS * ROWS) -> np.ndarray:
    """Register times (n x size); infinite for a text without shingles."""
    registers = np.full(n * size, np.inf)
    levels = [(0, 1)]
    top = int(weight.max(initial=0))
    while levels[-1][0] + levels[-1][1] < top:
        low = levels[-1][0] + levels[-1][1]
        levels.append((low, low))
    parts = []
    for k, (low, span) in enumerate(levels):
        on = np.flatnonzero(weight > low)
        parts.append((text[on], mix64(grams[on] + np.uint64(0x9E3779B97F4A7C15 * (k + 1) % 2 ** 64)), weight[on] - low, np.full(len(on), span)))
    doc, state, room, span = (np.concatenate(x) for x in zip(*parts))
    time = np.zeros(len(doc))
    while len(doc):
        state = mix64(state + _STEP)
        time = time - np.log(((state >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / span
        draw = mix64(state ^ np.uint64(0xA5A5A5A55A5A5A5A))
        cell = doc * size + (((draw >> np.uint64(32)) * np.uint64(size)) >> np.uint64(32)).astype(np.int64)
        level = (((draw & np.uint64(0xFFFFFFFF)) * span.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
        counts = level < room
        np.minimum.at(registers, cell[counts], time[counts])
        worst = registers.reshape(n, size).max(axis=1)
        alive = time < worst[doc]
        doc, state, room, span, time = doc[alive], state[alive], room[alive], span[alive], time[alive]
    return registers.reshape(n, size)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """One 64-bit hash a band; the last bits of a time are rounded off."""
    bits = (registers.view(np.uint64) + np.uint64(1 << 11)) >> np.uint64(12)
    out = np.zeros((len(bits), BANDS), np.uint64)
    for k in range(ROWS):
        out = mix64(out * _STEP + bits[:, k::ROWS] + np.uint64(k + 1))
    return mix64(out + np.arange(BANDS, dtype=np.uint64) * _STEP)


def sketches(registers: np.ndarray) -> np.ndarray:
    """One byte a register (n x registers)."""
    bits = (registers.view(np.uint64) + np.uint64(1 << 11)) >> np.uint64(12)
    return (mix64(bits) & np.uint64(0xFF)).astype(np.uint8)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _give_back() -> None:
    """Return a worker's free memory to the system: workers live on, idle, while
    the joins that follow need the executor's memory."""
    import ctypes

    from campo.llm import blocks
    blocks._powers.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def prints_of(docs: DataFrame) -> DataFrame:
    """One row a document: row, doc_id, text_hash, bag (hash of its multiset
    of shingles, null without words), its bands and its sketch."""
    def sign(batches):
        for part, block in slices(batches, size=SLICE):
            text, grams, weight = bags(block)
            registers = signatures(text, grams, weight, block.n)
            bands, bytes_ = band_hashes(registers), sketches(registers)
            sums = np.zeros(block.n, np.uint64)
            np.add.at(sums, text, mix64(grams) * weight.astype(np.uint64))
            empty = np.bincount(text, minlength=block.n) == 0
            yield pa.record_batch({
                "row": part.column("row"), "doc_id": part.column("doc_id"), "text_hash": part.column("text_hash"),
                "bag": pa.array(mix64(sums).view(np.int64), mask=empty),
                "bands": pa.ListArray.from_arrays(pa.array(np.arange(block.n + 1, dtype=np.int32) * BANDS), _long(bands.ravel())),
                "sketch": pa.array([b.tobytes() for b in bytes_], pa.binary())})
        _give_back()

    schema = T.StructType([T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           T.StructField("text_hash", T.LongType()), T.StructField("bag", T.LongType()),
                           T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("sketch", T.BinaryType())])
    return docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"),
                       text_hash(docs).alias("text_hash"), text_of(docs).alias("text")).mapInArrow(sign, schema)


def shingle_rows(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Multisets of the nodes (bag, text_hash): bag and its sorted shingles
    and multiplicities."""
    def pick(batches):
        for part, block in slices(batches, size=SLICE):
            text, grams, weight = bags(block)
            cut = np.searchsorted(text, np.arange(block.n + 1))
            yield pa.record_batch({"bag": part.column("bag"), "shingles": pa.array(
                [grams[a:b].tobytes() + weight[a:b].astype("<u4").tobytes() for a, b in zip(cut, cut[1:])], pa.binary())})

    named = nodes.select("bag", F.col("text_hash").alias("of"))
    named = stage(named, "near-nodes")
    texts = docs.select(text_hash(docs).alias("h"), text_of(docs).alias("text"))
    texts = flagged(texts, F.col("h"), stage(key_bitmap(named, "of"), "near-bits")).where("__llm_flag")
    met = texts.join(named, F.col("h") == F.col("of")).select("bag", "text")
    return met.mapInArrow(pick, "bag long, shingles binary").groupBy("bag").agg(F.min("shingles").alias("shingles"))


def overlap(a: bytes, b: bytes) -> tuple[int, int]:
    """Sums of the lesser and of the greater multiplicities."""
    n, m = len(a) // 12, len(b) // 12
    x, y = np.frombuffer(a, "<u8", n), np.frombuffer(b, "<u8", m)
    wx, wy = np.frombuffer(a, "<u4", n, 8 * n), np.frombuffer(b, "<u4", m, 8 * m)
    at = np.minimum(np.searchsorted(y, x), m - 1)
    same = y[at] == x
    both = int(np.minimum(wx[same], wy[at[same]]).sum())
    return both, int(wx.sum()) + int(wy.sum()) - both


def _both_sides(pairs: DataFrame, table: DataFrame, column: str) -> DataFrame:
    """Pairs (a, b) with ``column`` of either bag as ``x`` and ``y``."""
    left = table.select(F.col("bag").alias("ka"), F.col(column).alias("x"))
    right = table.select(F.col("bag").alias("kb"), F.col(column).alias("y"))
    met = pairs.join(right, F.col("b") == F.col("kb")).join(left, F.col("a") == F.col("ka"))
    return met.select("a", "b", "x", "y")


def compared(pairs: DataFrame, sketch: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) that are not surely far apart, with ``linked``: their
    multisets overlap by ``threshold`` or more."""
    far = 1 - 2 * (1 - threshold) - SLACK

    def estimate(batches):
        for batch in batches:
            if batch.num_rows:
                size = BANDS * ROWS
                x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, size) for c in ("x", "y"))
                alike = ((x == y).mean(axis=1) - 1 / 256) / (1 - 1 / 256)
                keep = alike >= far
                yield pa.record_batch({"a": batch.column("a"), "b": batch.column("b"), "alike": alike}).filter(pa.array(keep))

    def test(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                both, all_ = overlap(x, y)
                keep.append(both >= threshold * all_ - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    likely = stage(_both_sides(pairs, sketch, "sketch").mapInArrow(estimate, "a long, b long, alike double"), "near-likely")
    linked = _both_sides(likely.where(F.col("alike") >= threshold - SLACK).select("a", "b"), shingles, "shingles").mapInArrow(test, "a long, b long")
    linked = linked.select(F.col("a").alias("la"), F.col("b").alias("lb"))
    return stage(likely.join(linked, (F.col("a") == F.col("la")) & (F.col("b") == F.col("lb")), "left").select(
        "a", "b", F.col("la").isNotNull().alias("linked")), "near-compared")


def components(links: DataFrame, labels: DataFrame | None = None) -> DataFrame:
    """(node, label): the least node of each component over ``links`` (a, b),
    starting from ``labels`` if given.  Nodes without a link have no row."""
    both = stage(links.select("a", "b").union(links.select("b", "a")), "near-links")
    now = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    if labels is not None:
        old = labels.union(both.select(F.col("a").alias("node"), F.col("a").alias("label")))
        now = now.union(old).groupBy("node").agg(F.min("label").alias("label"))
        # what was one component stays one
        both = stage(both.union(labels.where("node <> label").select("node", "label"))
                     .union(labels.where("node <> label").select("label", "node")), "near-links")
    now = stage(now, "near-labels")
    while True:
        told = both.join(now, F.col("a") == F.col("node")).select(F.col("b").alias("node"), "label")
        least = stage(now.select("node", "label", F.lit(1).alias("own")).union(told.withColumn("own", F.lit(0)))
                      .groupBy("node").agg(F.min("label").alias("label"), F.min(F.when(F.col("own") == 1, F.col("label"))).alias("was")), "near-least")
        jump = least.select(F.col("node").alias("at"), F.col("label").alias("to"))
        now = stage(least.join(jump, F.col("label") == F.col("at"), "left").select(
            "node", F.coalesce("to", "label").alias("label"), "was"), "near-labels")
        if not now.where("label <> was").limit(1).count():
            return now.select("node", "label")
        now = now.select("node", "label")


def link_components(prints: DataFrame, docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(node, label) of every bag with a verified link to another bag."""
    bag_rows = prints.where("bag is not null")
    # one row a bag; its copies have equal bands, so any one of them will do
    nodes = stage(bag_rows.groupBy("bag").agg(F.min("text_hash").alias("text_hash"), F.any_value("bands").alias("bands"),
                                              F.any_value("sketch").alias("sketch")), "near-bags")
    members = stage(nodes.select("bag", F.posexplode("bands").alias("band", "hash"))
                    .select(F.xxhash64("band", "hash").alias("key"), "bag"), "near-members")
    ends = members.groupBy("key").agg(F.min("bag").alias("low"), F.max("bag").alias("high"), F.count(F.lit(1)).alias("size"))
    ends = stage(ends.where("size > 1").withColumnRenamed("key", "of"), "near-buckets")
    met = stage(members.join(ends, F.col("key") == F.col("of")).drop("of"), "near-met")
    texts = nodes.select("bag", "text_hash").join(met.select("bag").distinct(), "bag")
    shingles = stage(shingle_rows(docs, texts), "near-shingles")
    ordered = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    candidates = met.select(*ordered("low", "bag")).union(met.select(*ordered("high", "bag"))).where("a < b").distinct()
    status = compared(candidates, nodes, shingles, threshold)
    labels = components(status.where("linked"))
    left = _unsettled(met.where("size > 3"), status)
    for turn in range(TURNS + 1):
        labelled = left.join(labels, F.col("bag") == F.col("node"), "left").select("key", "bag", F.coalesce("label", "bag").alias("label"))
        labelled = stage(labelled, "near-left")
        # the least hash picks the same member in all buckets that hold about the same ones
        parts = labelled.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(
            F.xxhash64("bag", F.lit(turn)).alias("hash"), "bag"))["bag"].alias("least"))
        open_ = parts.groupBy("key").agg(F.max(F.struct("n", "label", "least")).alias("top"), F.sum("n").alias("size"), F.count(F.lit(1)).alias("parts"))
        open_ = stage(open_.where("parts > 1").select(F.col("key").alias("of"), F.col("top.least").alias("pivot"), "size"), "near-open")
        if not open_.limit(1).count():
            return labels
        rest = labelled.join(open_, F.col("key") == F.col("of")).drop("of")
        if turn == TURNS:
            return components(in_blocks(rest, nodes, shingles, threshold), labels)
        rest = stage(rest.withColumn("pivot", F.col("bag") == F.col("pivot")), "near-rest")
        chosen = rest.where("pivot").select(F.col("key").alias("of"), F.col("bag").alias("p"), F.col("label").alias("p_label"))
        candidates = rest.join(chosen, (F.col("key") == F.col("of")) & (F.col("label") != F.col("p_label"))).select(
            *ordered("p", "bag")).distinct()
        more = compared(candidates, nodes, shingles, threshold).where("linked")
        if more.limit(1).count():
            labels = components(more, labels)
        left = rest.where("not pivot").select("key", "bag")


def _compare_blocks(threshold: float):
    """Links between the members of two blocks of a bucket (or of one)."""
    def compare(key, table):
        side = table.column("side").to_numpy()
        bands = np.frombuffer(b"".join(table.column("band_bytes").to_pylist()), np.int64).reshape(-1, BANDS)
        sketch = np.frombuffer(b"".join(table.column("sketch").to_pylist()), np.uint8).reshape(-1, BANDS * ROWS)
        band, label, bag = (table.column(c).to_numpy() for c in ("band", "label", "bag"))
        blobs = table.column("shingles")
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1) if (side == 1).any() else np.flatnonzero(side == 0)
        out = []
        for x in left:
            # once for each pair: in one block the greater bag is met, in two all of the other
            ys = right[(label[right] != label[x]) & ((side[right] == 1) | (bag[right] > bag[x]))]
            first = (bands[ys] == bands[x]).argmax(axis=1) == band[x]
            alike = (sketch[ys] == sketch[x]).mean(axis=1) >= (threshold - SLACK) * (1 - 1 / 256) + 1 / 256
            for y in ys[first & alike]:
                both, all_ = overlap(blobs[int(x)].as_py(), blobs[int(y)].as_py())
                if both >= threshold * all_ - 1e-9:
                    out.append((min(bag[x], bag[y]), max(bag[x], bag[y])))
        pairs = np.array(out, np.int64).reshape(-1, 2)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})
    return compare


def in_blocks(rest: DataFrame, nodes: DataFrame, shingles: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between members of different components of a bucket
    (key, bag, label, size)."""
    full = nodes.select(F.col("bag").alias("of"), "bands", "sketch")
    blobs = shingles.select(F.col("bag").alias("kb"), "shingles")
    met = rest.select("key", "bag", "label", "size").join(full, F.col("bag") == F.col("of")).drop("of")
    # the band of this bucket, and the member's block; then a row for each pair of blocks
    band = F.array_position(F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda i: F.xxhash64(i, F.get("bands", i))), F.col("key")) - 1
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    raw = F.unhex(F.array_join(F.transform("bands", lambda v: F.lpad(F.hex(v), 16, "0")), ""))
    met = met.select("key", "bag", "label", "sketch", band.cast("int").alias("band"), raw.alias("band_bytes"), blocks.alias("blocks"),
                     F.pmod(F.xxhash64("bag", F.lit(5)), blocks).cast("int").alias("block"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("key", "bag", "label", "sketch", "band", "band_bytes", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                     F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"))
    met = met.join(blobs, F.col("bag") == F.col("kb")).drop("kb")
    links = met.groupBy("key", "i", "j").applyInArrow(_compare_blocks(threshold), "a long, b long")
    return stage(links.distinct(), "near-verified")


def _unsettled(met: DataFrame, status: DataFrame) -> DataFrame:
    """(key, bag) of the members that may still have an unexamined link in
    their bucket after it was compared with its ends."""
    for end in ("low", "high"):
        found = status.select(F.col("a").alias("pa"), F.col("b").alias("pb"), F.col("linked").alias(f"{end}_linked"))
        met = met.join(found, (F.least(end, "bag") == F.col("pa")) & (F.greatest(end, "bag") == F.col("pb")), "left").drop("pa", "pb")
    between = met.groupBy("key").agg(*[F.max(F.coalesce(~F.col(f"{end}_linked"), F.lit(False)) & (F.col("bag") != F.col(end))).alias(f"{end}_between")
                                       for end in ("low", "high")]).withColumnRenamed("key", "of")
    met = met.join(between, F.col("key") == F.col("of"))
    settled = [F.coalesce(F.col(f"{end}_linked"), F.lit(False)) & ~F.col(f"{end}_between") for end in ("low", "high")]
    return met.where("bag <> low and bag <> high").where(~settled[0] & ~settled[1]).select("key", "bag")


def classes(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every row with its class: row, doc_id, text_hash, class_id (least
    doc_id of the class), class_size, kept."""
    prints = stage(prints_of(docs), "near-prints")
    labels = stage(link_components(prints, docs, threshold), "near-components")
    rows = prints.drop("bands", "sketch").join(labels, F.col("bag") == F.col("node"), "left").select(
        "row", "doc_id", "text_hash", F.coalesce("label", "bag").alias("class"))
    rows = stage(rows, "near-rows")
    shared = rows.where("class is not null").groupBy("class").agg(
        F.min(F.struct("doc_id", "row")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(shared.withColumnRenamed("class", "of"), "near-classes")
    out = rows.join(shared, F.col("class") == F.col("of"), "left")
    return out.select("row", "doc_id", "text_hash",
                      F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("class_id"),
                      F.coalesce("n", F.lit(1)).cast("long").alias("class_size"),
                      F.coalesce(F.col("first.row") == F.col("row"), F.lit(True)).alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, class_id, class_size, kept."""
    return classes(docs).select("doc_id", "class_id", "class_size", "kept")


def survivors(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    return keep_rows(docs, classes(docs))
