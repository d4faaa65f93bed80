"""Quality rules: fixed counts over the whole text and a hashed word and
character n-gram classifier trained on labelled quality rows.

``annotate`` adds counts and verdict; ``accepted`` keeps the accepted rows.

Null text counts as empty.  An empty text has zero words and fails the base
rule (fewer than 50 words).  Repeated rows are judged alike.  Without labels,
or with labels of one class only, the base rule alone decides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.blocks import Block, mix64, per_text, slices, text_block, windows
from campo.llm.linear import Trainer, platt, pooled, sigmoid

BITS = 18                      #: features are hashed to 2 ** BITS weights a group
SAMPLE_PER_CLASS = 5000        #: bound on the labelled texts the classifier is fitted on, for each class
SLICE = 1 << 20                #: bytes of text whose features are held at once
SHARES = 4                     #: tasks that fit a model each
EPOCHS = 4
KEEP_AT = 0.3                  #: calibrated probability of good quality at which a text is kept
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
CHAR_GRAMS, WORD_GRAMS = (3, 4), (1, 2)


def features(block: Block) -> list[tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]]:
    """Character n-grams, then word n-grams: feature numbers with their text
    numbers, and how many a text has."""
    codes = np.frombuffer(block.data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.uint64)
    lead = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    size = np.diff(lead[block.offsets])
    text = per_text(size).astype(np.int32)
    chars, n_chars = [], np.zeros(block.n, np.int64)
    for n in CHAR_GRAMS:
        if len(codes) < n:
            continue
        rolled = codes[:len(codes) - n + 1].copy()
        for k in range(1, n):
            rolled *= np.uint64(0x9E3779B97F4A7C15)
            rolled += codes[k:len(codes) - n + 1 + k]
        rolled *= np.uint64(0xD6E8FEB86659FD93 + 2 * n)
        rolled >>= np.uint64(64 - BITS)
        ok = text[:len(rolled)] == text[n - 1:]
        chars.append((rolled[ok].astype(np.int32), text[:len(rolled)][ok]))
        n_chars += np.maximum(size - n + 1, 0)
    starts, ends, words = block.words()
    hashes = block.hashes(starts, ends)
    grams, n_grams = [], np.zeros(block.n, np.int64)
    text = per_text(words).astype(np.int32)
    for n in WORD_GRAMS:
        gram, first = windows(hashes, words, n)
        grams.append(((gram >> np.uint64(64 - BITS)).astype(np.int32) + np.int32(1 << BITS), text[first]))
        n_grams += np.maximum(words - n + 1, 0)
    return [(chars, n_chars), (grams, n_grams)]


def base_counts(block: Block) -> dict[str, np.ndarray]:
    """The five counts of each text."""
    starts, ends, n_words = block.words()
    text = per_text(n_words)
    lead = np.concatenate([[0], np.cumsum((block.data & 0xC0) != 0x80)])
    sums = lambda x, of: np.bincount(of, x, block.n).astype(np.int64)
    symbol = np.concatenate([[0], np.cumsum(SYMBOLS[block.data])])
    # words of 3-word windows that the text holds twice or more
    gram, first = windows(block.hashes(starts, ends), n_words, 3)
    key = mix64(gram + mix64(text[first].astype(np.uint64)))
    _, kind, often = np.unique(key, return_inverse=True, return_counts=True)
    again = first[often[kind] > 1] if len(key) else first
    repeated = np.zeros(len(starts) + 3, bool)
    for k in range(3):
        repeated[again + k] = True
    # lines with a word that equal an earlier one of the text
    newline = np.flatnonzero(block.data == 10)
    limits = np.sort(np.concatenate([newline, block.offsets[1:]]), kind="stable")
    begins = np.sort(np.concatenate([newline + 1, block.offsets[:-1]]), kind="stable")
    has = np.searchsorted(starts, limits) > np.searchsorted(starts, begins)
    begins, limits = begins[has], limits[has]
    of = np.searchsorted(block.offsets, begins, "right") - 1
    line = mix64(block.hashes(begins, limits) + mix64(of.astype(np.uint64)))
    _, kept = np.unique(line, return_index=True)
    distinct = np.bincount(of[kept], minlength=block.n)
    return {"n_words": n_words.astype(np.int64),
            "word_chars": sums(lead[ends] - lead[starts], text),
            "n_symbols": symbol[block.offsets[1:]] - symbol[block.offsets[:-1]],
            "n_dup_lines": np.bincount(of, minlength=block.n) - distinct,
            "n_repeat_words": sums(repeated[:len(starts)], text)}


def base_failed(c: dict[str, np.ndarray]) -> np.ndarray:
    return (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > MAX_REPEATED_PERCENT * c["n_words"])


class Model:
    """Averaged weights and the calibration curve; None where there was
    nothing to learn from."""

    def __init__(self, weights: np.ndarray, bias: float, gain: float, slope: float = 1.0, offset: float = 0.0):
        self.weights, self.bias, self.gain = weights.astype(np.float32), bias, gain
        self.slope, self.offset = slope, offset

    def logits(self, block: Block) -> np.ndarray:
        return self.bias + sum(self.gain * pooled(self.weights, i, n) for i, n in features(block))

    def probability(self, block: Block) -> np.ndarray:
        return sigmoid(self.slope * self.logits(block) + self.offset)


def _fit_share(key, batch):
    """Fit a model on one share of the sample."""
    batch = batch.sort_by([("order", "ascending"), ("text", "ascending")])
    label = batch.column("label").to_numpy().astype(float)
    trainer = Trainer(2 << BITS)
    if 0 < label.sum() < len(label):
        weight = np.where(label > 0.5, len(label) / label.sum(), len(label) / (1 - label).sum()) / 2
        for _ in range(EPOCHS):
            done = 0
            for part, block in slices(batch.to_batches(max_chunksize=32), size=SLICE):
                rows = slice(done, done + part.num_rows)
                trainer.step(features(block), label[rows], weight[rows])
                done += part.num_rows
    return pa.table({"rows": pa.array([len(label)], pa.int64()), "bias": pa.array([trainer.bias]),
                     "gain": pa.array([trainer.gain]), "weights": pa.array([trainer.w.astype("<f4").tobytes()], pa.binary())})


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Model | None:
    """Fit on at most ``per_class`` labelled texts of each class (those with
    the least hash of doc_id): four fifths in ``SHARES`` models that are
    averaged, the rest for the calibration curve."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.min("quality").alias("label"))
    order = F.xxhash64(F.col("doc_id"))
    picked = None
    for value in (0, 1):
        one = known.where(F.col("label") == value).orderBy(order, "doc_id").limit(per_class)
        picked = one if picked is None else picked.union(one)
    picked = picked.select(F.col("doc_id").alias("_id"), F.col("label").cast("double").alias("label"))
    texts = docs.select(docs["doc_id"].alias("_of"), F.coalesce(docs["text"].cast("string"), F.lit("")).alias("text"))
    sample = texts.join(F.broadcast(picked), F.col("_of") == F.col("_id")).select(
        "text", "label",
        F.xxhash64("_id", F.lit(1)).alias("order"))  # broadcast: 2 * per_class rows of 16 bytes
    sample = sample.withColumn("share", F.pmod(F.shiftright("order", 8), F.lit(SHARES)))
    sample = sample.withColumn("fit", F.pmod("order", F.lit(5)) > 0)
    from campo.llm.common import stage
    sample = stage(sample, "quality-sample")
    fits = sample.where("fit").groupBy("share").applyInArrow(
        _fit_share, "rows long, bias double, gain double, weights binary").collect()
    fits = [r for r in fits if any(np.frombuffer(r["weights"], "<f4"))]
    if not fits:
        return None
    total = sum(r["rows"] for r in fits)
    model = Model(sum(np.frombuffer(r["weights"], "<f4").astype(float) * (r["rows"] / total) for r in fits),
                  sum(r["bias"] * r["rows"] / total for r in fits), fits[0]["gain"])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def held(batches):
        for part, block in slices(batches, size=SLICE):
            yield pa.record_batch({"z": shared.value.logits(block), "label": part.column("label")})

    rest = sample.where("not fit").select("text", "label").mapInArrow(held, "z double, label double").collect()
    z, y = np.array([r["z"] for r in rest]), np.array([r["label"] for r in rest])
    order = np.lexsort((y, z))
    model.slope, model.offset = platt(z[order], y[order]) if len(z) else (1.0, 0.0)
    return model


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _judge(block: Block, model: Model | None):
    counts = base_counts(block)
    failed = base_failed(counts)
    quality = model.probability(block) if model else np.where(failed, 0.0, 1.0)
    return counts, failed, quality, ~failed & (quality >= KEEP_AT)


def annotate(docs: DataFrame, model: Model | None) -> DataFrame:
    """One row per document: doc_id, the counts, base_failed, kept, quality."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, block in slices(batches, size=SLICE):
            counts, failed, quality, kept = _judge(block, shared.value)
            yield pa.record_batch({"doc_id": part.column("doc_id"), **{k: counts[k] for k in COUNTS},
                                   "base_failed": failed, "kept": kept, "quality": quality})

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType),
                           *[T.StructField(k, T.LongType()) for k in COUNTS],
                           T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()),
                           T.StructField("quality", T.DoubleType())])
    return docs.select("doc_id", docs["text"].cast("string").alias("text")).mapInArrow(run, schema)


def accepted(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, block in slices(batches, size=SLICE):
            yield part.filter(pa.array(_judge(block, shared.value)[3]))

    return docs.mapInArrow(run, docs.schema)
