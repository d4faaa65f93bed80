"""Language-model scoring: log10 probability of every whole text under a small
gated recurrent model (see ``gru``), and under add-half unigram counts.

Tokens are words (runs without ASCII white space, A-Z as a-z) and one end per
document.  Words are known by a 64-bit hash.  Counts cover all training
documents.  Frequent words (at most ``FREQUENT``, by a threshold on the count)
and the model's are looked up in a broadcast table; all rarer ones are joined,
so that no word is a hot key of the join.  The recurrent model knows all words
with at least ``LEAST`` occurrences and a share of 1 / ``SHARE`` of the training
tokens, whatever the threshold; any other word has the model's probability of
"other" times its add-half share of all other words, so scores are of the words
themselves.

The model is trained on all training documents in ``ROUNDS`` parts: each task
trains the current model on its texts, and the tasks' weights are averaged by
tokens.

Null and empty texts are their end token.  Repeated rows score alike.  Without
training documents the unigram score is log10 of (0.5 / 0.5) per token, as the
formula gives, and the model's that of an untrained model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm import gru
from campo.llm.blocks import hash_text, per_text, slices
from campo.llm.common import remainder, stage, text_of

FREQUENT = 1 << 17
LEAST, SHARE = 5, 65_000  #: occurrences, and one of so many tokens (16-bit numbers), that a word of the model has at least
ROUNDS = 2
RATE = 0.1
TEXTS_AT_ONCE, TOKENS_AT_ONCE = 4096, 1 << 21
HASHED_AT_ONCE, COUNTED_AT_ONCE = 1 << 19, 8 << 20  #: bytes of text; those hashed have room in a core's cache
CHUNK = 1024
STEPS = 4096  #: levels a pass of the search for the least count
END_HASH = np.uint64(hash_text("\n"))  # no word holds white space
END = int(END_HASH.view(np.int64))


def held_out(docs: DataFrame):
    return remainder(docs, 5) == 1


def _tokens(block) -> tuple[np.ndarray, np.ndarray]:
    starts, ends, words = block.words()
    return block.hashes(starts, ends, fold=True), words


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, c) of all tokens of ``docs``, the end included."""
    def counted(held, texts):
        kinds, often = np.unique(np.concatenate(held), return_counts=True)
        return pa.record_batch({"word": pa.array(np.append(kinds, END_HASH).view(np.int64)), "c": pa.array(np.append(often, texts))})

    def count(batches):
        held, size, texts = [], 0, 0
        for _, block in slices(batches, size=HASHED_AT_ONCE):
            held.append(_tokens(block)[0])
            size, texts = size + len(block.data), texts + block.n
            if size >= COUNTED_AT_ONCE:
                yield counted(held, texts)
                held, size, texts = [], 0, 0
        if held:
            yield counted(held, texts)

    return docs.select(text_of(docs).alias("text")).mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


class Words:
    """Words of the look-up table by hash: count, and number in the model's
    vocabulary, which are those with at least ``learnt`` occurrences."""

    def __init__(self, word: np.ndarray, count: np.ndarray, learnt: int):
        by_count = np.lexsort((word, -count))
        chosen = by_count[(word[by_count] != END_HASH) & (count[by_count] >= learnt)]
        number = np.full(len(word), gru.OTHER, np.uint16)
        number[chosen] = 2 + np.arange(len(chosen))
        number[word == END_HASH] = gru.END
        order = np.argsort(word)
        self.word, self.count, self.number = word[order], count[order], number[order]
        self.chosen = count[chosen]
        self.ends = int(count[word == END_HASH].sum())

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(self.word):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.word, hashes), len(self.word) - 1)
        return at, self.word[at] == hashes


def least_count(counts: DataFrame) -> int:
    """The least count that at most ``FREQUENT`` words reach: by powers of two,
    then in ever smaller steps inside the power that crosses ``FREQUENT``."""
    left, low, width = FREQUENT, 0, None
    while width != 1:
        if width is None:  # bits of the count, 64 rows at most
            kind, inside = F.length(F.bin("c")), F.lit(True)
        else:
            step = max(1, width // STEPS)
            kind, inside = F.expr(f"(c - {low}) div {step}"), (F.col("c") >= low) & (F.col("c") < low + width)
        levels = counts.where(inside).groupBy(kind.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
        for r in sorted(levels, key=lambda r: -r["level"]):
            if r["n"] > left:
                break
            left -= r["n"]
        else:
            return low  # all words, or all of this power
        low, width = (1 << (r["level"] - 1), 1 << (r["level"] - 1)) if width is None else (low + r["level"] * step, step)
    return low + 1


def frequent(counts: DataFrame, n: int) -> Words:
    """The words at or above the least count that at most ``FREQUENT`` words
    reach, and the model's vocabulary in any case.  Words that share the count
    below are more than ``FREQUENT`` with those above, so none of them is a hot
    key.  ``n`` is the sum of all counts."""
    learnt = max(LEAST, -(-n // SHARE))
    rows = counts.where((F.col("c") >= min(least_count(counts), learnt)) | (F.col("word") == END)).toPandas()
    return Words(rows["word"].to_numpy(np.int64).view(np.uint64), rows["c"].to_numpy(np.int64), learnt)


def encoded(docs: DataFrame, words: Words) -> DataFrame:
    """One narrow row a document: model word numbers (bytes of 16-bit), the
    rare words' hashes, and the frequent words' part of the sums."""
    shared = docs.sparkSession.sparkContext.broadcast(words)

    def encode(batches):
        w = shared.value
        log = np.log10(w.count + 0.5)
        end, has_end = w.find(np.array([END_HASH]))
        end_log = float(log[end[0]]) if has_end[0] else float(np.log10(0.5))
        for part, block in slices(batches, size=HASHED_AT_ONCE):
            hashes, n = _tokens(block)
            text = per_text(n)
            at, known = w.find(hashes)
            number = np.where(known, w.number[at] if len(w.word) else 0, gru.OTHER).astype("<u2")
            value = np.where(known, log[at] if len(w.word) else 0.0, 0.0)
            cut = np.concatenate([[0], np.cumsum(n)])
            rare = ~known
            ends = np.array([gru.END], "<u2").tobytes()
            yield pa.record_batch({
                "row": part.column("row"), "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                "n_tokens": n.astype(np.int64) + 1, "known": np.bincount(text[known], minlength=block.n) + int(has_end[0]),
                "log_all": np.bincount(text, value, block.n) + end_log,  # bincount of nothing has integers
                "log_other": np.bincount(text, np.where(number == gru.OTHER, value, 0.0), block.n).astype(float),
                "numbers": pa.array([number[a:b].tobytes() + ends for a, b in zip(cut, cut[1:])], pa.binary()),
                "rare": pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(rare)])[cut].astype(np.int32)),
                                                 pa.array(hashes[rare].view(np.int64)))})

    schema = T.StructType([
        T.StructField("row", T.LongType()), T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("log_all", T.DoubleType()),
        T.StructField("log_other", T.DoubleType()), T.StructField("numbers", T.BinaryType()), T.StructField("rare", T.ArrayType(T.LongType()))])
    return docs.select(F.monotonically_increasing_id().alias("row"), docs["doc_id"].alias("doc_id"), held_out(docs).alias("held_out"),
                       text_of(docs).alias("text")).mapInArrow(encode, schema)


def rare_sums(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Per row: sum of log10(c + 0.5) and number of known among rare words."""
    each = rows.where(F.size("rare") > 0).select("row", F.explode("rare").alias("rare"))
    met = each.join(counts, F.col("rare") == F.col("word"), "left")
    return met.groupBy(F.col("row").alias("of")).agg(
        F.sum(F.log10(F.coalesce("c", F.lit(0)) + 0.5)).alias("rare_log"), F.count("c").alias("rare_known"))


def _groups(batches):
    """Rows some thousands at a time, as slices of the batches, with their
    texts as arrays of word numbers."""
    held, texts, size = [], [], 0
    for batch in batches:
        begin = 0
        for r, v in enumerate(batch.column("numbers")):
            texts.append(np.frombuffer(v.as_buffer(), "<u2"))
            size += len(texts[-1])
            if len(texts) >= TEXTS_AT_ONCE or size >= TOKENS_AT_ONCE:
                yield [*held, batch.slice(begin, r + 1 - begin)], texts
                held, texts, size, begin = [], [], 0, r + 1
        if begin < batch.num_rows:
            held.append(batch.slice(begin))
    if texts:
        yield held, texts


def _mean(key, table):
    n = table.column("tokens").to_numpy().astype(float)
    parts = [np.frombuffer(b, "<f4") for b in table.column("weights").to_pylist()]
    mean = sum(p.astype(float) * w for p, w in zip(parts, n)) / n.sum()
    return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "weights": pa.array([mean.astype("<f4").tobytes()], pa.binary())})


def train(rows: DataFrame, words: Words, other: int) -> gru.Model:
    """Train on the rows that are not held out, in ``ROUNDS`` parts."""
    weights = gru.initial(np.concatenate([[other, words.ends], words.chosen]))
    for k in range(ROUNDS):
        shared = rows.sparkSession.sparkContext.broadcast(weights)

        def fit(batches):
            model, tokens = gru.Model(shared.value), 0
            seen = {name: np.full_like(v, 1e-6) for name, v in model.w.items()}
            for _, texts in _groups(batches):
                model.train(texts, seen, RATE)
                tokens += sum(map(len, texts))
            if tokens:
                flat = gru.flatten(model.w).astype("<f4")
                cuts = range(0, len(flat), CHUNK)
                yield pa.record_batch({"chunk": pa.array([c // CHUNK for c in cuts], pa.int32()), "tokens": pa.array([tokens] * len(cuts), pa.int64()),
                                       "weights": pa.array([flat[c:c + CHUNK].tobytes() for c in cuts], pa.binary())})

        part = rows.where(~F.col("held_out") & (F.pmod(F.xxhash64("row"), F.lit(ROUNDS)) == k))
        means = part.select("numbers").mapInArrow(fit, "chunk int, tokens long, weights binary").groupBy("chunk").applyInArrow(
            _mean, "chunk int, weights binary").collect()  # one model
        if means:
            flat = np.concatenate([np.frombuffer(r["weights"], "<f4") for r in sorted(means, key=lambda r: r["chunk"])])
            weights = gru.unflatten(flat, weights)
    return gru.Model(weights)


def log_likelihood(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known,
    train_tokens, base_score, score."""
    counts = stage(word_counts(docs.where(~held_out(docs))), "lm-counts")
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    words = frequent(counts, n)
    rows = stage(encoded(docs, words), "lm-rows")
    others, kinds = n - words.ends - int(words.chosen.sum()), v - len(words.chosen) - (1 if words.ends else 0)
    shared = docs.sparkSession.sparkContext.broadcast(train(rows, words, others))
    rare = rare_sums(rows, counts)

    narrow = [f for f in rows.schema.fields if f.name not in ("numbers", "rare")]

    def score(batches):
        for held, texts in _groups(batches):
            part = pa.Table.from_batches(held).select([f.name for f in narrow])
            part = part.append_column("model", pa.array(shared.value.score(texts)))
            part = part.append_column("others", pa.array([int((t == gru.OTHER).sum()) for t in texts], pa.int64()))
            yield from part.to_batches()

    schema = T.StructType([*narrow, T.StructField("model", T.DoubleType()), T.StructField("others", T.LongType())])
    out = rows.drop("rare").mapInArrow(score, schema).join(rare, F.col("row") == F.col("of"), "left")
    rare_log = F.coalesce("rare_log", F.lit(0.0))
    return out.select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("log_all") + rare_log - F.col("n_tokens") * float(np.log10(n + 0.5 * (v + 1)))).alias("base_score"),
        (F.col("model") + F.col("log_other") + rare_log - F.col("others") * float(np.log10(others + 0.5 * (kinds + 1)))).alias("score"))
