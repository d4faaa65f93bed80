"""Toxicity by weak supervision: many lexicon and pattern voters, a generative
label model of their accuracies and correlations, and a linear classifier
trained on the label model's posteriors.

1. Terms (words, and word beginnings of 4, 5 and 6 bytes) that labelled toxic
   texts hold more often than labelled clean ones are mined from a bounded
   sample of labelled rows, by the likelihood-ratio statistic alone.
2. The terms are dealt to lexicons in turn, by falling strength; each lexicon
   is a voter, and so is each pattern (shouting, runs of marks, masked words).
3. The label model is a two-class mixture: each voter has its rate of votes
   among toxic and among clean texts, found by expectation-maximisation over
   the votes on *all* documents that may be learned from (labels only start
   it).  Voters that agree more than their class explains are correlated; each
   voter's evidence counts in proportion to what it adds to the others.
4. Logistic regression over terms and patterns learns the posteriors of a
   bounded sample, and scores every whole text.

Null texts count as empty and get a score like every other text.  Without
labels of both classes every text scores 0.  Copies score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.blocks import LETTER_BYTE, mix64, per_text, slices
from campo.llm.common import remainder, stage, text_of
from campo.llm.linear import sigmoid

SAMPLE_PER_CLASS = 6000   #: bound on the labelled texts of a class
MIN_STATISTIC, MIN_TEXTS, MIN_LIFT = 20.0, 3, 4.0
PREFIXES = (4, 5, 6)
LEXICONS = 12
ROUNDS = 6                #: EM rounds of the label model
STEPS = 400               #: gradient steps of the classifier
TOXIC_AT = 0.7
PATTERNS = ("shouting", "marks", "masked")


def term_hashes(block) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term): text number and term hash.  A word and a word
    beginning of the same letters are different terms."""
    starts, ends, words = block.spans(LETTER_BYTE)
    text = per_text(words)
    parts_t, parts_h = [text], [block.hashes(starts, ends, fold=True)]
    for n in PREFIXES:
        on = np.flatnonzero(ends - starts > n)
        parts_t.append(text[on])
        parts_h.append(mix64(block.hashes(starts[on], starts[on] + n, fold=True) + np.uint64(n)))
    return np.concatenate(parts_t), np.concatenate(parts_h)


def distinct(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    _, first = np.unique(mix64(term + mix64(text.astype(np.uint64))), return_index=True)
    return text[first], term[first]


def pattern_votes(block) -> np.ndarray:
    """n x 3: half of the letters in capitals; a run of three marks; a mark
    inside a word."""
    data, at = block.data, block.offsets
    upper = (data >= 65) & (data <= 90)
    lower = (data >= 97) & (data <= 122)
    bang = (data == 33) | (data == 63)
    star = (data == 42) | (data == 35) | (data == 36) | (data == 64)
    alpha = upper | lower
    sums = lambda x: (lambda c: c[at[1:]] - c[at[:-1]])(np.concatenate([[0], np.cumsum(x)]))
    shout = (sums(upper) * 2 > sums(alpha)) & (sums(alpha) > 0)
    run, mask = np.zeros(len(data), bool), np.zeros(len(data), bool)
    if len(data) > 2:
        run[2:] = bang[2:] & bang[1:-1] & bang[:-2]
        mask[1:-1] = star[1:-1] & alpha[:-2] & (alpha[2:] | star[2:])
    return np.stack([shout, sums(run) > 0, sums(mask) > 0], axis=1)


class Terms:
    """Mined terms and the lexicon of each."""

    def __init__(self, hashes: np.ndarray, lexicon: np.ndarray):
        order = np.argsort(hashes)
        self.hashes, self.lexicon = hashes[order], lexicon[order]
        self.voters = LEXICONS + len(PATTERNS)

    def hits(self, block) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, term number)."""
        text, term = term_hashes(block)
        if not len(self.hashes) or not len(term):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, term), len(self.hashes) - 1)
        on = self.hashes[at] == term
        pairs = np.unique(text[on] * len(self.hashes) + at[on])
        return pairs // len(self.hashes), pairs % len(self.hashes)

    def votes(self, block) -> np.ndarray:
        text, term = self.hits(block)
        out = np.zeros((block.n, self.voters), bool)
        out[text, self.lexicon[term]] = True
        out[:, LEXICONS:] = pattern_votes(block)
        return out


def learnable(docs: DataFrame):
    return remainder(docs, 3) != 1


def labelled_sample(docs: DataFrame, labels: DataFrame, per_class: int) -> DataFrame:
    """Texts with their label: at most ``per_class`` of a class,
    those with the least hash of doc_id."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").where(learnable(labels))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("label"))
    order = F.xxhash64("doc_id", F.lit(11))
    picked = [known.where(F.col("label") == v).orderBy(order, "doc_id").limit(per_class) for v in (0, 1)]
    picked = picked[0].union(picked[1]).select(F.col("doc_id").alias("of"), F.col("label").cast("int").alias("label"))
    texts = docs.select(docs["doc_id"].alias("doc"), text_of(docs).alias("text"))
    return texts.join(F.broadcast(picked), F.col("doc") == F.col("of")).select("text", "label")  # 2 * per_class narrow rows


def mine(sample: DataFrame) -> Terms | None:
    """Terms by the likelihood-ratio statistic of their document counts."""
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = sizes.get(0, 0), sizes.get(1, 0)
    if not n0 or not n1:
        return None

    def count(batches):
        for part, block in slices(batches):
            text, term = distinct(*term_hashes(block))
            toxic = part.column("label").to_numpy()[text] == 1
            kinds, place = np.unique(term, return_inverse=True)
            yield pa.record_batch({"term": pa.array(kinds.view(np.int64)), "a": np.bincount(place, toxic, len(kinds)).astype(np.int64),
                                   "b": np.bincount(place, ~toxic, len(kinds)).astype(np.int64)})

    counts = sample.mapInArrow(count, "term long, a long, b long").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    share = (a + b) / float(n0 + n1)
    part = lambda x, n: F.when(x > 0, x * F.log(x / (share * float(n)))).otherwise(0.0)
    strength = 2 * (part(a, n1) + part(b, n0))
    best = counts.where((a >= MIN_TEXTS) & (a / n1 >= MIN_LIFT * (b + 0.5) / n0)).withColumn("g", strength).where(F.col("g") >= MIN_STATISTIC)
    best = sorted(best.select("term", "g").collect(), key=lambda r: (-r["g"], r["term"]))  # terms of a bounded sample
    hashes = np.array([r["term"] for r in best], np.int64).view(np.uint64)
    return Terms(hashes, np.arange(len(hashes)) % LEXICONS)


class LabelModel:
    """Two-class mixture over voters; ``share`` weighs correlated evidence."""

    def __init__(self, prior: float, toxic: np.ndarray, clean: np.ndarray, share: np.ndarray):
        self.prior, self.toxic, self.clean, self.share = prior, toxic, clean, share

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        yes, no = np.log(self.toxic / self.clean), np.log((1 - self.toxic) / (1 - self.clean))
        return sigmoid(np.log(self.prior / (1 - self.prior)) + np.where(votes, yes, no) @ self.share)


def _rates(hit: np.ndarray, n: float) -> np.ndarray:
    return np.clip((hit + 0.5) / (n + 1.0), 1e-4, 1 - 1e-4)


def _unpack(words: np.ndarray, voters: int) -> np.ndarray:
    return (words[:, None] >> np.arange(voters)) & 1 > 0


def fit_label_model(patterns: DataFrame, started: DataFrame, voters: int) -> LabelModel:
    """EM over all vote patterns (votes, n); starts from the labelled texts'
    patterns (votes, label, n)."""
    def sums(frame: DataFrame, weight) -> np.ndarray:
        """Per class: total, votes of each voter, joint votes of each two."""
        def run(batches):
            out = np.zeros((2, 1 + voters + voters * voters))
            for batch in batches:
                v = _unpack(batch.column("votes").to_numpy(), voters).astype(float)
                n, p = batch.column("n").to_numpy().astype(float), weight(batch)
                for c, w in enumerate((n * (1 - p), n * p)):
                    out[c, 0] += w.sum()
                    out[c, 1:1 + voters] += w @ v
                    out[c, 1 + voters:] += ((v * w[:, None]).T @ v).ravel()
            yield pa.record_batch({"k": np.arange(out.size), "x": out.ravel()})

        rows = frame.mapInArrow(run, "k long, x double").groupBy("k").agg(F.sum("x").alias("x")).collect()  # fixed size
        out = np.zeros(2 * (1 + voters + voters * voters))
        for r in rows:
            out[r["k"]] = r["x"]
        return out.reshape(2, -1)

    def model_of(s: np.ndarray, share: np.ndarray) -> LabelModel:
        prior = float(np.clip(s[1, 0] / max(s[:, 0].sum(), 1), 1e-3, 1 - 1e-3))
        return LabelModel(prior, _rates(s[1, 1:1 + voters], s[1, 0]), _rates(s[0, 1:1 + voters], s[0, 0]), share)

    def shares(s: np.ndarray) -> np.ndarray:
        excess = np.zeros((voters, voters))
        for c in (0, 1):
            n = max(s[c, 0], 1)
            mean, joint = s[c, 1:1 + voters] / n, s[c, 1 + voters:].reshape(voters, voters) / n
            spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-9))
            excess += np.clip((joint - np.outer(mean, mean)) / np.outer(spread, spread), 0, 1) * (n / s[:, 0].sum())
        np.fill_diagonal(excess, 0)
        return 1 / (1 + excess.sum(axis=1))

    first = sums(started, lambda b: b.column("label").to_numpy().astype(float))
    model = model_of(first, shares(first))
    for _ in range(ROUNDS):
        fixed = model
        s = sums(patterns, lambda b: fixed.posterior(_unpack(b.column("votes").to_numpy(), voters)))
        model = model_of(s, shares(s))
    return model


class Classifier:
    def __init__(self, terms: Terms, weights: np.ndarray, marks: np.ndarray, bias: float):
        self.terms, self.weights, self.marks, self.bias = terms, weights, marks, bias

    def score(self, block) -> np.ndarray:
        text, term = self.terms.hits(block)
        return sigmoid(self.bias + pattern_votes(block) @ self.marks + np.bincount(text, self.weights[term], block.n))


def _votes(frame: DataFrame, terms, extra: str | None = None) -> DataFrame:
    """Vote bits of each text, counted by pattern (and ``extra``)."""
    def run(batches):
        for part, block in slices(batches):
            bits = terms.value.votes(block) @ (1 << np.arange(terms.value.voters))
            names = {"votes": bits.astype(np.int64)}
            if extra:
                names[extra] = part.column(extra)
            yield pa.record_batch(names)

    keys = ["votes", *([extra] if extra else [])]
    return frame.mapInArrow(run, "votes long" + (f", {extra} int" if extra else "")).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def train(docs: DataFrame, labels: DataFrame, per_class: int = SAMPLE_PER_CLASS) -> Classifier | None:
    spark = docs.sparkSession
    sample = stage(labelled_sample(docs, labels, per_class), "toxic-sample")
    terms = mine(sample)
    if terms is None:
        return None
    shared = spark.sparkContext.broadcast(terms)
    allowed = docs.where(learnable(docs)).select(text_of(docs).alias("text"))
    model = fit_label_model(stage(_votes(allowed, shared), "toxic-votes"), stage(_votes(sample, shared, "label"), "toxic-start"), terms.voters)

    def feature_rows(batches):
        for part, block in slices(batches):
            text, term = shared.value.hits(block)
            cut = np.searchsorted(text, np.arange(block.n + 1))
            yield pa.record_batch({"p": model.posterior(shared.value.votes(block)), "marks": pa.array(pattern_votes(block).astype(int).tolist(), pa.list_(pa.int32())),
                                   "terms": pa.array([term[a:b].tolist() for a, b in zip(cut, cut[1:])], pa.list_(pa.int32()))})

    rows = sample.mapInArrow(feature_rows, "p double, marks array<int>, terms array<int>").collect()  # bounded sample, narrow
    rows.sort(key=lambda r: (r["p"], r["marks"], r["terms"]))
    p, marks = np.array([r["p"] for r in rows]), np.array([r["marks"] for r in rows], float)
    text = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
    term = np.array([t for r in rows for t in r["terms"]], np.int64)
    w, m, bias = np.zeros(max(1, len(terms.hashes))), np.zeros(len(PATTERNS)), 0.0
    seen = [np.full_like(w, 1e-8), np.full_like(m, 1e-8), 1e-8]
    for _ in range(STEPS):
        error = (sigmoid(bias + marks @ m + np.bincount(text, w[term], len(rows))) - p) / len(rows)
        gw, gm, gb = np.bincount(term, error[text], len(w)) + 2e-5 * w, error @ marks + 2e-5 * m, error.sum()
        seen = [seen[0] + gw * gw, seen[1] + gm * gm, seen[2] + gb * gb]
        w, m, bias = w - 0.3 * gw / np.sqrt(seen[0]), m - 0.3 * gm / np.sqrt(seen[1]), bias - 0.3 * gb / np.sqrt(seen[2])
    return Classifier(terms, w, m, float(bias))


def scored(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """doc_id, held_out, score and predicted of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for part, block in slices(batches):
            score = shared.value.score(block) if shared.value else np.zeros(block.n)
            yield pa.record_batch({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "score": score, "predicted": (score >= TOXIC_AT).astype(np.int32)})

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("score", T.DoubleType()),
                           T.StructField("predicted", T.IntegerType())])
    return docs.select(docs["doc_id"].alias("doc_id"), (~learnable(docs)).alias("held_out"), text_of(docs).alias("text")).mapInArrow(run, schema)
