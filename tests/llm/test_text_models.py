"""Quality, language id, toxicity and language-model scoring."""

import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from campo.llm import gru, langid, lm, quality, toxicity
from campo.llm.blocks import text_block
from tests.llm.conftest import SF_MID, SF_SMALL, table

WORD = r"[^\x20\x09-\x0D]+"
FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_counts(text):
    words = re.findall(WORD, text)
    grams = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often, marked = Counter(grams), set()
    for k, g in enumerate(grams):
        if often[g] > 1:
            marked |= {k, k + 1, k + 2}
    lines = [x for x in text.split("\n") if re.search(WORD, x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(marked))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \n\t#é日", max_size=60), min_size=1, max_size=5))
def test_quality_counts(texts):
    import pyarrow as pa
    got = quality.base_counts(text_block(pa.array(texts, pa.string())))
    rows = list(zip(*(got[k].tolist() for k in quality.COUNTS)))
    assert rows == [brute_counts(t) for t in texts]


def test_quality_on_odd_rows(spark, odd, none):
    empty = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for labels in (empty, spark.createDataFrame([(6, 1, 0), (15, 0, 0), (15, 0, 1), (9, 1, 0), (None, 1, None)], empty.schema)):
        rows = quality.annotate(odd, quality.train(odd, labels)).collect()
        want = sorted(((r["doc_id"], brute_counts(r["text"] or "")) for r in odd.collect()), key=repr)
        assert sorted(((r["doc_id"], tuple(r[k] for k in quality.COUNTS)) for r in rows), key=repr) == want
        for r in rows:
            failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
            assert r["base_failed"] == failed and not (failed and r["kept"])
    assert quality.accepted(odd, None).columns == odd.columns
    assert quality.annotate(none, None).collect() == []
    assert quality.train(none, empty) is None


def test_quality_held_out(spark):
    """Trained without every fifth labelled text, judged on those."""
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    model = quality.train(docs, labels.where("doc_id % 5 <> 0"))
    met = quality.annotate(docs, model).join(labels.where("doc_id % 5 = 0"), "doc_id").where("not base_failed").collect()
    good = [r["kept"] for r in met if r["quality"] is not None and r["kept"] is not None and r["toxic"] is not None]
    assert good
    truth = {r["doc_id"]: r["quality"] for r in labels.collect()}
    right = sum(r["kept"] == (truth[r["doc_id"]] == 1) for r in met)
    assert right >= 0.95 * len(met)


def test_language_held_out(spark, vocabularies):
    docs = table(spark, SF_SMALL, "documents")
    model = langid.train(docs.where(~langid.held_out(docs)), f"{vocabularies}/piece_bpe_32k.model", 60)
    rows = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_on_odd_rows(spark, odd, none, vocabularies):
    path = f"{vocabularies}/piece_bpe_32k.model"
    rows = langid.predict(odd, langid.train(odd, path, 5)).collect()
    assert len(rows) == odd.count()
    texts = {r["doc_id"]: r["text"] for r in odd.where("doc_id is not null").collect()}
    for r in rows:
        if r["doc_id"] in (3, 4, 5):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif r["doc_id"] is not None and re.search("[a-z]", texts[r["doc_id"]] or ""):
            assert r["lang_pred"] in ("en", "fr", "de", "es")
    assert langid.train(none, path) is None
    assert {r["lang_pred"] for r in langid.predict(odd, None).collect()} == {"und"}


def test_forward_sums_all_segmentations():
    pieces = [b"a", b"b", b" ", b"ab", b" a", b" ab", b"aba"]
    rng = np.random.default_rng(0)
    p = rng.random((len(pieces), 2))
    model = langid.Model(["x", "y"], pieces, np.vstack([p, np.zeros(2)]))
    prob = dict(zip(pieces, p))

    def brute(word):
        if not word:
            return np.ones(2)
        return sum((prob[word[:k]] * brute(word[k:]) for k in range(1, min(3, len(word)) + 1) if word[:k] in prob), np.zeros(2))

    for word in (b"a", b"ab", b"abab", b"bbaaba"):
        got = model.word_scores(np.frombuffer(word, np.uint8), np.array([0]), np.array([len(word)]))[0]
        assert np.allclose(got, np.log(brute(b" " + word)))


def test_long_runs_and_pieces_are_summed_whole():
    """Sums go over every cut of a run of any length, pieces of 25 bytes too."""
    long = b"abcdefghijklmnopqrstuvwxy"
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b" ab", "é".encode(), long]
    p = np.random.default_rng(1).random((len(pieces), 2)) * 1e-3
    p[-1] = 0.5, 0.01
    model = langid.Model(["x", "y"], pieces, np.vstack([p, np.zeros(2)]))
    prob = dict(zip(pieces, p))

    def direct(word):
        out, scale = [np.ones(2)], np.zeros(2)
        for j in range(1, len(word) + 1):
            out.append(sum((out[-k] * prob[word[j - k:j]] for k in range(1, min(25, j) + 1) if word[j - k:j] in prob), np.zeros(2)))
            scale += np.log(out[-1])
            out = [o / out[-1] for o in out[-25:]]
        return scale

    for word in (b"ab" * 11 + b"a", b"x" * 23 + b"ab", b"ab" * 60, "é".encode() * 40, b"q" * 20 + long + b"z" * 9 + long, b"x" * 1000):
        raw = np.frombuffer(word + b"ab", np.uint8)
        got = model.word_scores(raw, np.array([0, len(word)]), np.array([len(word), len(word) + 2]))
        assert np.allclose(got, [direct(b" " + word), direct(b" ab")])


def test_sums_of_many_words_side_by_side():
    """Words of all lengths in small windows score as each does alone."""
    rng = np.random.default_rng(2)
    pieces = [bytes([b]) for b in range(256)] + [b"ab", b"ba", b" ab", b"abab", b"bbbbbbb"]
    model = langid.Model(["x", "y"], pieces, np.vstack([rng.random((len(pieces), 2)) * 1e-2, np.zeros(2)]))
    words = [bytes(rng.choice([97, 98], int(n)).astype(np.uint8)) for n in [*rng.integers(1, 90, 80), 1, 24, 25, 47, 48, 400]]
    ends = np.cumsum([len(w) for w in words])
    starts, data = ends - [len(w) for w in words], np.frombuffer(b"".join(words), np.uint8)
    alone = [model.word_scores(data, starts[i:i + 1], ends[i:i + 1])[0] for i in range(len(words))]
    cells, langid.CELLS = langid.CELLS, 1
    try:
        assert np.allclose(model.word_scores(data, starts, ends), alone)
        assert np.allclose(model.word_scores(data, starts[-1:], ends[-1:]), alone[-1:])
    finally:
        langid.CELLS = cells


def test_runs_end_at_what_is_no_letter(spark):
    texts = ["日本語。日本「語」", "don’t — stop", "ÀB1c", "ไทย ๆ๑", "e\u0301a", "", "…!"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select(langid.letters_of(F.col("text"))).collect()
    assert [r[0].split() for r in rows] == [["日本語", "日本", "語"], ["don", "t", "stop"], ["àb", "c"], ["ไทย", "ๆ"], ["e\u0301a"], [], []]


def test_language_vocabulary_and_parts(vocabularies):
    import pyarrow as pa
    assert max(map(len, langid.vocabulary(f"{vocabularies}/piece_bpe_32k.model"))) > 10
    texts = ["日本語" * 20, "ab " + "x" * 60, "", "word"]
    block = text_block(pa.array(texts))
    starts, ends, parts, begins = langid._parts(block)
    raw = block.data.tobytes()
    each = [raw[a:b].decode() for a, b in zip(starts, ends)]
    assert "".join(each) == "".join(texts).replace(" ", "") and begins.sum() == 4
    assert parts.tolist() == [8, 4, 0, 1] and max(len(e.encode()) for e in each) <= 27


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF_MID, "documents"), table(spark, SF_MID, "labels")
    rows = toxicity.scored(docs, toxicity.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    caught = [r["predicted"] for r in rows if r["toxic"] == 1]
    wrong = [r["predicted"] for r in rows if r["toxic"] == 0]
    assert sum(wrong) <= 0.02 * len(wrong) and sum(caught) >= 0.6 * len(caught)
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def test_toxicity_on_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (6, 1, 1), (None, 0, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    rows = toxicity.scored(odd, toxicity.train(odd, labels)).collect()
    assert len(rows) == odd.count() and all(0 <= r["score"] <= 1 for r in rows)
    assert toxicity.train(none, labels) is None
    assert all(r["score"] == 0 for r in toxicity.scored(odd, None).collect())


def test_every_strong_term_is_kept(spark):
    names = ["".join(chr(97 + k // 26 ** d % 26) for d in range(4)) + "xyzw" for k in range(1500)]
    texts = [(" ".join(names), 1)] * 30 + [("a good day", 0)] * 30
    terms = toxicity.mine(spark.createDataFrame(texts, "text string, label int"))
    assert len(terms.hashes) == 4 * len(names)
    assert np.bincount(terms.lexicon).tolist() == [500] * toxicity.LEXICONS


def test_label_model_discounts_copies_of_a_voter(spark):
    """Two voters that always agree count less than two that don't."""
    rng = np.random.default_rng(2)
    y = rng.random(4000) < 0.3
    vote = lambda: np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.1)
    a, b, c = vote(), vote(), vote()
    bits = a + 2 * a + 4 * b + 8 * c
    rows = [(int(v), int(n)) for v, n in Counter(bits.tolist()).items()]
    seen = [(int(v), int(t), int(n)) for (v, t), n in Counter(zip(bits[:400].tolist(), y[:400].tolist())).items()]
    model = toxicity.fit_label_model(spark.createDataFrame(rows, "votes long, n long"),
                                     spark.createDataFrame(seen, "votes long, label int, n long"), 4)
    assert model.share[0] < 0.65 < 0.8 < model.share[2]
    p = model.posterior(toxicity._unpack(bits, 4))
    assert ((p > 0.5) == y).mean() > 0.85


def brute_base(rows):
    held = lambda i: __import__("zlib").crc32(("" if i is None else str(i)).encode()) % 5 == 1
    tokens = [[*re.findall(WORD, (t or "").translate(FOLD)), None] for _, t in rows]
    counts = Counter(w for (i, _), ts in zip(rows, tokens) if not held(i) for w in ts)
    n, v = sum(counts.values()), len(counts)
    return sorted(((i, held(i), len(ts), sum(counts[w] > 0 for w in ts), n,
                    round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ts), 6)) for (i, _), ts in zip(rows, tokens)), key=repr)


@pytest.mark.parametrize("frequent", [1 << 17, 40])
def test_base_score(spark, odd, none, monkeypatch, frequent):
    monkeypatch.setattr(lm, "FREQUENT", frequent)
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = lm.log_likelihood(odd).collect()
    assert sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6))
                   for r in got), key=repr) == brute_base(rows)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in got)
    assert lm.log_likelihood(none).collect() == []


def word_table(spark, counts):
    return spark.createDataFrame([(k, c) for k, c in enumerate(counts)] + [(lm.END, 7)], "word long, c long")


@pytest.mark.parametrize("counts", [
    [30_000 + k for k in range(300)],              # more than FREQUENT words above 20,000
    [5] * 300,                                     # more than FREQUENT words at the highest count
    [1 << 62, (1 << 40) + 1, 1 << 40] + [9] * 300, [3, 2, 1], [1 << k for k in range(60)], []])
def test_vocabulary_and_threshold(spark, monkeypatch, counts):
    monkeypatch.setattr(lm, "FREQUENT", 40)
    table = word_table(spark, counts)
    ordered = sorted([*counts, 7], reverse=True)
    least = lm.least_count(table)
    assert sum(c >= least for c in ordered) <= 40
    assert len(ordered) <= 40 or sum(c >= least - 1 for c in ordered) > 40
    n = sum(ordered)
    words = lm.frequent(table, n)
    top = sorted((k for k, c in enumerate(counts) if c >= 5 and c * 65_000 >= n), key=lambda k: (-counts[k], k))
    assert words.chosen.tolist() == [counts[k] for k in top]
    at, known = words.find(np.array(top, np.uint64))
    assert known.all() and (not top or words.number[at].tolist() == list(range(2, 2 + len(top))))
    assert words.ends == 7 and len(words.word) <= 41 + len(top)


def test_vocabulary_grows_with_the_counts(spark):
    """Words that occur often enough are all in the model, in about as many
    classes as each has words."""
    for kinds in (600, 6000):
        words = lm.frequent(word_table(spark, [30] * kinds + [4] * 50), 30 * kinds + 207)
        assert len(words.chosen) == kinds
        weights = gru.initial(np.concatenate([[200, words.ends], words.chosen]))
        each = np.diff(weights[gru.STARTS])
        assert each.sum() == kinds + 2 == len(weights["o"])
        assert abs(len(each) - 2 - kinds ** 0.5) < 2 and abs(each.max() - kinds ** 0.5) < 2
    assert len(lm.frequent(word_table(spark, [30] * 600), 65_000 * 30 + 1).chosen) == 0


def test_model_beats_counts_on_held_out(spark):
    rows = lm.log_likelihood(table(spark, SF_MID, "documents")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert rows[0] > rows[1]


def test_classes_of_frequent_words_are_small():
    counts = np.concatenate([[500, 90], 1_000_000 // np.arange(1, 3001)])
    starts = gru.class_starts(counts)
    each = np.diff(starts)
    assert starts[0] == 0 and starts[-1] == len(counts) and (each > 0).all() and each[:2].tolist() == [1, 1]
    assert each[2:12].max() < each[-10:].min()
    # outputs worked out a token: all classes, and the words of its own
    cost = len(each) + (counts[2:] * np.repeat(each, each)[2:]).sum() / counts[2:].sum()
    assert cost < 0.75 * 2 * len(counts) ** 0.5
    assert gru.class_starts(np.array([5, 3])).tolist() == [0, 1, 2]


def test_memory_does_not_follow_the_longest_text():
    """One very long text beside 2,000 short ones: a million words cut into
    windows, 100,000 scored."""
    rng = np.random.default_rng(1)
    texts = [np.append(rng.integers(0, 300, n), gru.END).astype(np.uint16) for n in [1_000_000] + [40] * 2000]
    model = gru.Model(gru.initial(np.arange(300, 0, -1)))
    tracemalloc.start()
    met = sum(int((text >= 0).sum()) for _, _, _, text, _ in model._windows(texts, 512, 32))
    assert met == sum(map(len, texts)) and tracemalloc.get_traced_memory()[1] < 100 << 20
    texts[0] = texts[0][-100_000:]
    tracemalloc.reset_peak()
    got = model.score(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20 and np.isfinite(got).all() and got[0] < got[1:].min()
    assert np.allclose(got[1:6], [model.score([t])[0] for t in texts[1:6]], rtol=1e-4)


def test_outputs_are_worked_out_in_cache_sized_runs():
    """A scoring window's outputs over all classes were held whole: 5.6 MB of
    16,384 words, each pass of them out of a core's cache."""
    rng = np.random.default_rng(2)
    counts = np.sort(rng.integers(1, 50, 6000))[::-1]
    model = gru.Model(gru.initial(counts))
    model.w["o"] += rng.standard_normal(model.w["o"].shape).astype(np.float32)
    model.w["u"] += rng.standard_normal(model.w["u"].shape).astype(np.float32)
    states = rng.standard_normal((32, 512, gru.HIDDEN)).astype(np.float32)
    goal = rng.integers(0, 6000, (32, 512))
    tracemalloc.start()
    got, _ = model._outputs(states, goal)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4.5e6
    # against plain sums of some words
    w, cls = model.w, gru.class_of(model.starts)
    for t, b in zip(rng.integers(0, 32, 50), rng.integers(0, 512, 50)):
        h, k = states[t, b].astype(float), goal[t, b]
        part = slice(*model.starts[cls[k]:cls[k] + 2])
        over, inside = h @ w["u"] + w["bu"], w["o"][part] @ h + w["bo"][part]
        plain = over[cls[k]] - np.log(np.exp(over).sum()) + inside[k - part.start] - np.log(np.exp(inside).sum())
        assert abs(got[t, b] - plain) < 1e-3


def test_gradients_against_differences():
    """One training step goes down the slope of the score, for every kind of weight."""
    rng = np.random.default_rng(4)
    counts = np.sort(rng.integers(1, 50, 40))[::-1]
    texts = [np.append(rng.integers(0, 40, gru.TRAIN_WINDOW - 1), gru.END) for _ in range(5)]  # one full window
    start = gru.initial(counts)
    for k in ("u", "o"):
        start[k] = (rng.standard_normal(start[k].shape) * 0.5).astype(np.float32)
    seen = {k: np.full_like(v, 1e12) for k, v in start.items() if k != gru.STARTS}
    model = gru.Model(start)
    model.train(texts, seen, 1e6)  # a step of the mean gradient itself
    for k in seen:
        moved = (model.w[k] - start[k]).astype(float)
        way = moved / np.linalg.norm(moved)
        scores = []
        for side in (1, -1):
            there = dict(start)
            there[k] = (start[k] + side * 0.01 * way).astype(np.float32)
            scores.append(gru.Model(there).score(texts).sum() * np.log(10))
        assert np.isclose((scores[0] - scores[1]) / 0.02, np.linalg.norm(moved) * sum(map(len, texts)), rtol=0.05), k


def test_row_max():
    rng = np.random.default_rng(3)
    for shape in ((1, 1), (5, 1), (1, 7), (300, 58)):
        x = rng.standard_normal(shape).astype(np.float32)
        assert np.array_equal(gru._row_max(x), x.max(axis=1, keepdims=True))


def test_gru_gradients_and_lanes():
    rng = np.random.default_rng(0)
    counts = rng.integers(1, 50, 70)
    texts = [rng.integers(0, 70, n) for n in (5, 1, 12, 3, 40)]
    texts = [np.append(t, gru.END) for t in texts]
    model = gru.Model(gru.initial(counts))
    each = np.array([model.score([t])[0] for t in texts])
    assert np.allclose(model.score(texts), each, rtol=1e-4)
    # the class-factored output sums to one
    states = rng.standard_normal((1, 1, gru.HIDDEN)).astype(np.float32)
    total = sum(np.exp(model._outputs(states, np.array([[k]]))[0][0, 0]) for k in range(70))
    assert abs(total - 1) < 1e-4
    before = model.score(texts).sum()
    seen = {k: np.full_like(v, 1e-6) for k, v in model.w.items()}
    for _ in range(30):
        model.train(texts, seen, 0.05)
    assert model.score(texts).sum() > before
