"""Language id by unigram piece models, marginalised over all segmentations.

The pieces are those of a fixed public vocabulary plus every single byte.  Each
language has a probability for each piece; a word's probability is the sum over
all ways to cut it into pieces, from a forward pass over its bytes; the sums are
carried on from window to window of a long run of letters.  Runs end at every
code point that is no letter or mark, of any script, so that text without
spaces is cut at its punctuation.  The probabilities are
fitted by expectation-maximisation (forward and backward passes) on the words
of a bounded sample of each language's documents; there alone, a run of more
than ``BLOCK`` bytes is taken in parts, cut between characters.  A
document goes to the language under which its words are most probable, and its
score is that language's posterior with equal priors.

Null texts and texts without a letter get ``und`` with score 0, as does every
text if there is nothing to learn from.  Copies of a text score alike.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from campo.llm.blocks import LETTER_BYTE, mix64, slices
from campo.llm.common import remainder, stage, text_of

SAMPLE_PER_LANGUAGE = 400   #: documents of a language to learn from, about
ROUNDS = 3                  #: EM rounds
BLOCK = 24                  #: bytes of a run of letters summed before the sums are scaled
LANES = 4000                #: runs of letters summed side by side
CELLS = 100_000             #: positions of runs whose pieces are looked up at once, about
SMOOTHING = 0.02            #: expected count given to every piece
KEPT_WORDS = 400_000        #: scored words a worker keeps
_STEP = np.uint64(0x9E3779B97F4A7C15)


def letters_of(text: Column) -> Column:
    """The text in lower case, one space for each stretch of anything but
    letters and the marks that belong to them."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")


def vocabulary(path: str) -> list[bytes]:
    """Pieces of letters, with a leading space where they start a word, and
    all single bytes."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {bytes([b]) for b in range(256)}
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_byte(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i).replace("▁", " ")
        raw = piece.lower().encode()
        if raw.strip() and all(LETTER_BYTE[b] for b in raw.lstrip()) and raw.count(b" ") <= 1:
            out.add(raw)
    return sorted(out)


def _matrix(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Words as rows of bytes, and their lengths."""
    size = np.array([len(w) for w in words])
    rows = np.zeros((len(words), int(size.max(initial=0))), np.uint8)
    rows[np.arange(rows.shape[1]) < size[:, None]] = np.frombuffer(b"".join(words), np.uint8)
    return rows, size


class Lattice:
    """Piece numbers of all substrings of words: ``piece[k - 1][:, j]`` is that
    of the ``k`` bytes before position ``j``, or -1."""

    def __init__(self, rows: np.ndarray, hashes: np.ndarray, numbers: np.ndarray, longest: int):
        n, width = rows.shape
        codes = mix64(rows.astype(np.uint64) + _STEP)
        self.piece, rolled = [], None
        for k in range(1, min(longest, width) + 1):
            # hash of k bytes: that of k - 1 bytes, and one more
            last = codes[:, k - 1:]
            rolled = mix64(last) if rolled is None else mix64(rolled[:, :-1] * _STEP + last)
            at = np.minimum(np.searchsorted(hashes, rolled), len(hashes) - 1)
            found = np.full((n, width + 1), -1, np.int32)
            found[:, k:] = np.where(hashes[at] == rolled, numbers[at], -1)
            self.piece.append(found)

    def forward(self, table: np.ndarray, start: np.ndarray | None = None) -> np.ndarray:
        """Sums over segmentations up to each position; ``table`` has a row of
        probabilities by language for each piece, and a last row of zeros.
        ``start`` has the sums at the first positions (default: 1 at the first)."""
        n, width = self.piece[0].shape
        out = np.zeros((width, n, table.shape[1]))
        first = 1 if start is None else len(start)
        out[:first] = 1 if start is None else start
        for j in range(first, width):
            for k in range(1, min(j, len(self.piece)) + 1):
                number = self.piece[k - 1][:, j]
                on = np.flatnonzero(number >= 0)
                out[j, on] += out[j - k, on] * table[number[on]]
        return out

    def backward(self, table: np.ndarray, size: np.ndarray) -> np.ndarray:
        n, width = self.piece[0].shape
        out = np.zeros((width, n, table.shape[1]))
        out[size, np.arange(n)] = 1
        for j in range(width - 1, 0, -1):
            for k in range(1, min(j, len(self.piece)) + 1):
                number = self.piece[k - 1][:, j]
                on = np.flatnonzero(number >= 0)
                out[j - k, on] += out[j, on] * table[number[on]]
        return out


def piece_hashes(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the pieces (as :class:`Lattice` rolls them) and their numbers."""
    out = np.zeros(len(pieces), np.uint64)
    for size in sorted({len(p) for p in pieces}):
        on = [i for i, p in enumerate(pieces) if len(p) == size]
        codes = mix64(np.frombuffer(b"".join(pieces[i] for i in on), np.uint8).reshape(-1, size).astype(np.uint64) + _STEP)
        rolled = mix64(codes[:, 0])
        for k in range(1, size):
            rolled = mix64(rolled * _STEP + codes[:, k])
        out[on] = rolled
    order = np.argsort(out)
    return out[order], order.astype(np.int32)


class Trie:
    """Pieces as a tree of bytes: sorted keys (256 * node + byte), the node each
    leads to, and the piece that ends there, or -1."""

    def __init__(self, pieces: list[bytes]):
        child, piece = {}, [-1]
        for number, raw in enumerate(pieces):
            node = 0
            for byte in raw:
                key = 256 * node + byte
                if key not in child:
                    child[key] = len(piece)
                    piece.append(-1)
                node = child[key]
            piece[node] = number
        self.keys = np.array(sorted(child), np.int64)
        self.child = np.array([child[k] for k in self.keys.tolist()], np.int32)
        self.piece = np.array(piece, np.int32)

    def edges(self, data, starts, size, first, done, stop):
        """The pieces found in words (``size`` bytes with a leading space) that
        begin at ``first`` or later and end after ``done`` and at ``stop`` at
        most, by end and word: ends, words, begins, pieces, and where the edges
        of each end begin.  Only starts where a piece can go on are followed."""
        width = np.maximum(np.minimum(size, stop) - first, 0)
        word = np.repeat(np.arange(len(starts)), width)
        at = first + np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        byte = np.where(at == 0, np.uint8(32), data[np.repeat(starts, width) + np.maximum(at, 1) - 1])
        until = np.cumsum(width)[word]  # cell after the word's last
        cell, node, found = np.arange(len(byte)), np.zeros(len(byte), np.int64), []
        length = 0
        while len(cell):
            key = 256 * node + byte[cell + length]
            place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            on = np.flatnonzero(self.keys[place] == key)
            cell, node, length = cell[on], self.child[place[on]].astype(np.int64), length + 1
            ends = (self.piece[node] >= 0) & (at[cell] + length > done)
            found.append((at[cell[ends]] + length, word[cell[ends]], at[cell[ends]], self.piece[node[ends]]))
            on = np.flatnonzero(cell + length < until[cell])
            cell, node = cell[on], node[on]
        ends, rows, begins, pieces = (np.concatenate(x) for x in zip(*found)) if found else (np.empty(0, np.int64),) * 4
        order = np.argsort(ends * (len(starts) + 1) + rows, kind="stable")
        ends, rows, begins, pieces = ends[order], rows[order], begins[order], pieces[order]
        return ends, rows, begins, pieces, np.searchsorted(ends, np.arange(done + 1, stop + 2))


class Model:
    def __init__(self, languages: list[str], pieces: list[bytes], table: np.ndarray):
        self.languages, self.table = languages, table
        self.pieces = Trie(pieces)
        self.longest = max(map(len, pieces))
        self.known = np.empty(0, np.uint64)
        self.scores = np.empty((0, len(languages)))

    def word_scores(self, data, starts, ends) -> np.ndarray:
        """Log-probability of words by language."""
        size = ends - starts + 1
        out = np.empty((len(starts), len(self.languages)))
        order = np.argsort(size, kind="stable")
        for part in np.array_split(order, max(1, len(order) // LANES)):
            if len(part):
                out[part] = self._sums(data, starts[part], size[part])
        return out

    def _sums(self, data, starts, size) -> np.ndarray:
        """Log-probability of words side by side, shorter ones first, window by
        window: the sums at the last positions are carried to the next, and are
        scaled to 1 every ``BLOCK`` positions."""
        out = np.empty((len(starts), len(self.languages)))
        scale, live, done = np.zeros_like(out), np.arange(len(starts)), 0
        sums = np.ones((1, len(starts), len(self.languages)))  # at positions up to done
        while len(live):
            stop = min(int(size[live].max()), done + max(2 * BLOCK, CELLS // len(live)))
            first = done - len(sums) + 1  # position of the sums' first row
            ends, rows, begins, pieces, cuts = self.pieces.edges(data, starts[live], size[live], first, done, stop)
            ahead = np.zeros((stop - first + 1, len(live), len(self.languages)))
            ahead[:len(sums)] = sums
            over = np.searchsorted(size[live], np.arange(first, stop + 1))  # lanes that ended before a position
            group = np.flatnonzero(np.append(True, (ends[1:] != ends[:-1]) | (rows[1:] != rows[:-1]))) if len(ends) else np.empty(0, np.int64)
            bounds = np.searchsorted(group, cuts)
            for j in range(done + 1, stop + 1):
                at = slice(cuts[j - done - 1], cuts[j - done])
                to = group[bounds[j - done - 1]:bounds[j - done]]
                if len(to):
                    terms = ahead[begins[at] - first, rows[at]] * self.table[pieces[at]]
                    ahead[j - first, rows[to]] = np.add.reduceat(terms, to - at.start) if len(to) < len(terms) else terms
                ended = slice(over[j - first], over[j - first + 1] if j < stop else int(np.searchsorted(size[live], stop, "right")))
                if ended.start < ended.stop:
                    with np.errstate(divide="ignore"):
                        out[live[ended]] = scale[live[ended]] + np.log(ahead[j - first, ended])
                if j % BLOCK == 0 and ended.stop < len(live):
                    low, here = max(0, j - first - self.longest), ahead[j - first, ended.stop:].copy()
                    ahead[low:j - first + 1, ended.stop:] /= here
                    scale[live[ended.stop:]] += np.log(here)
            left = int(np.searchsorted(size[live], stop, "right"))
            live, sums, done = live[left:], ahead[-self.longest:, left:], stop
        return out

    def text_scores(self, block) -> np.ndarray:
        """Log-probability of each text's words by language."""
        starts, ends, words = block.spans(LETTER_BYTE)
        hashes = block.hashes(starts, ends)
        kinds, first, place = np.unique(hashes, return_index=True, return_inverse=True)
        at = np.minimum(np.searchsorted(self.known, kinds), max(0, len(self.known) - 1))
        have = self.known[at] == kinds if len(self.known) else np.zeros(len(kinds), bool)
        scores = np.empty((len(kinds), len(self.languages)))
        if len(self.known):
            scores[have] = self.scores[at[have]]
        new = np.flatnonzero(~have)
        if len(new):
            scores[new] = self.word_scores(block.data, starts[first[new]], ends[first[new]])
            if len(self.known) + len(new) > KEPT_WORDS:
                self.known, self.scores = kinds, scores
            else:
                known = np.concatenate([self.known, kinds[new]])
                order = np.argsort(known)
                self.known, self.scores = known[order], np.concatenate([self.scores, scores[new]])[order]
        text = np.repeat(np.arange(block.n), words)
        return np.stack([np.bincount(text, scores[place, k], block.n) for k in range(len(self.languages))], axis=1)


def _parts(block):
    """Runs of letters to fit on, long ones in parts of about ``BLOCK`` bytes
    cut between characters: starts, ends, parts of each text, and whether a
    part begins its run."""
    starts, ends, words = block.spans(LETTER_BYTE)
    parts = -(-(ends - starts) // BLOCK)
    nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    text = np.repeat(np.repeat(np.arange(block.n), words), parts)
    cut, last = np.repeat(starts, parts) + nth * BLOCK, np.repeat(ends, parts)
    for _ in range(3):  # back to the first byte of a character
        cut = cut - ((nth > 0) & (block.data[cut] & 0xC0 == 0x80))
    until = np.where(np.append(nth[1:], 0) > 0, np.append(cut[1:], 0), last)
    return cut, until, np.bincount(text, minlength=block.n), nth == 0


def train(docs: DataFrame, vocabulary_path: str, per_language: int = SAMPLE_PER_LANGUAGE) -> Model | None:
    """Fit on documents with a lang; about ``per_language`` of each, chosen by
    a hash of doc_id."""
    spark = docs.sparkSession
    known = docs.select(docs["doc_id"].alias("doc_id"), docs["lang"].cast("string").alias("lang"), text_of(docs).alias("text"))
    known = known.where("lang is not null")
    sizes = known.groupBy(F.col("lang").alias("l")).agg(F.count(F.lit(1)).alias("n"))
    languages = sorted(r["l"] for r in sizes.collect())  # one row a language
    if not languages:
        return None
    chance = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    sample = known.join(F.broadcast(sizes), F.col("lang") == F.col("l")).where(chance * F.col("n") < per_language)
    sample = sample.select("l", letters_of(F.col("text")).alias("text"))

    def count(batches):
        for part, block in slices(batches):
            starts, ends, words, begins = _parts(block)
            code = np.array([languages.index(x) for x in part.column("l").to_pylist()], np.uint64)
            text = np.repeat(np.arange(block.n), words)
            key = mix64(block.hashes(starts, ends) + 2 * code[text] + begins.astype(np.uint64))
            _, first, often = np.unique(key, return_index=True, return_counts=True)
            raw = block.data.tobytes()
            yield pa.record_batch({"word": pa.array([b" " * bool(c) + raw[a:b] for a, b, c in zip(starts[first], ends[first], begins[first])], pa.binary()),
                                   "l": pa.array(code[text[first]].astype(np.int32)), "n": pa.array(often.astype(np.int64))})

    words = stage(sample.mapInArrow(count, "word binary, l int, n long").groupBy("word", "l").agg(F.sum("n").alias("n")), "lang-words")
    pieces = vocabulary(vocabulary_path)
    hashes, numbers = piece_hashes(pieces)
    longest = max(map(len, pieces))
    table = np.full((len(pieces), len(languages)), 1.0 / len(pieces))
    for _ in range(ROUNDS):
        shared = spark.sparkContext.broadcast(np.vstack([table, np.zeros(len(languages))]))

        def expect(batches):
            table, total = shared.value, np.zeros(shared.value.shape)
            for batch in batches:
                for at in range(0, batch.num_rows, 4000):
                    part = batch.slice(at, 4000)
                    raw = part.column("word").to_pylist()
                    rows, size = _matrix(raw)
                    lang, n = part.column("l").to_numpy(), part.column("n").to_numpy()
                    net = Lattice(rows, hashes, numbers, longest)
                    own = np.arange(len(raw))
                    ahead, behind = net.forward(table)[:, own, lang], net.backward(table, size)[:, own, lang]
                    weight = n / ahead[size, own]
                    for k, found in enumerate(net.piece, 1):
                        for j in range(k, found.shape[1]):
                            on = np.flatnonzero((found[:, j] >= 0) & (j <= size))
                            p = found[on, j]
                            np.add.at(total, (p, lang[on]), weight[on] * ahead[j - k, on] * table[p, lang[on]] * behind[j, on])
            p, lang = np.nonzero(total)
            yield pa.record_batch({"p": pa.array(p.astype(np.int32)), "l": pa.array(lang.astype(np.int32)), "c": pa.array(total[p, lang])})

        got = words.mapInArrow(expect, "p int, l int, c double").groupBy("p", "l").agg(F.sum("c").alias("c")).toPandas()  # pieces x languages
        table = np.full((len(pieces), len(languages)), SMOOTHING)
        table[got["p"], got["l"]] += got["c"]
        table /= table.sum(axis=0)
    return Model(languages, pieces, np.vstack([table, np.zeros(len(languages))]))


def predict(docs: DataFrame, model: Model | None, held: Column | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    languages = np.array([*(model.languages if model else []), "und"])

    def run(batches):
        model = shared.value
        for part, block in slices(batches):
            letters = part.column("letters").to_numpy(zero_copy_only=False)
            label, score = np.full(block.n, len(languages) - 1), np.zeros(block.n)
            if model:
                z = model.text_scores(block)
                best = z.argmax(axis=1)
                p = 1 / np.exp(np.maximum(z - z.max(axis=1, keepdims=True), -700)).sum(axis=1)
                label[letters], score[letters] = best[letters], p[letters]
            yield pa.record_batch({"doc_id": part.column("doc_id"), "held_out": part.column("held_out"), "lang_pred": pa.array(languages[label].tolist(), pa.string()), "score": score})

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
                           T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    text = text_of(docs)
    held = held_out(docs) if held is None else held
    return docs.select(docs["doc_id"].alias("doc_id"), held.alias("held_out"), letters_of(text).alias("text"), text.rlike(r"\p{L}").alias("letters")).mapInArrow(run, schema)


def held_out(docs: DataFrame):
    return remainder(docs, 4) == 2
