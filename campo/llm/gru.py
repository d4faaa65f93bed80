"""A small gated recurrent language model in numpy: truncated backpropagation
through time, output softmax factored into classes.

Documents run one after another in parallel lanes; the state is carried from
window to window and starts anew with each document.  Windows are cut from the
texts as they are reached, so memory follows the words held and not the longest
text.  Word 0 stands for all words outside the vocabulary, word 1 for the end of
a document; both are classes of their own.  All other words are cut by falling
frequency into classes, small ones of frequent words and large ones of rare."""

from __future__ import annotations

import heapq
import math

import numpy as np

OTHER, END = 0, 1
STARTS = "starts"  #: key of the classes' first words among the weights
HIDDEN = 16
TRAIN_LANES, TRAIN_WINDOW = 512, 16
SCORE_LANES, SCORE_WINDOW = 512, 32
CELLS = 4096  #: about as many words are worked on at once, few enough for a core's cache
_LOG10E = float(np.log10(np.e))


def class_starts(counts: np.ndarray) -> np.ndarray:
    """First word of each class, and the number of words at the end.

    A class of s words with a share p of the tokens costs one output of every
    token, and s of its own tokens; the sum is least with s near 1 / sqrt(p of
    one word).  OTHER and END are classes of one word."""
    p = np.maximum(counts[2:].astype(float), 0.5)
    depth = np.cumsum(np.sqrt(p / p.sum())) if len(p) else np.empty(0)
    # class c holds the words whose running sum of sqrt(p) falls into [c, c + 1)
    cut = np.flatnonzero(np.diff(np.floor(depth).astype(np.int64), prepend=-1)) if len(p) else np.empty(0, np.int64)
    return np.concatenate([[0, 1], 2 + cut, [2 + len(p)] if len(p) else [2]]).astype(np.int64)


def initial(counts: np.ndarray, seed: int = 1) -> dict[str, np.ndarray]:
    """Weights whose outputs are the words' relative frequencies; ``counts``
    of OTHER, END and the vocabulary by falling frequency.  ``starts`` are the
    classes' first words, which training leaves as they are."""
    rng = np.random.default_rng(seed)
    k = len(counts)
    starts = class_starts(counts)
    p = np.maximum(counts.astype(float), 0.5)
    of = class_of(starts)
    mass = np.bincount(of, p, len(starts) - 1)
    small = lambda *shape: (rng.standard_normal(shape) * 0.1).astype(np.float32)
    return {"embed": small(k, HIDDEN), "wx": small(HIDDEN, 3 * HIDDEN), "wh": small(HIDDEN, 3 * HIDDEN),
            "b": np.zeros(3 * HIDDEN, np.float32), "u": small(HIDDEN, len(mass)) * 0, "bu": np.log(mass / mass.sum()).astype(np.float32),
            "o": np.zeros((k, HIDDEN), np.float32), "bo": np.log(p / mass[of]).astype(np.float32), STARTS: starts}


def class_of(starts: np.ndarray) -> np.ndarray:
    """Class of each word."""
    return np.repeat(np.arange(len(starts) - 1), np.diff(starts))


def flatten(w: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([w[k].ravel() for k in sorted(w) if k != STARTS])


def unflatten(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    out, at = {STARTS: like[STARTS]}, 0
    for k in sorted(like.keys() - {STARTS}):
        out[k] = flat[at:at + like[k].size].reshape(like[k].shape).astype(np.float32)
        at += like[k].size
    return out


def lanes(sizes: np.ndarray, width: int) -> list[list[int]]:
    """Deal texts to lanes, the longest first, each to the shortest lane."""
    width = min(width, len(sizes))
    out: list[list[int]] = [[] for _ in range(width)]
    heap = [(0, i) for i in range(width)]
    for t in np.argsort(-sizes, kind="stable").tolist():
        load, i = heap[0]
        out[i].append(t)
        heapq.heapreplace(heap, (load + int(sizes[t]), i))
    return out


def _row_max(x):
    """Greatest number of each row, as a column; faster than ``max(axis=1)``
    for many short rows."""
    return np.maximum.reduceat(x.ravel(), np.arange(0, x.size, x.shape[1]))[:, None]


class Model:
    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: v.copy() for k, v in weights.items() if k != STARTS}
        self.starts = weights[STARTS]
        self.cls = class_of(self.starts)

    def _forward(self, h, inputs, fresh, keep):
        """Hidden states of a window (T x B x H), and what backpropagation needs.
        While it runs, states and gates have a row for each unit: a step's are
        long runs of lanes."""
        w, n = self.w, HIDDEN
        half = np.repeat(np.float32([0.5, 0.5, 1]), n)  # of z and r: sigmoid(x) = tanh(x / 2) / 2 + 1 / 2
        steps, width = inputs.shape
        wx, b, wh = (w["wx"] * half).T, (w["b"] * half)[:, None], (w["wh"] * half).T
        some = max(1, CELLS // width)
        states = np.empty((n, steps, width), np.float32)
        saved = []
        for t in range(steps):
            if t % some == 0:
                gx = wx @ w["embed"].take(inputs[t:t + some].ravel(), axis=0).T
                gx += b
                gx = gx.reshape(3 * n, -1, width)
            h = np.where(fresh[t], np.float32(0), h)
            gh = wh @ h
            zr = gx[:2 * n, t % some] + gh[:2 * n]
            np.tanh(zr, out=zr)
            zr *= np.float32(0.5)
            zr += np.float32(0.5)
            z, r = zr[:n], zr[n:]
            c = r * gh[2 * n:]
            c += gx[2 * n:, t % some]
            np.tanh(c, out=c)
            new = h - c
            new *= z
            new += c
            if keep:
                saved.append((h, z, r, c, gh[2 * n:]))
            h = states[:, t] = new
        return h, np.ascontiguousarray(states.transpose(1, 2, 0)), saved

    def _outputs(self, states, targets, grads=None):
        """Natural log-probability of each target; with ``grads`` also sets the
        gradients of the outputs and returns that of the states."""
        w = self.w
        flat, goal = states.reshape(-1, HIDDEN), targets.ravel()
        cls = self.cls[goal]
        at = np.arange(len(goal))
        out = np.empty(len(goal), np.float32)
        back = probs = None
        if grads is not None:
            back, probs = np.empty_like(flat), np.empty((len(goal), len(w["bu"])), np.float32)
        # no small rest and no odd sizes, which BLAS would round in another way
        size = -(-len(goal) // (len(goal) // CELLS) // 64) * 64 if len(goal) > CELLS else CELLS
        for a in range(0, len(goal), size):
            part = slice(a, a + size)
            p = np.matmul(flat[part], w["u"], out=None if probs is None else probs[part])
            p += w["bu"]
            p -= _row_max(p)
            cell = at[:len(p)], cls[part]
            got = p[cell]
            np.exp(p, out=p)
            total = p @ np.ones(p.shape[1], np.float32)
            out[part] = got - np.log(total)
            if grads is not None:
                p /= total[:, None]
                p[cell] -= 1
                np.matmul(p, w["u"].T, out=back[part])
        if grads is not None:
            grads["u"], grads["bu"] = flat.T @ probs, probs.sum(axis=0)
            grads["o"], grads["bo"] = np.zeros_like(w["o"]), np.zeros_like(w["bo"])
        # the same inside the classes, whose words lie side by side
        order = np.argsort(cls.astype(np.uint16), kind="stable")  # a radix sort
        sizes = np.diff(self.starts)
        ends = np.cumsum(np.bincount(cls, minlength=len(sizes)))
        flat, goal, cls = flat.take(order, axis=0), goal[order], cls[order]
        cell = (at - np.append(0, ends)[cls]) * sizes[cls] + goal - self.starts[cls]  # of the goal in its class's table
        got, total, ones = np.zeros(len(goal), np.float32), np.ones(len(goal), np.float32), np.ones(sizes.max(), np.float32)
        inside = None if grads is None else np.zeros_like(flat)
        for c in range(2, len(ends)):  # OTHER and END are all of their class
            part, of = slice(ends[c - 1], ends[c]), slice(self.starts[c], self.starts[c + 1])
            if part.start == part.stop or sizes[c] == 1:
                continue
            x, o, own = flat[part], w["o"][of], cell[part]
            q = x @ o.T
            q += w["bo"][of]
            q -= _row_max(q)
            table = q.reshape(-1)
            got[part] = table[own]
            np.exp(q, out=q)
            total[part] = s = q @ ones[:sizes[c]]
            if grads is not None:
                q /= s[:, None]
                table[own] -= 1
                np.matmul(q.T, x, out=grads["o"][of])
                np.add.reduce(q, axis=0, out=grads["bo"][of])
                np.matmul(q, o, out=inside[part])
        got -= np.log(total)
        out[order] += got
        if grads is not None:
            place = np.empty_like(order)
            place[order] = at
            back += inside.take(place, axis=0)
        return out.reshape(targets.shape), back

    def _windows(self, texts: list[np.ndarray], width: int, steps: int, cells: int = 0):
        """Windows of ``steps`` words of every lane that goes on, longer ones of
        ``cells`` words in all where few lanes do: targets, words read, starts of
        texts, text numbers (-1: none), and the lanes that go on after it."""
        sizes = np.array([len(t) for t in texts])
        dealt = lanes(sizes, width)
        order = np.concatenate(dealt).astype(np.int64)
        words = np.concatenate([texts[t] for t in order])
        of = np.repeat(order.astype(np.int32), sizes[order])
        fresh = np.zeros(len(words), bool)
        fresh[np.cumsum(sizes[order]) - sizes[order]] = True
        stop = np.cumsum([sizes[d].sum() for d in dealt])
        at = np.concatenate([[0], stop[:-1]])
        while len(at):
            size = max(steps, min(cells // len(at), int((stop - at).max())))
            cell = at + np.arange(size)[:, None]
            off = cell >= stop
            cell = np.minimum(cell, stop - 1)
            target = words[cell].astype(np.int64)
            begins = fresh[cell] & ~off
            # each step reads the word before; a text starts after an end
            read = np.where(begins | off, END, words[cell - 1]).astype(np.int64)
            target[off] = END
            text = np.where(off, -1, of[cell])
            going = at + size < stop  # a lane that has ended stays so
            yield target, read, begins, text, going
            at, stop = (at + size)[going], stop[going]

    def score(self, texts: list[np.ndarray]) -> np.ndarray:
        """log10 probability of each text's words."""
        out = np.zeros(len(texts))
        h = None
        for target, read, begins, text, going in self._windows(texts, SCORE_LANES, SCORE_WINDOW, SCORE_LANES * SCORE_WINDOW):
            h = np.zeros((HIDDEN, target.shape[1]), np.float32) if h is None else h
            h, states, _ = self._forward(h, read, begins, False)
            got, _ = self._outputs(states, target)
            on = text >= 0
            out += np.bincount(text[on], got[on], len(texts))
            h = h[:, going]
        return out * _LOG10E

    def train(self, texts: list[np.ndarray], seen: dict[str, np.ndarray], rate: float) -> None:
        """One pass of truncated backpropagation with AdaGrad."""
        w, n = self.w, HIDDEN
        h = None
        for target, inputs, begins, _, going in self._windows(texts, TRAIN_LANES, TRAIN_WINDOW):
            h = np.zeros((HIDDEN, target.shape[1]), np.float32) if h is None else h
            h, states, saved = self._forward(h, inputs, begins, True)
            grads = {"wh": np.zeros_like(w["wh"])}
            _, back = self._outputs(states, target, grads)
            back = np.ascontiguousarray(back.T).reshape(n, *inputs.shape)
            dgx = np.empty((3 * n, *inputs.shape), np.float32)
            dh, h, dgh = np.zeros_like(h), h[:, going], np.empty((3 * n, h.shape[1]), np.float32)
            dz, dr, dghc = dgh[:n], dgh[n:2 * n], dgh[2 * n:]
            for t in range(len(inputs) - 1, -1, -1):
                before, z, r, c, ghc = saved[t]
                d = dh
                d += back[:, t]
                rest = 1 - z
                dc = d * rest
                dc *= 1 - c * c
                np.subtract(before, c, out=dz)
                dz *= d
                dz *= z
                dz *= rest
                np.multiply(dc, ghc, out=dr)
                dr *= r
                dr *= 1 - r
                np.multiply(dc, r, out=dghc)
                dgx[:2 * n, t], dgx[2 * n:, t] = dgh[:2 * n], dc
                rows = np.ascontiguousarray(dgh.T)
                grads["wh"] += before @ rows
                d *= z
                d += np.ascontiguousarray((rows @ w["wh"].T).T)
                dh = d
                dh[:, begins[t]] = 0
            flat, ids = dgx.reshape(3 * n, -1), inputs.ravel()
            order = np.argsort(ids.astype(np.uint16), kind="stable")  # a radix sort
            kinds, begin = np.unique(ids[order], return_index=True)
            by_word = np.ascontiguousarray(np.add.reduceat(flat.take(order, axis=1), begin, axis=1).T)
            grads["wx"] = w["embed"][kinds].T @ by_word
            grads["b"] = by_word.sum(axis=0)
            grads["embed"] = by_word @ w["wx"].T  # of these words; the others have no gradient
            scale = np.float32(1.0 / max(1, inputs.size))
            for k, g in grads.items():
                g *= scale
                np.clip(g, -1, 1, out=g)
                at = kinds if k == "embed" else slice(None)
                seen[k][at] += g * g
                g *= np.float32(rate)
                g /= np.sqrt(seen[k][at])
                w[k][at] -= g
