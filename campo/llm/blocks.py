"""Texts of an Arrow batch as flat byte arrays, and vectorised work on them.

Python workers get texts in Arrow batches.  Here a batch is cut into slices of
bounded size; a slice is one byte array plus document offsets, so word limits,
hashes and counts are a few numpy calls for thousands of documents at once.
Nothing here knows about Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

#: bytes of a word of the contract's ``[^\x20\x09-\x0D]+``
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[[0x20, *range(0x09, 0x0E)]] = False

#: ASCII letters and every byte of a non-ASCII character
LETTER_BYTE = np.zeros(256, bool)
LETTER_BYTE[0x80:] = True
for _lo, _hi in (("A", "Z"), ("a", "z")):
    LETTER_BYTE[ord(_lo):ord(_hi) + 1] = True


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser: a bijection that spreads every input bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _byte_codes(fold: bool) -> np.ndarray:
    codes = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
    if fold:  # A-Z count as a-z
        codes[ord("A"):ord("Z") + 1] = codes[ord("a"):ord("z") + 1]
    return codes


_CODES, _FOLDED = _byte_codes(False), _byte_codes(True)
_powers: dict[str, np.ndarray] = {}


def _powers_of(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        out = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
        out[0] = 1
        have = _powers[name] = np.cumprod(out, dtype=np.uint64)
    return have[:n]


class Block:
    """Texts side by side: ``data`` (bytes) and ``offsets`` (n + 1)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self._prefix: dict[bool, np.ndarray] = {}

    def spans(self, member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Maximal runs of bytes with ``member[byte]``, none across texts:
        starts, ends and the number of runs of each text."""
        inside = member[self.data]
        cut = np.zeros(len(self.data) + 1, bool)
        cut[self.offsets] = True
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1] | cut[1:-1]
        last[:-1] &= ~inside[1:] | cut[1:-1]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        return starts, ends, np.diff(np.searchsorted(starts, self.offsets))

    def words(self):
        return self.spans(WORD_BYTE)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, fold: bool = False) -> np.ndarray:
        """64-bit hash of the bytes of each span (``fold``: A-Z as a-z)."""
        if fold not in self._prefix:
            codes = (_FOLDED if fold else _CODES)[self.data]
            codes *= _powers_of("up", _BASE, len(codes))
            sums = np.zeros(len(codes) + 1, np.uint64)
            np.cumsum(codes, out=sums[1:])
            self._prefix[fold] = sums
        sums = self._prefix[fold]
        down = _powers_of("down", _BASE_INV, len(self.data) + 1)
        return mix64((sums[ends] - sums[starts]) * down[starts]
                     + (ends - starts).astype(np.uint64))


def hash_text(text: str, fold: bool = False) -> int:
    """The hash that :meth:`Block.hashes` gives a span with these bytes."""
    data = np.frombuffer(text.encode(), np.uint8)
    block = Block(data, np.array([0, len(data)]))
    return int(block.hashes(np.array([0]), np.array([len(data)]), fold)[0])


def text_block(column: pa.Array) -> Block:
    """A block over an Arrow string column; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    column = column.cast(pa.large_string())
    if len(column) == 0:
        return Block(np.empty(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, np.uint8)
    return Block(raw, at - at[0])


def slices(batches, column: str = "text", size: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Cut batches so that a slice holds about ``size`` bytes of text at most
    (one text where that alone is longer)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = text_block(batch.column(column)).offsets
        row = 0
        while row < batch.num_rows:
            stop = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
            stop = min(stop, batch.num_rows)
            part = batch.slice(row, stop - row)
            yield part, text_block(part.column(column))
            row = stop


def per_text(counts: np.ndarray) -> np.ndarray:
    """Text number of each of the spans counted by ``counts``."""
    return np.repeat(np.arange(len(counts)), counts)


def windows(hashes: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``width`` neighbouring spans of one text, and the
    index of its first span."""
    if len(hashes) < width:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    text = per_text(counts)
    n = len(hashes) - width + 1
    ok = np.flatnonzero(text[:n] == text[width - 1:])
    out = np.zeros(len(ok), np.uint64)
    for k in range(width):
        out = mix64(out * np.uint64(_BASE) + hashes[ok + k] + np.uint64(k + 1))
    return out, ok
