"""Static binary fuse filters (three-wise, 8-bit fingerprints) in numpy.

Layout after Graf and Lemire, "Binary Fuse Filters" (2022): a key has one slot
in each of three neighbouring segments; the xor of its slots is its
fingerprint.  Construction peels all slots that hold one key at a time.
No false negatives; about one false positive in 256."""

from __future__ import annotations

import math

import numpy as np

from campo.llm.blocks import mix64


def _shape(n: int) -> tuple[int, int]:
    """Segment length (a power of two) and number of start segments."""
    if n < 2:
        return 4, 1
    length = 1 << min(18, max(2, int(math.floor(math.log(n) / math.log(3.33) + 2.25))))
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
    return length, max(1, math.ceil(n * factor / length) - 2)


def _slots(hashes: np.ndarray, length: int, segments: int) -> np.ndarray:
    """Three slots of each hash, as columns."""
    first = ((hashes >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    mask = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((hashes >> np.uint64(18)) & mask)
    third = (first + np.uint64(2 * length)) ^ (hashes & mask)
    return np.stack([first, second, third], axis=1).astype(np.int64)


def _prints(hashes: np.ndarray) -> np.ndarray:
    return ((hashes ^ (hashes >> np.uint64(32))) & np.uint64(0xFF)).astype(np.uint8)


def build(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """Filter of distinct 64-bit keys: seed, segment length, segments, table."""
    keys = np.unique(keys.astype(np.uint64))
    length, segments = _shape(len(keys))
    for seed in range(1, 1000):
        if seed % 20 == 0:  # a larger table where peeling keeps failing
            segments += max(1, segments // 8)
        hashes = mix64(keys + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        slots = _slots(hashes, length, segments)
        size = (segments + 2) * length
        count = np.bincount(slots.ravel(), minlength=size)
        held = np.zeros(size, np.int64)  # xor of the keys of a slot
        np.bitwise_xor.at(held, slots.ravel(), np.repeat(np.arange(len(keys)), 3))
        rounds, left = [], len(keys)
        while left:
            single = np.flatnonzero(count == 1)
            if not len(single):
                break
            peeled, at = np.unique(held[single], return_index=True)
            rounds.append((peeled, single[at]))
            gone = slots[peeled].ravel()
            np.subtract.at(count, gone, 1)
            np.bitwise_xor.at(held, gone, np.repeat(peeled, 3))
            left -= len(peeled)
        if left:
            continue
        table, prints = np.zeros(size, np.uint8), _prints(hashes)
        for peeled, own in reversed(rounds):
            t = slots[peeled]
            table[own] = 0
            table[own] = prints[peeled] ^ table[t[:, 0]] ^ table[t[:, 1]] ^ table[t[:, 2]]
        return seed, length, segments, table.tobytes()
    raise RuntimeError("no seed gives a fuse filter")


def contains(keys: np.ndarray, seed: int, length: int, segments: int, table: bytes) -> np.ndarray:
    hashes = mix64(keys.astype(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    t, cells = _slots(hashes, length, segments), np.frombuffer(table, np.uint8)
    return cells[t[:, 0]] ^ cells[t[:, 1]] ^ cells[t[:, 2]] == _prints(hashes)
