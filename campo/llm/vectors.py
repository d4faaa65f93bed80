"""Vector columns as integer matrices, and binary columns of fixed width.

A vector is usable when it is not null and has no null and no non-finite
component.  A vector shorter than the longest usable one counts as filled up
with zeros."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def doubles(df: DataFrame, column: str) -> Column:
    return df[column].cast("array<double>")


def usable(df: DataFrame, column: str) -> Column:
    """Whether a row's vector takes part."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    return df[column].isNotNull() & F.forall(doubles(df, column), fine)


def integers(column: pa.Array, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of usable vectors, one row each, zeros up to ``width``."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    whole = np.floor(scale * flat)
    if len(whole) and np.abs(whole).max() >= 2.0 ** 62:
        raise ValueError("a vector component is too large for 64-bit arithmetic")
    lengths = np.diff(np.asarray(column.offsets))
    out = np.zeros((len(column), width), np.int64)
    if (lengths == width).all():
        out[:] = whole.reshape(len(column), width)
    else:
        row = np.repeat(np.arange(len(column)), lengths)
        out[row, np.arange(len(whole)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = whole
    return out


def packed(rows: np.ndarray) -> pa.Array:
    """A 2-D array as a binary column, one row each."""
    raw = np.ascontiguousarray(rows)
    size = raw.shape[1] * raw.itemsize
    offsets = (np.arange(len(raw) + 1) * size).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(raw), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(raw.tobytes())])


def unpacked(column: pa.Array, dtype, width: int) -> np.ndarray:
    """The 2-D array of a binary column made by :func:`packed`."""
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    raw = bytes(memoryview(column.buffers()[2])[offsets[0]:offsets[-1]])
    return np.frombuffer(raw, dtype).reshape(len(column), width)
