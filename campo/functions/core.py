"""Scalar column functions M01–M11.

All functions take and return ``Column`` objects built from
``pyspark.sql.functions``; they stay inside whole-stage codegen.

Null rules (pandas parity): missing stays missing.  ``greatest(0, NULL)`` is 0
in Spark, so relu/clip are written with ``when`` so that NULL propagates.
"""

from __future__ import annotations

import math
from typing import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "as_col", "nan_to_null", "bell", "relu", "clip", "mean_of", "hash_uniforms",
    "hash_bucket", "gaussian_noise", "round_to", "relative_deficit",
    "argmax_label", "fmt", "parse_wallclock", "norm_text", "flag_list", "column_mean",
]

_TWO_POW_32 = 4294967296.0


def as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """NaN -> NULL (Spark orders NaN above every number, pandas treats it as missing)."""
    c = as_col(c)
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def bell(x, opt: float, sd: float) -> Column:
    """Gaussian response curve exp(-0.5((x-opt)/sd)^2), 1 at the optimum."""
    z = (as_col(x).cast("double") - F.lit(float(opt))) / F.lit(float(sd))
    return F.exp(F.lit(-0.5) * z * z)


def relu(x) -> Column:
    """max(0, x) with NULL kept NULL (``greatest`` alone skips NULLs).

    ``x`` appears twice in the expression; pass a column reference when x is
    an expensive expression (see ``targets.engineer_targets``)."""
    x = as_col(x).cast("double")
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(F.greatest(x, F.lit(0.0)))


def clip(x, lo: float, hi: float) -> Column:
    """Clip to [lo, hi] with NULL kept NULL."""
    x = as_col(x).cast("double")
    return F.when(x.isNull(), F.lit(None).cast("double")).otherwise(
        F.least(F.greatest(x, F.lit(float(lo))), F.lit(float(hi))))


def mean_of(*cols) -> Column:
    """Row-wise mean of a fixed set of columns (NULL if any is NULL)."""
    cs = [as_col(c).cast("double") for c in cols]
    total = cs[0]
    for c in cs[1:]:
        total = total + c
    return total / F.lit(float(len(cs)))


def _hex32(h: Column, start: int) -> Column:
    return F.conv(F.substring(h, start, 8), 16, 10).cast("bigint").cast("double")


def hash_uniforms(*parts) -> tuple[Column, Column]:
    """Two independent uniforms in (0, 1) from the md5 of the key parts.

    Depends only on the values, never on partitioning or row order.
    """
    s = F.concat_ws("|", *[as_col(p).cast("string") for p in parts])
    h = F.md5(s)
    u1 = (_hex32(h, 1) + F.lit(0.5)) / F.lit(_TWO_POW_32)
    u2 = (_hex32(h, 9) + F.lit(0.5)) / F.lit(_TWO_POW_32)
    return u1, u2


def hash_bucket(key, buckets: int = 100, seed: int = 42) -> Column:
    """Stable bucket 0..buckets-1 of a row key (split / fold assignment)."""
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), as_col(key).cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % F.lit(buckets)).cast("int")


def gaussian_noise(key, stream: str, sd: float = 1.0, seed: int = 42) -> Column:
    """Reproducible N(0, sd) per (seed, key, stream) via Box–Muller."""
    u1, u2 = hash_uniforms(F.lit(str(seed)), as_col(key), F.lit(stream))
    z = F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2)
    return z * F.lit(float(sd))


def round_to(x, places: int = 3) -> Column:
    """SQL rounding (HALF_UP on the decimal form)."""
    return F.round(as_col(x), places)


def relative_deficit(value, ideal: float) -> Column:
    """max(0, (ideal - v) / ideal); NULL when the reading is missing."""
    return relu((F.lit(float(ideal)) - as_col(value).cast("double")) / F.lit(float(ideal)))


def argmax_label(named: Iterable[tuple[str, Column]]) -> Column:
    """Label of the largest value; first wins ties; NULLs ignored;
    '' when every value is missing or the maximum is <= 0."""
    named = list(named)
    best = F.greatest(*[c for _, c in named])
    out = F.when(best.isNull() | (best <= 0), F.lit(""))
    for label, c in named:
        out = out.when(c == best, F.lit(label))
    return out.otherwise(F.lit(""))


def fmt(x, decimals: int) -> Column:
    """Fixed-point text of a number (Java formatter, HALF_UP on exact ties)."""
    return F.format_string(f"%.{decimals}f", as_col(x))


def parse_wallclock(s) -> Column:
    """Text -> TIMESTAMP_NTZ, NULL on bad input.

    A trailing ``Z`` or ``±hh:mm`` offset is dropped so the hour is the hour as
    written (no shift into the session time zone).
    """
    t = F.regexp_replace(F.trim(as_col(s).cast("string")), r"(Z|[+-]\d{2}:?\d{2})$", "")
    return t.try_cast("timestamp_ntz")


def norm_text(s, case: str = "upper") -> Column:
    """Strip + upper/lower."""
    t = F.trim(as_col(s))
    return F.upper(t) if case == "upper" else F.lower(t)


def flag_list(flags) -> Column:
    """Array of the labels whose condition holds, in the given order.

    ``flags`` is a list of (label, condition).  Built with ``concat`` of
    0/1-element arrays: code-generated, unlike ``array_compact`` / ``filter``
    (lambda functions are evaluated row by row outside whole-stage codegen).
    A NULL condition counts as false."""
    empty = F.array().cast("array<string>")
    parts = [F.when(cond, F.array(F.lit(label))).otherwise(empty) for label, cond in flags]
    if not parts:
        return empty
    return F.concat(*parts) if len(parts) > 1 else parts[0]


def column_mean(x) -> Column:
    """Aggregate: plain double mean, NaN as missing."""
    return F.avg(nan_to_null(as_col(x).cast("double")))
