"""Deterministic equi-depth chunk ids for prefix computations.

Running sums / as-of carries are computed inside chunks of the sorted order
and stitched together with a small per-chunk table.  The chunk of a row must
be a pure function of its ordering value — not of a sampled, order-dependent
partitioner — so every branch of the plan and every task retry sees the same
chunks.  Bounds are P−1 approximate quantiles of the ordering key (one
aggregate, a short parameter array on the driver); the bucket expression is a
balanced CASE tree over those literals (codegen, ~log2 P comparisons a row).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def order_key(col: Column, dtype: T.DataType) -> Column:
    """A double that orders like ``col`` (dates → days, timestamps → microseconds)."""
    if isinstance(dtype, T.DateType):
        return F.unix_date(col).cast("double")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp")).cast("double")
    return col.cast("double")


def chunk_bounds(frames: Sequence[tuple[DataFrame, Column]], chunks: int, accuracy: int = 10000) -> list[float]:
    """Distinct P−1 approximate quantiles of the ordering keys of the given frames."""
    if chunks <= 1:
        return []
    probs = [i / chunks for i in range(1, chunks)]
    parts = [df.select(key.alias("_k")) for df, key in frames]
    union = parts[0]
    for p in parts[1:]:
        union = union.unionByName(p)
    row = union.agg(F.percentile_approx("_k", probs, accuracy).alias("b")).first()
    bounds = row["b"] if row is not None and row["b"] is not None else []
    return sorted(set(float(b) for b in bounds))


def bucket(key: Column, bounds: Sequence[float]) -> Column:
    """Number of bounds strictly below ``key`` (0..len(bounds)) as a balanced CASE tree."""

    def build(lo: int, hi: int) -> Column:
        # bucket index is in [lo, hi]; bounds[lo:hi] separate those buckets
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(key > F.lit(bounds[mid]), build(mid + 1, hi)).otherwise(build(lo, mid))

    return build(0, len(bounds)) if bounds else F.lit(0)
