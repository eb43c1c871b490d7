"""Train/test splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.operators.columns import q

BUCKETS = 10_000


def hash_bucket(key: str | Column, buckets: int = BUCKETS) -> Column:
    """0..buckets-1 from the first 32 bits of md5(key as text).

    Depends on the key alone, not on partitioning or row order, so every run, engine and cluster size
    puts a key on the same side.
    """
    k = q(key) if isinstance(key, str) else key
    return F.conv(F.substring(F.md5(k.cast("string")), 1, 8), 16, 10).try_cast("bigint") % buckets


def _bounds(weights: Sequence[float], buckets: int) -> list[int]:
    total = float(sum(weights))
    acc, out = 0.0, []
    for w in weights:
        acc += w
        out.append(round(acc / total * buckets))
    return out


def split_label(key: str | Column, weights: Sequence[float] = (0.7, 0.3),
                names: Sequence[str] = ("train", "test"), buckets: int = BUCKETS) -> Column:
    """Name of the part each key falls in."""
    b = hash_bucket(key, buckets)
    bounds = _bounds(weights, buckets)
    e = F.when(b < bounds[0], F.lit(names[0]))
    for hi, name in zip(bounds[1:], names[1:]):
        e = e.when(b < hi, F.lit(name))
    return e


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.7, 0.3),
               buckets: int = BUCKETS) -> list[DataFrame]:
    """Deterministic split on a key; every row lands in exactly one part."""
    b = hash_bucket(key, buckets)
    bounds = [0] + _bounds(weights, buckets)
    return [df.filter((b >= lo) & (b < hi)) for lo, hi in zip(bounds[:-1], bounds[1:])]


def seeded_split(df: DataFrame, weights: Sequence[float] = (0.7, 0.3),
                 seed: int = 42) -> list[DataFrame]:
    """``randomSplit`` as in the original workload; the result depends on partitioning."""
    return df.randomSplit(list(weights), seed=seed)


def fold_number(key: str | Column, folds: int) -> Column:
    """0..folds-1 from the second 32 bits of md5(key as text): apart from ``hash_bucket``, so that the folds of one
    part of a split are as large as those of another."""
    k = q(key) if isinstance(key, str) else key
    return (F.conv(F.substring(F.md5(k.cast("string")), 9, 8), 16, 10).try_cast("bigint") % folds).cast("int")
