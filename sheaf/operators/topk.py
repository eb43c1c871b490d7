"""Tokens and top-k by frequency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.safe import as_col, split_all, split_item


def split_positions(c: str | Column, sep: str, n: int, trim: bool = True,
                    prefix: str = "cat") -> list[Column]:
    """The first ``n`` elements of a delimited list as columns ``cat1..catn``.

    Short lists give null, not an error. Elements are trimmed by default, so that a position after
    ``", "`` compares equal to the same value in first position.
    """
    out = []
    for i in range(n):
        e = split_item(c, sep, i)
        out.append((F.trim(e) if trim else e).alias(f"{prefix}{i + 1}"))
    return out


def tokens(df: DataFrame, col: str, sep: str = ",", trim: bool = True, name: str = "category",
           keep: Sequence[str] = ()) -> DataFrame:
    """One row per list element (X2, X3): null lists give no row, an empty list one ``''`` row."""
    t = F.explode(split_all(as_col(col), sep))
    out = df.select(*keep, t.alias(name))
    return out.withColumn(name, F.trim(name)) if trim else out


def top_k(df: DataFrame, col: str, k: int, count_name: str = "frequency") -> DataFrame:
    """The ``k`` most frequent values of ``col``.

    Ties are broken by the value itself so the result is deterministic. Planned as a partial top-k per
    task and a merge (no global sort).
    """
    return (df.groupBy(col).agg(F.count(col).alias(count_name))
            .orderBy(F.desc(count_name), F.asc(col)).limit(k))


def top_k_tokens(df: DataFrame, col: str, k: int, sep: str = ",",
                 name: str = "category") -> DataFrame:
    """Top-k trimmed list elements (T2, T3 after a filter)."""
    return top_k(tokens(df, col, sep, trim=True, name=name), name, k)
