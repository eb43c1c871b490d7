"""Projection, renaming, dropping and casting."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.safe import as_col, try_cast


def q(name: str) -> Column:
    """Column by exact name, safe for names holding dots or spaces."""
    return F.col(f"`{name}`")


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast many columns in one projection.

    Values that do not fit or do not parse become null in either ANSI mode; an out-of-range counter
    is never wrapped around.
    """
    missing = [c for c in types if c not in df.columns]
    if missing:
        raise ValueError(f"unknown columns: {missing}")
    return df.select([try_cast(q(c), types[c]).alias(c) if c in types else q(c)
                      for c in df.columns])


def sanitize_names(df: DataFrame, old: str = ".", new: str = "_") -> DataFrame:
    """Replace ``old`` by ``new`` in every column name."""
    return df.toDF(*[c.replace(old, new) for c in df.columns])


def rename_column(df: DataFrame, old: str, new: str) -> DataFrame:
    """Rename one column."""
    return df.withColumnRenamed(old, new)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop by name (P4); names match case-insensitively and unknown names are ignored."""
    wanted = {n.lower() for n in names}
    return df.select([q(c) for c in df.columns if c.lower() not in wanted])


def drop_prefix(df: DataFrame, *prefixes: str) -> DataFrame:
    """Drop every column whose name starts with one of ``prefixes`` (P5)."""
    return df.select([q(c) for c in df.columns if not c.startswith(tuple(prefixes))])


def text_flag_to_int(c: str | Column) -> Column:
    """``'TRUE'``/``'false'``/``'1'``/... -> 1/0, anything else -> null."""
    return try_cast(as_col(c), "boolean").cast("int")
