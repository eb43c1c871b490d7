"""ANSI-safe building blocks.

PySpark 4 runs with ``spark.sql.ansi.enabled=true``; the workload this library reproduces was written
for the old null-on-error semantics. Each helper below yields null where ANSI mode would raise:
out-of-range array index, bad cast, division by zero, integer overflow.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: str | Column, dtype: str) -> Column:
    """Cast that returns null instead of failing (never wraps on overflow)."""
    return as_col(c).try_cast(dtype)


def item(arr: str | Column, i: int) -> Column:
    """0-based array element; null when the index is out of range."""
    return F.get(as_col(arr), F.lit(i))


def _java_literal_pattern(sep: str) -> str:
    # split() takes a Java regex; quote the separator so it is matched literally.
    return sep if sep.isalnum() or sep in (",", " ", ":", ";") else "\\Q" + sep + "\\E"


def split_item(c: str | Column, sep: str, i: int) -> Column:
    """``split(c, sep)[i]`` with null for short lists.

    The first element is the text before the first separator (all of it when there is none), taken
    with ``substring_index`` so no array is built per row.
    """
    if i == 0:
        return F.substring_index(as_col(c), sep, 1)
    return item(F.split(as_col(c), _java_literal_pattern(sep)), i)


def split_all(c: str | Column, sep: str) -> Column:
    return F.split(as_col(c), _java_literal_pattern(sep))


def safe_div(a: str | Column, b: str | Column) -> Column:
    """a / b as double; null when b is 0 or null."""
    return F.try_divide(as_col(a), as_col(b))


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """Round half-up, once, on the shortest decimal that reads back as the double.

    NaN and infinities are returned as they are.
    """
    return F.round(as_col(c).cast("double"), scale)
