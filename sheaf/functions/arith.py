"""Row-wise arithmetic (M1-M4)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.safe import as_col, round_half_up, safe_div


def row_sum(cols: list[str | Column]) -> Column:
    """a + b + ..., null if any term is null, null on overflow (never wraps)."""
    return reduce(lambda a, b: F.try_add(a, b), [as_col(c) for c in cols])


def null_count(cols: list[str | Column]) -> Column:
    """Number of null values among ``cols`` (int)."""
    return reduce(lambda a, b: a + b, [as_col(c).isNull().cast("int") for c in cols])


def flag_count(cols: list[str | Column]) -> Column:
    """Sum of 0/1 integer flags."""
    return reduce(lambda a, b: a + b, [as_col(c) for c in cols])


def ratio(a: str | Column, b: str | Column, scale: int | None = 2) -> Column:
    """a / b rounded half-up to ``scale`` digits; null on a zero or null denominator."""
    r = safe_div(a, b)
    return r if scale is None else round_half_up(r, scale)
