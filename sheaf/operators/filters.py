"""Predicates and conditionals."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.safe import as_col

# Category tags the workload removes from its top-100 allow-list (non-leisure trades).
DEFAULT_EXCLUSIONS = (
    "Home Services", "Automotive", "Event Planning & Services", "Fashion", "Professional Services",
    "Health & Medical", "Auto Repair", "Doctors", "Real Estate", "Local Services",
    "Women's Clothing", "Grocery", "Education", "Dentists", "Contractors", "Financial Services",
    "General Dentistry", "Pet Services", "Home Decor", "Furniture Stores", "Flowers & Gifts", "Tires",
    "Oil Change Stations",
)


def any_in(cols: Sequence[str | Column], values: Iterable) -> Column:
    """True when any of ``cols`` holds one of ``values`` (F2).

    A literal list becomes a hash-set lookup inside generated code, so the filter costs no shuffle.
    """
    vals = list(values)
    return reduce(lambda a, b: a | b, [as_col(c).isin(vals) for c in cols])


def allow_list(top: DataFrame, col: str, exclude: Iterable[str], max_size: int) -> list:
    """Values of a top-k frame minus exclusions.

    ``top`` must come from a top-k (``limit``) so the collected list is bounded; ``max_size`` guards it.
    Exclusions are removed with set semantics: a value listed twice, or absent, is not an error.
    """
    rows = top.filter(~F.col(col).isin(list(exclude))).select(col).limit(max_size + 1).collect()
    if len(rows) > max_size:
        raise ValueError(f"allow-list has more than {max_size} values")
    return [r[0] for r in rows if r[0] is not None]


def false_or_null_to_zero(c: str | Column) -> Column:
    """Text flag -> int: ``'False'`` or null gives 0, any other text 1."""
    c = as_col(c)
    return F.when((c == "False") | c.isNull(), F.lit(0)).otherwise(F.lit(1))


def flags(takeout: str, delivery: str, compat: bool = False) -> tuple[Column, Column, Column]:
    """Take-out flag, delivery flag and the proxy target ``takeout or delivery``.

    The original code tested the take-out column for null when deriving delivery, after it had
    already been replaced by 0/1; a null delivery value therefore came out as 1. ``compat=True``
    keeps that; the default treats a null delivery value as 0.
    """
    t = false_or_null_to_zero(takeout)
    if compat:
        d = F.when(as_col(delivery) == "False", F.lit(0)).otherwise(F.lit(1))
    else:
        d = false_or_null_to_zero(delivery)
    target = F.when((t == 1) | (d == 1), F.lit(1)).otherwise(F.lit(0))
    return t, d, target


def recode(c: str | Column, mapping: dict, default) -> Column:
    """Multi-branch recode with a default for everything else, null included."""
    c = as_col(c)
    items = list(mapping.items())
    out = F.when(c == items[0][0], F.lit(items[0][1]))
    for k, v in items[1:]:
        out = out.when(c == k, F.lit(v))
    return out.otherwise(F.lit(default))


def outside(c: str | Column, low, high) -> Column:
    """``c < low or c > high``: a range test that wraps around."""
    c = as_col(c)
    return (c < low) | (c > high)
