"""Date features."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

from sheaf.functions.safe import split_item, try_cast


def text_to_date(c: str | Column) -> Column:
    """Date part of a ``'yyyy-MM-dd HH:mm:ss'`` text (text before the first space), as a date.

    Unparseable text gives null in either ANSI mode.
    """
    return try_cast(split_item(c, " ", 0), "date")


def _as_of(as_of: str | date | Column | None) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("date")


def days_between(as_of: str | date | Column | None, c: str | Column) -> Column:
    """Days from ``c`` to ``as_of`` (``datediff(as_of, c)``); ``None`` means today.

    Pass a fixed date for reproducible results.
    """
    return F.datediff(_as_of(as_of), try_cast(c, "date"))


def date_parts(c: str | Column, prefix: str = "") -> list[Column]:
    """Year, month and day of month of a date, timestamp or date text (bad text gives null)."""
    c = try_cast(c, "date")
    return [F.year(c).alias(f"{prefix}year"), F.month(c).alias(f"{prefix}month"),
            F.dayofmonth(c).alias(f"{prefix}day")]
