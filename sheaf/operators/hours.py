"""Weekly opening-hours features.

Input: seven text columns ``'H:M-H:M'`` (open-close), one per day, Monday first. A day counts as open
when its opening hour parses. All features come out of one projection.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sheaf.functions.arith import flag_count, null_count
from sheaf.functions.safe import split_item, try_cast
from sheaf.operators.columns import q
from sheaf.operators.filters import outside
from sheaf.sources.schemas import DAYS

HOUR_COLUMNS = tuple(f"hours_{d}" for d in DAYS)


def open_hour(c: str | Column) -> Column:
    """Opening hour (text before ``-``, then before ``:``) as short; null if absent or bad."""
    return try_cast(split_item(split_item(c, "-", 0), ":", 0), "short")


def close_hour(c: str | Column) -> Column:
    return try_cast(split_item(split_item(c, "-", 1), ":", 0), "short")


def hours_features(day_cols: Sequence[str] = HOUR_COLUMNS, morning_before: int = 11,
                   night_before: int = 4, night_after: int = 18,
                   weekdays: int = 5) -> list[Column]:
    """The six opening-hours features as expressions.

    Opens_All_Weekdays     1 when every weekday has an opening hour
    Opens_Weekends_sunday  1 when both weekend days have one
    Days_open              days with an opening hour (M3)
    no_info_open           1 when no day has one
    Opened_morning         share of open days opening before ``morning_before`` (M4), 0 if none
    Opened_night           share of open days closing before ``night_before`` or after
                           ``night_after`` (F7), 0 if none
    """
    opens = [open_hour(q(c)) for c in day_cols]
    closes = [close_hour(q(c)) for c in day_cols]
    days_open = F.lit(len(day_cols)) - null_count(opens)
    morning = flag_count([F.when(o < morning_before, 1).otherwise(0) for o in opens])
    night = flag_count([F.when(outside(h, night_before, night_after), 1).otherwise(0)
                        for h in closes])
    return [
        F.when(null_count(opens[:weekdays]) > 0, F.lit(0)).otherwise(F.lit(1))
        .alias("Opens_All_Weekdays"),
        F.when(null_count(opens[weekdays:]) > 0, F.lit(0)).otherwise(F.lit(1))
        .alias("Opens_Weekends_sunday"),
        days_open.alias("Days_open"),
        F.when(days_open == 0, F.lit(1)).otherwise(F.lit(0)).alias("no_info_open"),
        F.coalesce(F.try_divide(morning, days_open), F.lit(0.0)).alias("Opened_morning"),
        F.coalesce(F.try_divide(night, days_open), F.lit(0.0)).alias("Opened_night"),
    ]


def opening_hours(df: DataFrame, day_cols: Sequence[str] = HOUR_COLUMNS, **kw) -> DataFrame:
    """``df`` plus the six opening-hours features."""
    return df.select("*", *hours_features(day_cols, **kw))
