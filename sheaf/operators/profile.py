"""Profiling and data quality.

Each profile is one aggregation over all columns: a single scan with partial aggregation, one row out.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.functions.safe import round_half_up
from sheaf.operators.columns import q
from sheaf.operators.quantiles import exact_quantiles, exact_quantiles_multi

__all__ = ["column_means", "describe", "describe_numeric", "drop_sparse", "exact_quantiles", "exact_quantiles_multi",
           "iqr_bounds", "missing_condition", "missing_counts", "missing_share", "nan_text", "sparse_columns", "to_long"]


def nan_text(col: Column) -> Column:
    """True for text that casts to NaN: ``NaN`` with an optional sign, or ``nan`` in any case.

    Same answer as ``isnan(cast(col AS double))`` without a number-parse attempt (and a failed
    parse) on every value of a text column. Only text of three bytes, which ``nan`` in any case has, is lower-cased.
    """
    t = F.trim(col)
    return F.coalesce(t.isin("NaN", "+NaN", "-NaN") | ((F.octet_length(t) == 3) & (F.lower(t) == "nan")), F.lit(False))


def missing_condition(df: DataFrame, c: str, empty_as_missing: bool = False) -> Column:
    """Null, NaN and (optionally) empty-string test, chosen by the column's type.

    Floating columns test NaN directly; text columns test for text that reads as NaN
    (``'NaN'``); other types can only be null. This gives the old untyped test's answers without
    casting errors under ANSI mode or analysis errors on dates and booleans.
    """
    dt = df.schema[c].dataType
    col = q(c)
    cond = col.isNull()
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        cond = cond | F.isnan(col)
    elif isinstance(dt, T.StringType):
        cond = cond | nan_text(col)
        if empty_as_missing:
            cond = cond | (col == "")
    return cond


def missing_counts(df: DataFrame, empty_as_missing: bool = False) -> DataFrame:
    """Per column, the number of missing values (Q1; Q2 with ``empty_as_missing``). One row."""
    return df.agg(*[F.count_if(missing_condition(df, c, empty_as_missing)).alias(c)
                    for c in df.columns])


def missing_share(df: DataFrame) -> DataFrame:
    """Per column, ``1 - count(c) / count(*)`` (Q3). Empty strings and NaN count as present."""
    n = F.count(F.lit(1))
    return df.agg(*[(F.lit(1.0) - F.try_divide(F.count(q(c)), n)).alias(c) for c in df.columns])


def to_long(row: DataFrame, name: str = "Variable", value: str = "Value",
            value_type: str = "double") -> DataFrame:
    """One-row wide profile -> one row per column."""
    return row.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias(name), q(c).cast(value_type).alias(value)) for c in row.columns])))


def sparse_columns(df: DataFrame, threshold: float = 0.40, keep: Iterable[str] = ()) -> list[str]:
    """Columns whose missing share exceeds ``threshold``, except those in ``keep`` (Q5)."""
    keep = set(keep)
    shares = missing_share(df).first().asDict()
    return [c for c in df.columns if c not in keep and shares[c] is not None
            and shares[c] > threshold]


def drop_sparse(df: DataFrame, threshold: float = 0.40, keep: Iterable[str] = ()) -> DataFrame:
    drop = set(sparse_columns(df, threshold, keep))
    return df.select([q(c) for c in df.columns if c not in drop])


def iqr_bounds(df: DataFrame, cols: Sequence[str], whisker: float = 1.5, **kw) -> DataFrame:
    """Exact quartiles and ``whisker`` x IQR fences per column (Q6), one row per column."""
    qs = exact_quantiles_multi(df, cols, [0.25, 0.75], **kw)
    rows = []
    for c in cols:
        q1, q3 = qs[c]
        if q1 is None:
            rows.append((c, None, None, None, None))
            continue
        iqr = q3 - q1
        rows.append((c, float(q1), float(q3), q1 - whisker * iqr, q3 + whisker * iqr))
    schema = "column string, q1 double, q3 double, lower double, upper double"
    return df.sparkSession.createDataFrame(rows, schema)


def describe_numeric(df: DataFrame, cols: Sequence[str], scale: int | None = 6) -> DataFrame:
    """Count, mean, sample standard deviation, min and max per column, typed (Q7).

    ``DataFrame.describe`` returns every statistic as text; this keeps doubles. One aggregation.
    """
    def r(e):
        return e if scale is None else round_half_up(e, scale)
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), r(F.avg(x)).alias(f"m{i}"),
                 r(F.stddev_samp(x)).alias(f"s{i}"), F.min(x).alias(f"lo{i}"),
                 F.max(x).alias(f"hi{i}")]
    one = df.agg(*aggs)
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"),
                 F.col(f"m{i}").alias("mean"), F.col(f"s{i}").alias("stddev"),
                 F.col(f"lo{i}").alias("min"), F.col(f"hi{i}").alias("max"))
        for i, c in enumerate(cols)])))


def describe(df: DataFrame, cols: Sequence[str] | None = None, scale: int | None = 6) -> DataFrame:
    """Summary of any columns (Q7), one row each: count of values; mean, sample standard deviation, min and
    max of numbers; ``min_text`` and ``max_text`` of text, dates, timestamps and booleans.

    Columns of other types (arrays, maps, structs, binary) have a count only. One aggregation.
    """
    def r(e):
        return e if scale is None else round_half_up(e, scale)
    none, blank = F.lit(None).cast("double"), F.lit(None).cast("string")
    cols = list(df.columns if cols is None else cols)
    aggs = []
    for i, c in enumerate(cols):
        kind = df.schema[c].dataType
        x, text = q(c).cast("double"), q(c)
        number = isinstance(kind, T.NumericType)
        ordered = isinstance(kind, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType))
        aggs += [F.count(q(c)).alias(f"n{i}")]
        aggs += [e.alias(f"{a}{i}") for a, e in (
            ("m", r(F.avg(x))), ("s", r(F.stddev_samp(x))), ("lo", F.min(x)), ("hi", F.max(x)))] if number else []
        aggs += [F.min(text).cast("string").alias(f"tl{i}"), F.max(text).cast("string").alias(f"th{i}")] if ordered else []
    one = df.agg(*aggs)

    def at(name, i, default):
        return F.col(f"{name}{i}") if f"{name}{i}" in one.columns else default
    return one.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), at("m", i, none).alias("mean"),
                 at("s", i, none).alias("stddev"), at("lo", i, none).alias("min"), at("hi", i, none).alias("max"),
                 at("tl", i, blank).alias("min_text"), at("th", i, blank).alias("max_text"))
        for i, c in enumerate(cols)])))


def column_means(df: DataFrame, cols: Sequence[str], scale: int = 2,
                 zero_fill: bool = True) -> DataFrame:
    """Rounded means of several columns in one aggregation (A9). One row."""
    def x(c):
        e = q(c).cast("double")
        return F.coalesce(e, F.lit(0.0)) if zero_fill else e
    return df.agg(*[round_half_up(F.avg(x(c)), scale).alias(c) for c in cols])
