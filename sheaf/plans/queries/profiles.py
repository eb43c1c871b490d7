"""Missing-data profiles, quantiles and summaries."""

from __future__ import annotations


from pyspark.sql import functions as F

from sheaf.operators.columns import q
from sheaf.operators.profile import (describe, describe_numeric, drop_sparse, iqr_bounds, missing_counts,
                                     missing_share, to_long)
from sheaf.plans import oracle as O
from sheaf.plans.features import profiled_features
from sheaf.sources import fixtures as fx
from sheaf.plans.queries.common import FIX, biz, feat, feat_materialized, register, tables
from sheaf.plans.queries.models import base_table_sql


# --------------------------------------------------------------------------------- profiling

@register("missing_counts", O.sql(f"SELECT {O.missing_sql(O.BIZ_KINDS, False)} FROM biz", "biz"))
def q_missing_counts(spark, sf):
    return missing_counts(biz(spark, sf))


@register("missing_or_empty_counts", O.sql(
    f"SELECT {O.missing_sql(O.FEAT_KINDS, True)} FROM feat", "feat"))
def q_missing_or_empty_counts(spark, sf):
    return missing_counts(feat(spark, sf), empty_as_missing=True)


@register("missing_share", O.sql(f"SELECT {O.share_sql(O.FEAT_KINDS)} FROM feat", "feat"))
def q_missing_share(spark, sf):
    return missing_share(feat(spark, sf))


@register("missing_share_long", O.sql(
    f"UNPIVOT (SELECT {O.share_sql(O.FEAT_KINDS)} FROM feat) ON COLUMNS(*) "
    "INTO NAME Variable VALUE Value", "feat"))
def q_missing_share_long(spark, sf):
    return to_long(missing_share(feat(spark, sf)))


SPARSE_AT_SF001 = ["attributes_BusinessParking", "cat4", "cat5", "days_since last_check",
                   "nbr_checkin", "compliment_count", "days_since last_tip"]


@register("drop_sparse_columns", O.sql(
    f"SELECT * EXCLUDE ({', '.join(O.ident(c) for c in SPARSE_AT_SF001)}) FROM feat", "feat"))
def q_drop_sparse_columns(spark, sf):
    return drop_sparse(feat_materialized(spark, sf), FIX.sparse_threshold, keep=FIX.keep)


@register("sparse_columns", O.sql(
    f"SELECT Variable AS \"column\", Value AS share FROM (UNPIVOT (SELECT {O.share_sql(O.FEAT_KINDS)} FROM feat) "
    "ON COLUMNS(*) INTO NAME Variable VALUE Value) WHERE Value > 0.40 AND Variable NOT IN "
    "('business_id', 'delivery or takeout')", "feat"))
def q_sparse_columns(spark, sf):
    """The columns that the 0.40 rule drops, with their missing shares."""
    f = feat(spark, sf)
    kept = set(drop_sparse(f, FIX.sparse_threshold, keep=FIX.keep).columns)
    gone = [c for c in f.columns if c not in kept]
    return to_long(missing_share(f.select(*[q(c) for c in gone])), "column", "share") if gone else (
        spark.createDataFrame([], "column string, share double"))


def _long_sql(columns: str, value: str) -> str:
    return f"(UNPIVOT (SELECT {columns} FROM feat) ON COLUMNS(*) INTO NAME \"column\" VALUE {value})"


@register("profile_on_write", O.sql(
    'SELECT "column", (SELECT count(*) FROM feat) AS "rows", missing, missing_or_empty, share FROM '
    f"{_long_sql(O.missing_sql(O.FEAT_KINDS, False), 'missing')} JOIN "
    f"{_long_sql(O.missing_sql(O.FEAT_KINDS, True), 'missing_or_empty')} USING (\"column\") JOIN "
    f"{_long_sql(O.share_sql(O.FEAT_KINDS), 'share')} USING (\"column\")", "feat"))
def q_profile_on_write(spark, sf):
    """Missing counts and shares of the feature table, observed while it is written."""
    return profiled_features(tables(spark, sf), FIX, nulls_only=False)[1].to_frame(spark)


def _iqr_sql(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", q1, q3, q1 - 1.5 * (q3 - q1) AS lower, "
            f"q3 + 1.5 * (q3 - q1) AS upper FROM (SELECT CAST(quantile_disc({c}, 0.25) AS DOUBLE) "
            f"AS q1, CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS q3 FROM biz)")


@register("iqr_bounds", O.sql(_iqr_sql("review_count") + " UNION ALL " + _iqr_sql("stars"), "biz"))
def q_iqr_bounds(spark, sf):
    return iqr_bounds(biz(spark, sf), ["review_count", "stars"])


def _describe_sql(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    return (f"SELECT '{c}' AS \"column\", count({x}) AS count, {O.r2(f'avg({x})', 6)} AS mean, "
            f"{O.r2(f'stddev_samp({x})', 6)} AS stddev, min({x}) AS min, max({x}) AS max FROM biz")


@register("describe_numeric", O.sql(
    _describe_sql("review_count") + " UNION ALL " + _describe_sql("stars"), "biz"))
def q_describe_numeric(spark, sf):
    return describe_numeric(biz(spark, sf), ["review_count", "stars"])


# ----------------------------------------------------------------- profiles of other tables

def _describe_any_sql(c: str, kind: str, table: str) -> str:
    e, x = O.ident(c), f"CAST({O.ident(c)} AS DOUBLE)"
    none = "CAST(NULL AS DOUBLE)"
    stats = ([O.r2(f"avg({x})", 6), O.r2(f"stddev_samp({x})", 6), f"min({x})", f"max({x})", "CAST(NULL AS VARCHAR)",
              "CAST(NULL AS VARCHAR)"] if kind == "n" else [none] * 4 + [f"CAST(min({e}) AS VARCHAR)",
                                                                        f"CAST(max({e}) AS VARCHAR)"])
    names = ("mean", "stddev", "min", "max", "min_text", "max_text")
    return (f"SELECT '{c}' AS \"column\", count({e}) AS count, "
            + ", ".join(f"{s} AS {n}" for s, n in zip(stats, names)) + f" FROM {table}")


_REVIEW_TYPES = [("review_id", "s"), ("user_id", "s"), ("business_id", "n"), ("stars", "n"), ("useful", "n"),
                 ("funny", "n"), ("cool", "n"), ("date", "d")]


@register("describe_review", O.sql(
    " UNION ALL ".join(_describe_any_sql(c, k, "review") for c, k in _REVIEW_TYPES), "review"))
def q_describe_review(spark, sf):
    """The whole review table, text and dates included."""
    return describe(fx.review(spark, sf).select(*[c for c, _ in _REVIEW_TYPES]))



_REVIEW_KINDS = [("review_id", "s"), ("user_id", "s"), ("business_id", "i"), ("stars", "f"),
                 ("useful", "i"), ("funny", "i"), ("cool", "i"), ("date", "i")]


@register("review_missing_counts", O.sql(
    f"SELECT {O.missing_sql(_REVIEW_KINDS, True)} FROM review", "review"))
def q_review_missing_counts(spark, sf):
    return missing_counts(fx.review(spark, sf), empty_as_missing=True)


@register("review_distinct_users", O.sql(
    "SELECT count(DISTINCT user_id) AS count_userid FROM review", "review"))
def q_review_distinct_users(spark, sf):
    return fx.review(spark, sf).agg(F.count_distinct("user_id").alias("count_userid"))


@register("split_shape", f"SELECT split, count(*) AS n_rows FROM ({base_table_sql()}) GROUP BY split")
def q_split_shape(spark, sf):
    from sheaf.plans.features import base_table
    return base_table(tables(spark, sf), FIX).groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
