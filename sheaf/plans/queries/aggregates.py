"""Rollups and other aggregations."""

from __future__ import annotations



from sheaf.operators.profile import column_means
from sheaf.operators.rollups import (checkin_count, checkin_rollup, covid_target, dedupe_on_keys,
                                     distinct_per_year, distinct_values, duplicate_check,
                                     last_activity, review_rollup, table_shape, tip_rollup,
                                     value_frequency)
from sheaf.plans import oracle as O
from sheaf.plans.features import IMPUTE_COLUMNS, KEY, TARGET
from sheaf.sources import fixtures as fx
from sheaf.plans.queries.common import FIX, register, biz, feat


# ------------------------------------------------------------------------------- aggregation

@register("tip_rollup", O.sql("SELECT * FROM tipr", "tipr"))
def q_tip_rollup(spark, sf):
    return tip_rollup(fx.tip(spark, sf), FIX.activity_as_of)


@register("checkin_count", O.sql(
    "SELECT business_id, count(date) AS nbr_checkin FROM checkin GROUP BY business_id",
    "checkin"))
def q_checkin_count(spark, sf):
    return checkin_count(fx.checkin(spark, sf))


@register("last_activity", O.sql(
    "SELECT business_id, max(TRY_CAST(split_part(date, ' ', 1) AS DATE)) AS max_date "
    "FROM checkin GROUP BY business_id", "checkin"))
def q_last_activity(spark, sf):
    return last_activity(fx.checkin(spark, sf))


@register("checkin_rollup", O.sql("SELECT * FROM chk", "chk"))
def q_checkin_rollup(spark, sf):
    return checkin_rollup(fx.checkin(spark, sf), FIX.activity_as_of)


@register("review_rollup", O.sql("SELECT * FROM rev", "rev"))
def q_review_rollup(spark, sf):
    return review_rollup(fx.review(spark, sf), FIX.review_as_of)


@register("value_frequency", O.sql(
    "SELECT stars, count(*) AS count FROM review GROUP BY stars", "review"))
def q_value_frequency(spark, sf):
    return value_frequency(fx.review(spark, sf), "stars")


@register("distinct_per_year", O.sql(
    "SELECT CAST(year(date) AS INTEGER) AS year, count(DISTINCT business_id) AS n_business "
    "FROM review GROUP BY 1", "review"))
def q_distinct_per_year(spark, sf):
    return distinct_per_year(fx.review(spark, sf))


@register("duplicate_check", O.sql(
    "SELECT count(business_id) AS CountID, count(DISTINCT business_id) AS CountDistinctID "
    "FROM covid", "covid"))
def q_duplicate_check(spark, sf):
    return duplicate_check(fx.covid(spark, sf))


@register("table_shape", O.sql(
    f"SELECT count(*) AS n_rows, CAST({len(O.FEAT_KINDS)} AS BIGINT) AS n_columns FROM feat",
    "feat"))
def q_table_shape(spark, sf):
    return table_shape(feat(spark, sf)).toDF("n_rows", "n_columns")



@register("impute_means", O.sql(
    "SELECT " + ", ".join(
        f"{O.r2(f'avg(COALESCE(CAST({O.ident(c)} AS DOUBLE), CAST(0 AS DOUBLE)))')} AS {O.ident(c)}"
        for c in IMPUTE_COLUMNS) + " FROM feat", "feat"))
def q_impute_means(spark, sf):
    return column_means(feat(spark, sf), list(IMPUTE_COLUMNS))


@register("dedupe_on_keys", O.sql(
    'SELECT DISTINCT business_id, "delivery or takeout" FROM covid', "covid"))
def q_dedupe_on_keys(spark, sf):
    return dedupe_on_keys(fx.covid(spark, sf), [KEY, TARGET])


@register("distinct_values", O.sql("SELECT DISTINCT state FROM biz", "biz"))
def q_distinct_values(spark, sf):
    return distinct_values(biz(spark, sf), "state")


@register("covid_target", O.sql("SELECT * FROM cov", "cov"))
def q_covid_target(spark, sf):
    return covid_target(fx.covid(spark, sf))
