"""Filters, conditionals and joins."""

from __future__ import annotations

from dataclasses import replace



from sheaf.operators.columns import q
from sheaf.operators.filters import any_in, recode
from sheaf.operators.hours import opening_hours
from sheaf.operators.joins import left_join
from sheaf.operators.rollups import checkin_rollup, covid_target
from sheaf.plans import oracle as O
from sheaf.plans.features import (CARD_RECODE, KEY, TARGET, category_allow_list, feature_table,
                                  stored_rollups)
from sheaf.sources import fixtures as fx
from sheaf.plans.queries.common import (FIX, CATS, CARDS, HOURS_FEATURES, register, biz, feat,
                                        tables)


# ----------------------------------------------------------------------------------- filters

@register("filter_compare", O.sql('SELECT * FROM cov WHERE "delivery or takeout" = 1', "cov"))
def q_filter_compare(spark, sf):
    return covid_target(fx.covid(spark, sf)).filter(q(TARGET) == 1)


_LIST = ["PROMO", "gear", "widget"]


@register("filter_any_in_list", O.sql(
    f"SELECT business_id, {', '.join(CATS)} FROM biz WHERE "
    + " OR ".join(f"{c} IN ({', '.join(O.lit(v) for v in _LIST)})" for c in CATS), "biz"))
def q_filter_any_in_list(spark, sf):
    return biz(spark, sf).filter(any_in(CATS, _LIST)).select(KEY, *CATS)


@register("allow_list_filter", O.sql(
    f"SELECT business_id, {', '.join(CATS)} FROM biz WHERE "
    + " OR ".join(f"{c} IN (SELECT category FROM allow)" for c in CATS), "biz", "allow"))
def q_allow_list_filter(spark, sf):
    b = biz(spark, sf)
    return b.filter(any_in(CATS, category_allow_list(b, FIX))).select(KEY, *CATS)


@register("allow_list_top10", O.sql(
    "SELECT category FROM (SELECT category, count(category) AS frequency FROM tok GROUP BY category "
    "ORDER BY frequency DESC, category LIMIT 10) WHERE category NOT IN "
    f"({', '.join(O.lit(e) for e in O.EXCLUSIONS)})", "tok"))
def q_allow_list_top10(spark, sf):
    """An allow-list shorter than the number of categories."""
    names = category_allow_list(biz(spark, sf), replace(FIX, top_k=10))
    return spark.createDataFrame([(n,) for n in names], "category string")


@register("binary_flags", O.sql(
    "SELECT business_id, attributes_RestaurantsTakeOut, attributes_RestaurantsDelivery, "
    "pseudo_target FROM biz", "biz"))
def q_binary_flags(spark, sf):
    return biz(spark, sf).select(KEY, "attributes_RestaurantsTakeOut",
                                 "attributes_RestaurantsDelivery", "pseudo_target")


@register("recode_with_default", O.sql(
    f"SELECT business_id, CASE WHEN {CARDS} = 'True' THEN 'Yes' WHEN {CARDS} = 'False' THEN 'No' "
    f"ELSE 'Missing' END AS {CARDS} FROM biz", "biz"))
def q_recode(spark, sf):
    return biz(spark, sf).select(KEY, recode(CARDS, CARD_RECODE, "Missing").alias(CARDS))


@register("opening_hours", O.sql(
    f"SELECT business_id, {', '.join(HOURS_FEATURES)} FROM hrs", "hrs"))
def q_opening_hours(spark, sf):
    return opening_hours(biz(spark, sf)).select(KEY, *HOURS_FEATURES)


@register("days_open", O.sql("SELECT business_id, Days_open, no_info_open FROM hrs", "hrs"))
def q_days_open(spark, sf):
    return opening_hours(biz(spark, sf)).select(KEY, "Days_open", "no_info_open")


# ------------------------------------------------------------------------------------- joins

@register("left_join", O.sql(
    "SELECT * FROM (SELECT business_id FROM biz) LEFT JOIN chk USING (business_id)",
    "biz", "chk"))
def q_left_join(spark, sf):
    return left_join(biz(spark, sf).select(KEY), checkin_rollup(fx.checkin(spark, sf),
                                                               FIX.activity_as_of), KEY)


@register("feature_join", O.sql("SELECT * FROM feat", "feat"))
def q_feature_join(spark, sf):
    return feat(spark, sf)


@register("feature_join_bucketed", O.sql("SELECT * FROM feat", "feat"))
def q_feature_join_bucketed(spark, sf):
    """The star join over rollups kept in buckets of the key."""
    t = tables(spark, sf)
    return feature_table(t, FIX, stored=stored_rollups(t, FIX))
