"""The query registry, the fixture parameters and the tables every query starts from."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sheaf.operators.filters import DEFAULT_EXCLUSIONS
from sheaf.plans.features import (Params, Tables, materialized_features, feature_table,
                                  prepare_business)
from sheaf.sources import fixtures as fx

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

FIX = Params(review_as_of=fx.REVIEW_AS_OF, activity_as_of=fx.ACTIVITY_AS_OF,
             exclusions=DEFAULT_EXCLUSIONS + fx.FIXTURE_EXCLUSIONS)
CATS = [f"cat{i}" for i in range(1, 6)]
CARDS, PRICE = "attributes_BusinessAcceptsCreditCards", "attributes_RestaurantsPriceRange2"
HOURS_FEATURES = ["Opens_All_Weekdays", "Opens_Weekends_sunday", "Days_open", "no_info_open",
                  "Opened_morning", "Opened_night"]


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn
    return deco


def tables(spark: SparkSession, sf: str) -> Tables:
    return Tables(fx.business(spark, sf), fx.review(spark, sf), fx.checkin(spark, sf),
                  fx.tip(spark, sf), fx.covid(spark, sf))


def biz(spark, sf) -> DataFrame:
    return prepare_business(fx.business(spark, sf), FIX)


def feat(spark, sf) -> DataFrame:
    return feature_table(tables(spark, sf), FIX)


def feat_materialized(spark, sf) -> DataFrame:
    """The feature table written once (Parquet), for queries that pass over it more than once
    (fit, then transform; or two samples): the star join runs once and every pass sees the same
    rows."""
    return materialized_features(tables(spark, sf), FIX)


# Oracle-side constants: the fixture's levels at sf0.01, and the SQL form of the key-hash bucket.
STATES = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
CARD_LEVELS = ["Missing", "No", "Yes"]
PRICE_LEVELS = ["0", "1", "2", "3", "4", "None"]
BUCKET_SQL = "(CAST(('0x' || substr(md5(CAST(business_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10000)"
