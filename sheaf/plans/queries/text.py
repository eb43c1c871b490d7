"""Top-k, list and date functions, row-wise arithmetic."""

from __future__ import annotations



from sheaf.functions.arith import row_sum
from sheaf.functions.dates import date_parts, days_between, text_to_date
from sheaf.operators.columns import q
from sheaf.operators.rollups import review_rollup, with_review_measures
from sheaf.operators.topk import tokens, top_k_tokens
from sheaf.plans import oracle as O
from sheaf.plans.features import KEY, TARGET
from sheaf.sources import fixtures as fx
from sheaf.plans.queries.common import FIX, CATS, register, biz, feat


# ------------------------------------------------------------------------------------- top-k

@register("top_k_tokens", O.sql("SELECT * FROM topk", "topk"))
def q_top_k_tokens(spark, sf):
    return top_k_tokens(biz(spark, sf), "categories", FIX.top_k)


@register("top_k_tokens_for_target", O.sql(
    "SELECT trim(t) AS category, count(trim(t)) AS frequency FROM (SELECT unnest(string_split("
    "categories, ',')) AS t FROM feat WHERE \"delivery or takeout\" = 1) GROUP BY 1 "
    "ORDER BY frequency DESC, category LIMIT 10", "feat"))
def q_top_k_tokens_for_target(spark, sf):
    return top_k_tokens(feat(spark, sf).filter(q(TARGET) == 1), "categories", 10)


# ------------------------------------------------------------------------- strings and dates

@register("split_positions", O.sql(f"SELECT business_id, {', '.join(CATS)} FROM biz", "biz"))
def q_split_positions(spark, sf):
    return biz(spark, sf).select(KEY, *CATS)


@register("explode_tokens", O.sql("SELECT * FROM tok", "tok"))
def q_explode_tokens(spark, sf):
    return tokens(biz(spark, sf), "categories", keep=[KEY])


@register("text_to_date", O.sql(
    "SELECT business_id, TRY_CAST(split_part(date, ' ', 1) AS DATE) AS date FROM checkin",
    "checkin"))
def q_text_to_date(spark, sf):
    return fx.checkin(spark, sf).select(KEY, text_to_date("date").alias("date"))


@register("recency_days", O.sql(
    f"SELECT review_id, {O._days(fx.REVIEW_AS_OF, 'date')} AS recency FROM review", "review"))
def q_recency_days(spark, sf):
    return fx.review(spark, sf).select("review_id",
                                       days_between(fx.REVIEW_AS_OF, "date").alias("recency"))


@register("tenure_days", O.sql(
    f"SELECT user_id, CAST(date_diff('day', TRY_CAST(yelping_since AS DATE), "
    f"DATE '{fx.USER_AS_OF}') AS INTEGER) AS relationship_length FROM users", "users"))
def q_tenure_days(spark, sf):
    from sheaf.plans.features import user_features
    return user_features(fx.user(spark, sf), fx.USER_AS_OF).select("user_id", "relationship_length")


@register("date_parts", O.sql(
    "SELECT review_id, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, "
    "CAST(day(date) AS INTEGER) AS day FROM review", "review"))
def q_date_parts(spark, sf):
    return fx.review(spark, sf).select("review_id", *date_parts("date"))


# -------------------------------------------------------------------------------------- math

@register("row_sum", O.sql("SELECT review_id, cool + funny + useful AS total_votes FROM review",
                           "review"))
def q_row_sum(spark, sf):
    return fx.review(spark, sf).select("review_id",
                                       row_sum(["cool", "funny", "useful"]).alias("total_votes"))


@register("ratio_features", O.sql(
    "SELECT business_id, ratio_cool, ratio_funny, ratio_useful FROM rev", "rev"))
def q_ratio_features(spark, sf):
    return review_rollup(fx.review(spark, sf), FIX.review_as_of).select(
        KEY, "ratio_cool", "ratio_funny", "ratio_useful")


@register("review_measures", O.sql("SELECT review_id, total_votes, recency FROM rev0", "rev0"))
def q_review_measures(spark, sf):
    return with_review_measures(fx.review(spark, sf), FIX.review_as_of).select(
        "review_id", "total_votes", "recency")
