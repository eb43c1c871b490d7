"""The workload's six tables, derived from the driver's parquet tables.

Each role is a Spark plan over a driver table, so its size grows with the scale factor:

    business  <- customer (left join part on p_partkey = c_custkey for the category text)
    review    <- orders   (o_custkey is the business, o_orderkey the review)
    tip       <- events   (click and purchase events; user_id is the business)
    checkin   <- events   (all events)
    covid     <- labels   (quality flag, plus a conflicting TRUE row for every toxic document)
    user      <- customer

``FIXTURE_SQL`` holds the same derivations in DuckDB SQL for the oracle. The two versions are written
independently and must stay in step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sheaf.functions.safe import split_item
from sheaf.sources.schemas import ATTRIBUTES, COMPLIMENTS, DAYS
from sheaf.sources.tables import load


# Fixture parameters: as-of dates that follow the date ranges of the driver's tables
# (orders 1995-2001, events January 2024, signups from 2004).
REVIEW_AS_OF = "2003-03-31"
ACTIVITY_AS_OF = "2024-03-31"
USER_AS_OF = "2021-12-31"

# Fixture parameters: category values to exclude, on top of the workload's own exclusion list, so that
# the allow-list filter removes part of the fixture's businesses.
FIXTURE_EXCLUSIONS = ("ECONOMY", "PROMO", "cold", "new", "red", "hot", "gear", "anvil", "widget", "rod")


def _s(c: Column) -> Column:
    return c.cast("string")


def business(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    p = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_name")
    # One SQL projection: building the same plan from Column objects costs several times more
    # driver time, for every query that starts from this table.
    attrs = {
        "RestaurantsTakeOut": "CASE c_custkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' END",
        "RestaurantsDelivery": "CASE c_nationkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' "
                               "WHEN 2 THEN 'None' END",
        "BusinessAcceptsCreditCards": "CASE c_custkey % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'False' "
                                      "WHEN 2 THEN NULL WHEN 3 THEN 'True' ELSE '' END",
        "RestaurantsPriceRange2": "CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 5 "
                                  "THEN 'None' ELSE CAST(c_custkey % 6 AS STRING) END",
        "BusinessParking": "CASE WHEN c_custkey % 2 = 0 THEN '{\\'garage\\': False}' END",
    }
    hours = [f"CASE WHEN c_custkey % 7 = {i} OR c_custkey % 11 = 0 THEN NULL ELSE "
             f"concat(CAST((c_custkey + {i}) % 24 AS STRING), ':0-', "
             f"CAST((c_custkey * 7 + {i}) % 24 AS STRING), ':30') END AS `hours.{d}`"
             for i, d in enumerate(DAYS)]
    return c.join(p, c["c_custkey"] == p["p_partkey"], "left").selectExpr(
        "c_custkey AS business_id", "c_name AS name",
        "concat(CAST(c_custkey AS STRING), ' Main St') AS address",
        "concat('City ', CAST(c_nationkey AS STRING)) AS city",
        "CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_mktsegment END AS state",
        "CAST(10000 + c_custkey % 90000 AS STRING) AS postal_code",
        "c_acctbal / CAST(100 AS DOUBLE) AS latitude",
        "c_acctbal / CAST(-200 AS DOUBLE) AS longitude",
        "CAST(c_custkey % 9 + 2 AS DOUBLE) / CAST(2 AS DOUBLE) AS stars",
        "(c_custkey * 37) % 500 AS review_count",
        "CAST(CASE WHEN c_custkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS is_open",
        "CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN '' "
        "ELSE concat(p_type, ', ', replace(p_name, ' ', ', ')) END AS categories",
        *[f"{attrs[a]} AS `attributes.{a}`" for a in ATTRIBUTES],
        *hours)


def review(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    return load(spark, sf_dir, "orders").select(
        F.concat(F.lit("r"), _s(k)).alias("review_id"),
        F.concat(F.lit("u"), _s((k * 7) % 1009)).alias("user_id"),
        F.col("o_custkey").alias("business_id"),
        split_item("o_orderpriority", "-", 0).try_cast("double").alias("stars"),
        (F.floor("o_totalprice") % 5).alias("useful"),
        (k % 3).alias("funny"),
        F.when(k % 50 == 0, F.lit(None).cast("bigint")).otherwise(k % 4).alias("cool"),
        F.col("o_orderdate").alias("date"))


def tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.filter(F.col("event_type").isin("click", "purchase")).select(
        F.concat(F.lit("u"), _s(F.col("event_id") % 997)).alias("user_id"),
        F.col("user_id").alias("business_id"), F.col("props").alias("text"),
        _s(F.col("ts")).alias("date"),
        (F.floor("value") % 7).alias("compliment_count"))


def checkin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = load(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("business_id"), _s(F.col("ts")).alias("date"))


def covid(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = load(spark, sf_dir, "labels")
    flag = F.when(F.col("quality") == 1, "TRUE").otherwise("FALSE")
    base = lab.select(F.col("doc_id").alias("business_id"), flag.alias("delivery or takeout"),
                      F.lit("FALSE").alias("Grubhub enabled"))
    extra = lab.filter(F.col("toxic") == 1).select(
        F.col("doc_id").alias("business_id"), F.lit("TRUE").alias("delivery or takeout"),
        F.lit("TRUE").alias("Grubhub enabled"))
    return base.unionByName(extra)


# Fixed per-counter multipliers for the user fixture (compliment_hot gets an overflowing value).
_USER_MULT = {c: m for c, m in zip(COMPLIMENTS, (3, 5, 7, 0, 11, 13, 17, 19, 23, 29, 31))}


def user(spark: SparkSession, sf_dir: str) -> DataFrame:
    counters = [(f"floor(abs(c_acctbal)) * 7" if m == 0 else f"(c_custkey * {m}) % 1000")
                + f" AS compliment_{n}" for n, m in _USER_MULT.items()]
    return load(spark, sf_dir, "customer").selectExpr(
        "concat('u', CAST(c_custkey AS STRING)) AS user_id", "c_name AS name",
        "c_custkey AS review_count",
        "CASE WHEN c_custkey % 17 = 0 THEN 'abc' WHEN c_custkey % 19 = 0 THEN '' ELSE "
        "CAST(date_add(DATE'2004-10-01', CAST(c_custkey AS INT)) AS STRING) END AS yelping_since",
        "(c_custkey * 13) % 1000 AS useful", "(c_custkey * 17) % 100 AS funny",
        "(c_custkey * 19) % 500 AS cool", "CAST(c_nationkey AS BIGINT) AS fans",
        "c_acctbal / CAST(2000 AS DOUBLE) AS average_stars", *counters)


ROLES = {"business": business, "review": review, "tip": tip, "checkin": checkin, "covid": covid,
         "user": user}


def role(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ROLES[name](spark, sf_dir)


# ---------------------------------------------------------------------------------------------
# DuckDB versions of the same derivations, for the oracle.

def _hours_sql() -> str:
    return ",\n".join(
        f"CASE WHEN c.c_custkey % 7 = {i} OR c.c_custkey % 11 = 0 THEN NULL ELSE "
        f"CAST((c.c_custkey + {i}) % 24 AS VARCHAR) || ':0-' || "
        f"CAST((c.c_custkey * 7 + {i}) % 24 AS VARCHAR) || ':30' END AS \"hours.{d}\""
        for i, d in enumerate(DAYS))


def _user_counters_sql() -> str:
    return ",\n".join(
        (f"CAST(floor(abs(c_acctbal)) AS BIGINT) * 7 AS compliment_{n}" if m == 0
         else f"(c_custkey * {m}) % 1000 AS compliment_{n}") for n, m in _USER_MULT.items())


FIXTURE_SQL: dict[str, str] = {
    "business": f"""
SELECT c.c_custkey AS business_id, c.c_name AS name,
  CAST(c.c_custkey AS VARCHAR) || ' Main St' AS address,
  'City ' || CAST(c.c_nationkey AS VARCHAR) AS city,
  CASE WHEN c.c_custkey % 13 = 0 THEN NULL ELSE c.c_mktsegment END AS state,
  CAST(10000 + c.c_custkey % 90000 AS VARCHAR) AS postal_code,
  c.c_acctbal / CAST(100 AS DOUBLE) AS latitude,
  c.c_acctbal / CAST(-200 AS DOUBLE) AS longitude,
  CAST(c.c_custkey % 9 + 2 AS DOUBLE) / CAST(2 AS DOUBLE) AS stars,
  (c.c_custkey * 37) % 500 AS review_count,
  CAST(CASE WHEN c.c_custkey % 4 = 0 THEN 0 ELSE 1 END AS BIGINT) AS is_open,
  CASE WHEN c.c_custkey % 29 = 0 THEN NULL WHEN c.c_custkey % 31 = 0 THEN ''
       ELSE p.p_type || ', ' || replace(p.p_name, ' ', ', ') END AS categories,
  CASE c.c_custkey % 3 WHEN 0 THEN 'True' WHEN 1 THEN 'False' ELSE NULL END
    AS "attributes.RestaurantsTakeOut",
  CASE c.c_nationkey % 4 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN 'None' ELSE NULL END
    AS "attributes.RestaurantsDelivery",
  CASE c.c_custkey % 5 WHEN 0 THEN 'True' WHEN 1 THEN 'False' WHEN 2 THEN NULL WHEN 3 THEN 'True'
       ELSE '' END AS "attributes.BusinessAcceptsCreditCards",
  CASE WHEN c.c_custkey % 6 = 0 THEN NULL WHEN c.c_custkey % 6 = 5 THEN 'None'
       ELSE CAST(c.c_custkey % 6 AS VARCHAR) END AS "attributes.RestaurantsPriceRange2",
  CASE WHEN c.c_custkey % 2 = 0 THEN '{{''garage'': False}}' ELSE NULL END
    AS "attributes.BusinessParking",
  {_hours_sql()}
FROM customer c LEFT JOIN part p ON p.p_partkey = c.c_custkey""",
    "review": """
SELECT 'r' || CAST(o_orderkey AS VARCHAR) AS review_id,
  'u' || CAST((o_orderkey * 7) % 1009 AS VARCHAR) AS user_id,
  o_custkey AS business_id, TRY_CAST(split_part(o_orderpriority, '-', 1) AS DOUBLE) AS stars,
  CAST(floor(o_totalprice) AS BIGINT) % 5 AS useful, o_orderkey % 3 AS funny,
  CASE WHEN o_orderkey % 50 = 0 THEN NULL ELSE o_orderkey % 4 END AS cool,
  o_orderdate AS date
FROM orders""",
    "tip": """
SELECT 'u' || CAST(event_id % 997 AS VARCHAR) AS user_id, user_id AS business_id, props AS text,
  CAST(ts AS VARCHAR) AS date, CAST(floor(value) AS BIGINT) % 7 AS compliment_count
FROM events WHERE event_type IN ('click', 'purchase')""",
    "checkin": """
SELECT user_id AS business_id, CAST(ts AS VARCHAR) AS date FROM events""",
    "covid": """
SELECT doc_id AS business_id, CASE WHEN quality = 1 THEN 'TRUE' ELSE 'FALSE' END
  AS "delivery or takeout", 'FALSE' AS "Grubhub enabled" FROM labels
UNION ALL
SELECT doc_id, 'TRUE', 'TRUE' FROM labels WHERE toxic = 1""",
    "user": f"""
SELECT 'u' || CAST(c_custkey AS VARCHAR) AS user_id, c_name AS name, c_custkey AS review_count,
  CASE WHEN c_custkey % 17 = 0 THEN 'abc' WHEN c_custkey % 19 = 0 THEN ''
       ELSE CAST(DATE '2004-10-01' + CAST(c_custkey AS INTEGER) AS VARCHAR) END AS yelping_since,
  (c_custkey * 13) % 1000 AS useful, (c_custkey * 17) % 100 AS funny,
  (c_custkey * 19) % 500 AS cool, CAST(c_nationkey AS BIGINT) AS fans,
  c_acctbal / CAST(2000 AS DOUBLE) AS average_stars,
  {_user_counters_sql()}
FROM customer""",
}
