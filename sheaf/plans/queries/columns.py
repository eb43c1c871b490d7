"""Sources and column operators: JSON scan, casts, names, drops, flag casts."""

from __future__ import annotations


from pyspark.sql import functions as F

from sheaf.operators.columns import (cast_columns, drop_columns, drop_prefix, q, rename_column,
                                     sanitize_names, text_flag_to_int)
from sheaf.operators.rollups import covid_target
from sheaf.plans import oracle as O
from sheaf.plans.features import FINAL_DROPS, KEY, LABEL, TARGET
from sheaf.session import scratch_path
from sheaf.sources import fixtures as fx
from sheaf.sources.json import read_table, write_json
from sheaf.sources.schemas import ATTRIBUTES, DAYS, USER_CASTS
from sheaf.plans.queries.common import CATS, register, biz


# ----------------------------------------------------------------------------------- sources

@register("json_scan", O.sql(
    "SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM business",
    "business"))
def json_scan(spark, sf):
    b = fx.business(spark, sf).withColumn("business_id", F.col("business_id").cast("string"))
    path = write_json(b, scratch_path(spark, "json"))
    return read_table(spark, "business", path)


@register("json_scan_nested", O.sql(
    "SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM business",
    "business"))
def json_scan_nested(spark, sf):
    """Business records written with ``attributes`` and ``hours`` as objects."""
    b = fx.business(spark, sf).withColumn("business_id", F.col("business_id").cast("string"))
    flat = [c for c in b.columns if "." not in c]
    parents = sorted({c.split(".")[0] for c in b.columns if "." in c})
    nested = [F.struct(*[F.col(f"`{c}`").alias(c.split(".", 1)[1]) for c in b.columns
                         if c.startswith(p + ".")]).alias(p) for p in parents]
    path = write_json(b.select(*flat, *nested), scratch_path(spark, "json"))
    return read_table(spark, "business", path)


@register("json_scan_covid", O.sql(
    "SELECT CAST(business_id AS VARCHAR) AS business_id, * EXCLUDE (business_id) FROM covid", "covid"))
def json_scan_covid(spark, sf):
    c = fx.covid(spark, sf).withColumn("business_id", F.col("business_id").cast("string"))
    path = write_json(c, scratch_path(spark, "json"))
    return read_table(spark, "covid", path).select(*[F.col(f"`{x}`") for x in c.columns])


@register("json_scan_user", O.sql("SELECT * FROM users", "users"))
def json_scan_user(spark, sf):
    u = fx.user(spark, sf)
    path = write_json(u, scratch_path(spark, "json"))
    return read_table(spark, "user", path).select(*[F.col(f"`{x}`") for x in u.columns])


# ------------------------------------------------------------------------------- projections

@register("cast_columns", O.sql(
    "SELECT user_id, name, " + ", ".join(
        f"TRY_CAST({O.ident(c)} AS {'SMALLINT' if t == 'short' else t.upper()}) AS {O.ident(c)}"
        for c, t in USER_CASTS.items()) + " FROM users", "users"))
def q_cast_columns(spark, sf):
    return cast_columns(fx.user(spark, sf), USER_CASTS)


@register("sanitize_names", O.sql(
    "SELECT * EXCLUDE (" + ", ".join(O.ident(f"attributes.{a}") for a in ATTRIBUTES)
    + ", " + ", ".join(O.ident(f"hours.{d}") for d in DAYS) + "), "
    + ", ".join(f'"attributes.{a}" AS attributes_{a}' for a in ATTRIBUTES) + ", "
    + ", ".join(f'"hours.{d}" AS hours_{d}' for d in DAYS) + " FROM business", "business"))
def q_sanitize_names(spark, sf):
    return sanitize_names(fx.business(spark, sf))


@register("rename_column", O.sql(
    'SELECT business_id, "delivery or takeout" AS delivery_or_takeout FROM cov', "cov"))
def q_rename_column(spark, sf):
    return rename_column(covid_target(fx.covid(spark, sf)), TARGET, LABEL)


_KEEP_AFTER_DROP = ["business_id", "stars", "review_count", "is_open"] + \
    [f"hours_{d}" for d in DAYS] + CATS


@register("drop_columns", O.sql(f"SELECT {', '.join(_KEEP_AFTER_DROP)} FROM biz", "biz"))
def q_drop_columns(spark, sf):
    return drop_columns(biz(spark, sf), FINAL_DROPS)


@register("drop_prefix", O.sql(
    f"SELECT * EXCLUDE ({', '.join(f'hours_{d}' for d in DAYS)}) FROM biz", "biz"))
def q_drop_prefix(spark, sf):
    return drop_prefix(biz(spark, sf), "hours")


@register("bool_to_int", O.sql(
    f'SELECT business_id, {O.as_bool_int(chr(34) + "delivery or takeout" + chr(34))} AS '
    f'"delivery or takeout", {O.as_bool_int(chr(34) + "Grubhub enabled" + chr(34))} AS '
    f'"Grubhub enabled" FROM covid', "covid"))
def q_bool_to_int(spark, sf):
    c = fx.covid(spark, sf)
    return c.select(KEY, *[text_flag_to_int(q(n)).alias(n)
                           for n in ("delivery or takeout", "Grubhub enabled")])
