"""Encoders, imputation and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from sheaf.functions.safe import round_half_up
from sheaf.operators.columns import q
from sheaf.operators.encode import OneHotEncoder, WoeEncoder
from sheaf.operators.impute import MeanImputer, fill_constant
from sheaf.operators.split import hash_split, split_label
from sheaf.plans import oracle as O
from sheaf.plans.features import IMPUTE_COLUMNS, KEY, TARGET, encode_categoricals, restaurants
from sheaf.plans.queries.common import (FIX, CARDS, PRICE, register, biz, feat, STATES,
                                        CARD_LEVELS, PRICE_LEVELS, BUCKET_SQL)
from sheaf.session import materialize


# ---------------------------------------------------------------------------------- encoding



def _one_hot_sql() -> str:
    card = (f"CASE WHEN {CARDS} = 'True' THEN 'Yes' WHEN {CARDS} = 'False' THEN 'No' "
            f"ELSE 'Missing' END")
    cols = ([f"CASE WHEN state = '{v}' THEN 1 ELSE 0 END AS state_{v}" for v in STATES]
            + [f"CASE WHEN {card} = '{v}' THEN 1 ELSE 0 END AS BusinessAcceptsCreditCards_{v}"
               for v in CARD_LEVELS]
            + [f"CASE WHEN COALESCE({PRICE}, '0') = '{v}' THEN 1 ELSE 0 END AS "
               f"RestaurantsPriceRange_{v}" for v in PRICE_LEVELS])
    return O.sql(f"SELECT business_id, {', '.join(cols)} FROM feat", "feat")


@register("one_hot", _one_hot_sql())
def q_one_hot(spark, sf):
    f = restaurants(biz(spark, sf), FIX).select(KEY, "state", CARDS, PRICE)  # no fact is needed
    enc = encode_categoricals(f, FIX)
    return enc.select(KEY, *[c for c in enc.columns if c not in f.columns])


@register("fill_constant", O.sql(
    f"SELECT business_id, COALESCE({PRICE}, '0') AS {PRICE} FROM biz", "biz"))
def q_fill_constant(spark, sf):
    return fill_constant(biz(spark, sf).select(KEY, PRICE), "0", [PRICE])


@register("mean_impute", O.sql(
    "SELECT business_id, " + ", ".join(
        f"COALESCE(CAST(f.{O.ident(c)} AS DOUBLE), m.{O.ident(c)}) AS {O.ident(c)}"
        for c in IMPUTE_COLUMNS)
    + " FROM feat f, (SELECT " + ", ".join(
        f"{O.r2(f'avg(COALESCE(CAST({O.ident(c)} AS DOUBLE), CAST(0 AS DOUBLE)))')} AS {O.ident(c)}"
        for c in IMPUTE_COLUMNS) + " FROM feat) m", "feat"))
def q_mean_impute(spark, sf):
    cols = list(IMPUTE_COLUMNS)
    f = materialize(feat(spark, sf).select(KEY, *[q(c) for c in cols]), "impute")
    return MeanImputer(cols).fit(f).transform(f)


@register("one_hot_levels", O.sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {c} AS level, count(*) AS n FROM rest WHERE {c} IS NOT NULL GROUP BY {c}"
    for c in ("state", CARDS, PRICE)), "rest"))
def q_one_hot_levels(spark, sf):
    """The levels that one-hot encoding finds, with the rows of each (from its own columns)."""
    f = restaurants(biz(spark, sf), FIX).select(KEY, "state", CARDS, PRICE)
    enc = OneHotEncoder(["state", CARDS, PRICE]).fit(f)
    hot = enc.transform(f)
    names = [(c, v) for c, vals in enc.values.items() for v in vals]
    sums = hot.agg(*[F.sum(q(f"{c}_{v}")).alias(f"n{i}") for i, (c, v) in enumerate(names)])
    return sums.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.lit(v).alias("level"), F.col(f"n{i}").alias("n"))
        for i, (c, v) in enumerate(names)])))




@register("hash_split", O.sql(
    f"SELECT business_id, CASE WHEN {BUCKET_SQL} < 7000 THEN 'train' WHEN {BUCKET_SQL} < 10000 "
    f"THEN 'test' END AS split FROM feat", "feat"))
def q_hash_split(spark, sf):
    return feat(spark, sf).select(KEY, split_label(KEY).alias("split"))


def _woe_sql() -> str:
    woe_cols = ["cat1", "cat2", "cat3"]
    stats = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {c} AS level, sum(y) AS pos, count(y) AS n FROM tr GROUP BY {c}"
        for c in woe_cols)
    body = f"""
, lab AS (SELECT *, CAST("delivery or takeout" AS DOUBLE) AS y FROM feat),
tr AS (SELECT * FROM lab WHERE {BUCKET_SQL} < 7000 AND y IS NOT NULL),
tot AS (SELECT CAST(sum(y) AS DOUBLE) AS p, CAST(count(y) AS DOUBLE) AS n FROM tr),
st AS ({stats}),
mp AS (SELECT feature, level, CASE WHEN st.n = 1 THEN CAST(0 AS DOUBLE) ELSE
         ln(((st.pos + 1.0) / (tot.p + 2.0)) / ((st.n - st.pos + 1.0) / (tot.n - tot.p + 2.0)))
       END AS woe FROM st, tot)
SELECT lab.business_id, {", ".join(
        f"{O.r2(f'COALESCE(m{i}.woe, CAST(0 AS DOUBLE))', 6)} AS {c}"
        for i, c in enumerate(woe_cols))}
FROM lab {" ".join(f"LEFT JOIN mp m{i} ON m{i}.feature = '{c}' AND m{i}.level IS NOT DISTINCT FROM lab.{c}"
                   for i, c in enumerate(woe_cols))}"""
    base = O.sql("SELECT 1", "feat")
    return base[: base.rindex("\nSELECT 1")] + body


@register("woe_encode", _woe_sql())
def q_woe_encode(spark, sf):
    rows = feat(spark, sf).select(KEY, "cat1", "cat2", "cat3", q(TARGET))  # one join: the target's
    train, _ = hash_split(rows, KEY, FIX.split_weights)
    woe = WoeEncoder(["cat1", "cat2", "cat3"], TARGET).fit(train)
    out = woe.transform(rows.drop(TARGET))
    return out.select(KEY, *[round_half_up(c, 6).alias(c) for c in ("cat1", "cat2", "cat3")])
