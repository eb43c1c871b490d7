"""The end-to-end plan: entity records -> feature table -> encoded base table -> model inputs.

Stages (all lazy except where a data-dependent schema or a bounded list needs an action):

    prepare_business   names with dots -> underscores, take-out / delivery flags, proxy target,
                       first five categories (trimmed)
    allow_list         top-k trimmed categories minus exclusions            [collect <= k values]
    restaurants        businesses with any of cat1..cat5 in the allow-list, opening-hours features
    rollups            review, check-in, tip and target tables, one row per business each
    feature_table      star join of the above, hour texts dropped
    encoded_table      sparse columns dropped, one-hot state / card / price  [collect levels, bounded]
    model_inputs       hash split, WOE and mean imputation fitted on train, formula features
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheaf.operators.bucketed import Bucketed, bucket_rollups, bucketed_star_join
from sheaf.operators.columns import drop_columns, drop_prefix, q, rename_column, sanitize_names
from sheaf.operators.encode import OneHotEncoder, WoeEncoder
from sheaf.operators.filters import DEFAULT_EXCLUSIONS, allow_list, any_in, flags, recode
from sheaf.operators.hours import opening_hours
from sheaf.operators.impute import MeanImputer, MeanImputerModel, fill_constant
from sheaf.operators.joins import star_join
from sheaf.operators.observed import Profile, materialize_observed
from sheaf.operators.profile import drop_sparse
from sheaf.operators.rollups import checkin_rollup, covid_target, review_rollup, tip_rollup
from sheaf.operators.split import fold_number, split_label
from sheaf.operators.topk import split_positions, top_k_tokens

KEY = "business_id"
TARGET = "delivery or takeout"
LABEL = "delivery_or_takeout"
SPLIT = "split"
FOLD = "fold"

# Columns removed from the base table before modelling.
FINAL_DROPS = ("address", "state", "attributes_BusinessParking", "attributes_RestaurantsPriceRange2",
               "attributes_RestaurantsDelivery", "attributes_RestaurantsTakeOut",
               "attributes_BusinessAcceptsCreditCards", "Categories", "City", "latitude",
               "longitude", "name", "postal_code", "BusinessAcceptsCreditCards_Missing",
               "RestaurantsPriceRange_None", "RestaurantsPriceRange_0", "pseudo_target")

# The columns whose nulls the workload fills with train means.
IMPUTE_COLUMNS = ("ratio_cool", "ratio_funny", "ratio_useful", "days_since last_check",
                  "nbr_checkin", "compliment_count", "days_since last_tip")

CARD_RECODE = {"True": "Yes", "False": "No"}


@dataclass(frozen=True)
class Params:
    review_as_of: str = "2020-03-31"
    activity_as_of: str = "2020-03-31"
    top_k: int = 100
    exclusions: tuple = DEFAULT_EXCLUSIONS
    n_categories: int = 5
    sparse_threshold: float = 0.40
    woe_cols: tuple = ("cat1", "cat2", "cat3")
    split_weights: tuple = (0.7, 0.3)
    compat: bool = False
    max_levels: int | None = None  # raise above so many one-hot levels of a column
    impute_cols: tuple | None = None  # columns filled with train means; None: every numeric one
    keep: tuple = field(default=(KEY, TARGET))


class Tables(NamedTuple):
    business: DataFrame
    review: DataFrame
    checkin: DataFrame
    tip: DataFrame
    covid: DataFrame


def user_features(user: DataFrame, as_of=None) -> DataFrame:
    """The user table with counters as short, rating as float, signup date as date, plus
    ``relationship_length`` in days up to ``as_of`` (today when ``None``). Bad text and counters
    that do not fit become null."""
    from sheaf.functions.dates import days_between
    from sheaf.operators.columns import cast_columns
    from sheaf.sources.schemas import USER_CASTS
    u = cast_columns(user, {c: t for c, t in USER_CASTS.items() if c in user.columns})
    return u.select("*", days_between(as_of, "yelping_since").alias("relationship_length"))


def prepare_business(business: DataFrame, p: Params = Params()) -> DataFrame:
    b = sanitize_names(business)
    takeout, delivery = "attributes_RestaurantsTakeOut", "attributes_RestaurantsDelivery"
    t, d, target = flags(takeout, delivery, p.compat)
    cols = [t.alias(c) if c == takeout else d.alias(c) if c == delivery else q(c)
            for c in b.columns]
    return b.select(*cols, target.alias("pseudo_target"),
                    *split_positions("categories", ",", p.n_categories))


def category_allow_list(biz: DataFrame, p: Params = Params()) -> list:
    top = top_k_tokens(biz, "categories", p.top_k)
    return allow_list(top, "category", p.exclusions, p.top_k)


def restaurants(biz: DataFrame, p: Params = Params(), allow: list | None = None) -> DataFrame:
    allow = category_allow_list(biz, p) if allow is None else allow
    cats = [f"cat{i + 1}" for i in range(p.n_categories)]
    return opening_hours(biz.filter(any_in(cats, allow)))


def rollups(t: Tables, p: Params = Params()) -> list[DataFrame]:
    return [review_rollup(t.review, p.review_as_of), checkin_rollup(t.checkin, p.activity_as_of),
            tip_rollup(t.tip, p.activity_as_of), covid_target(t.covid)]


def feature_table(t: Tables, p: Params = Params(), allow: list | None = None,
                  stored: list[Bucketed] | None = None) -> DataFrame:
    """Restaurants star-joined with their rollups, or with ``stored`` ones (``stored_rollups``) whose facts
    have not changed.

    The businesses are dealt by the key before their texts are parsed, which takes long for their bytes: a small file
    is read by few tasks. The joins take the rows as dealt, so this is their shuffle, not one more.
    """
    allow = category_allow_list(prepare_business(t.business, p), p) if allow is None else allow
    rest = restaurants(prepare_business(t.business.repartition(q(KEY)), p), p, allow)
    joined = star_join(rest, rollups(t, p), KEY) if stored is None else bucketed_star_join(rest, stored, KEY)
    return drop_prefix(joined, "hours")


def stored_rollups(t: Tables, p: Params = Params(), buckets: int | None = None) -> list[Bucketed]:
    """The rollups, written once in buckets of the key for any number of feature tables."""
    return bucket_rollups(rollups(t, p), KEY, buckets)


def encode_categoricals(df: DataFrame, p: Params = Params()) -> DataFrame:
    """One-hot state, card acceptance (recoded Yes/No/Missing) and price range (null -> '0')."""
    cards, price = "attributes_BusinessAcceptsCreditCards", "attributes_RestaurantsPriceRange2"
    if cards in df.columns:
        df = df.withColumn(cards, recode(cards, CARD_RECODE, "Missing"))
    if price in df.columns:
        df = fill_constant(df, "0", [price])
    prefixes = {c: pre for c, pre in (("state", "state"), (cards, "BusinessAcceptsCreditCards"),
                                      (price, "RestaurantsPriceRange")) if c in df.columns}
    return OneHotEncoder(prefixes, p.max_levels).fit(df).transform(df)


def encoded_table(feat: DataFrame, p: Params = Params(), profile: Profile | None = None) -> DataFrame:
    """Sparse columns dropped, categoricals encoded; a ``profile`` of the table saves the pass that finds sparse columns."""
    if profile is None:
        d = drop_sparse(feat, p.sparse_threshold, keep=p.keep)
    else:
        d = feat.drop(*profile.sparse_columns(p.sparse_threshold, p.keep))
    d = encode_categoricals(d, p)
    return rename_column(drop_columns(d, FINAL_DROPS), TARGET, LABEL)


class ModelInputs(NamedTuple):
    train: DataFrame
    test: DataFrame
    formula: object


def prepared(encoded: DataFrame, p: Params = Params()) -> DataFrame:
    """All rows tagged ``split`` = train / test by key hash, with WOE and mean imputation fitted on the
    labelled train rows and applied to all rows; rows without a label keep their null.

    The means of columns that WOE does not touch are taken from the rows as they come in, so the
    WOE joins run once for those of its own columns and once for the output.
    """
    rows = encoded.withColumn(SPLIT, split_label(KEY, p.split_weights))
    train = (F.col(SPLIT) == "train") & q(LABEL).isNotNull()
    woe_cols = [c for c in p.woe_cols if c in rows.columns]
    woe = WoeEncoder(woe_cols, LABEL).fit(rows.filter(train))
    out = woe.transform(rows)
    wanted = p.impute_cols if p.impute_cols is not None else [
        c for c, t in out.dtypes if c not in (KEY, LABEL)
        and (t in ("int", "bigint", "smallint", "tinyint", "double", "float") or t.startswith("decimal"))]
    plain = [c for c in wanted if c in out.columns and c not in woe_cols]
    coded = [c for c in wanted if c in woe_cols]
    means = MeanImputer(plain).fit(rows.filter(train)).means
    if coded:
        means |= MeanImputer(coded).fit(woe.transform(rows.filter(train).select(LABEL, *[q(c) for c in woe_cols]))).means
    return MeanImputerModel(means).transform(out)


def materialized_features(t: Tables, p: Params = Params()) -> DataFrame:
    """The star-joined feature table, written once as Parquet in the shared checkpoint folder.

    The encoding stages make several passes (one-hot levels, WOE and mean
    fits, the output); each reads only the columns it needs from one written table instead of
    re-running every rollup and join, and a lost executor re-reads the table, not the sources.
    """
    return profiled_features(t, p)[0]


def profiled_features(t: Tables, p: Params = Params(), nulls_only: bool = True) -> tuple[DataFrame, Profile]:
    """``materialized_features`` and the profile that its write observed."""
    return materialize_observed(feature_table(t, p), "features", nulls_only)


def base_table(t: Tables, p: Params = Params()) -> DataFrame:
    """The modelling table: encoded features, WOE and imputation fitted on train, a split column."""
    features, profile = profiled_features(t, p)
    return prepared(encoded_table(features, p, profile), p)


def model_inputs(t: Tables, p: Params = Params()) -> ModelInputs:
    """Formula features (fitted on train) for both parts, checkpointed for cross-validation."""
    return inputs_of(base_table(t, p))


def inputs_of(bt: DataFrame) -> ModelInputs:
    """``model_inputs`` of a base table: its labelled rows, as formula features, each with its fold."""
    from sheaf.operators.model import FOLDS, rformula
    from sheaf.session import checkpoint_dir
    bt = bt.filter(q(LABEL).isNotNull())
    train = bt.filter(F.col(SPLIT) == "train").drop(SPLIT)
    test = bt.filter(F.col(SPLIT) == "test").drop(SPLIT)
    f = rformula(train, LABEL, exclude=(KEY,), handle_invalid="keep")
    checkpoint_dir(train.sparkSession)
    parts = []
    for rows in (train, test):
        out = f.transform(rows).select(KEY, "label", "features", fold_number(KEY, FOLDS).alias(FOLD))
        parts.append(_sized(out.checkpoint(eager=True)))
    return ModelInputs(parts[0], parts[1], f)


def _sized(rows: DataFrame, partition_bytes: int = 1 << 26) -> DataFrame:
    """``rows`` in partitions of about ``partition_bytes`` of features: a fit makes many short passes, so small
    tables are best in few partitions and large ones must not be in fewer."""
    width = rows.schema["features"].metadata["ml_attr"]["num_attrs"]
    parts = max(1, -(-rows.count() * (8 * width + 64) // partition_bytes))
    return rows.coalesce(parts) if parts <= rows.rdd.getNumPartitions() else rows.repartition(parts)
