import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from sheaf.operators.columns import (cast_columns, drop_columns, drop_prefix, sanitize_names,
                                     text_flag_to_int)
from sheaf.operators.encode import OneHotEncoder, WoeEncoder
from sheaf.operators.filters import allow_list, any_in, flags, recode
from sheaf.operators.hours import opening_hours
from sheaf.operators.impute import MeanImputer, fill_constant
from sheaf.operators.profile import (describe_numeric, exact_quantiles, iqr_bounds, missing_counts,
                                     missing_share, sparse_columns, to_long)
from sheaf.operators.rollups import covid_target, review_rollup, table_shape
from sheaf.operators.split import hash_split, split_label
from sheaf.operators.topk import split_positions, tokens, top_k, top_k_tokens

HOURS = [f"hours_{d}" for d in ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday",
                                "Saturday", "Sunday")]


def hours_df(spark, rows):
    return spark.createDataFrame(rows, ", ".join(f"{h} string" for h in HOURS))


def test_all_hours_null(spark, ansi):
    r = opening_hours(hours_df(spark, [tuple([None] * 7)])).first()
    assert (r.Days_open, r.no_info_open, r.Opened_morning, r.Opened_night) == (0, 1, 0.0, 0.0)
    assert (r.Opens_All_Weekdays, r.Opens_Weekends_sunday) == (0, 0)


def test_late_close_and_shares(spark, ansi):
    week = ["11:0-2:0", "8:0-17:0", "", None, "9:30-23:0", "10:0-18:0", "bad"]
    r = opening_hours(hours_df(spark, [tuple(week)])).first()
    # open days: Mon, Tue, Fri, Sat (empty, null and "bad" do not parse)
    assert r.Days_open == 4
    assert r.Opened_morning == pytest.approx(3 / 4)     # 8, 9 and 10 are before 11; 11 is not
    assert r.Opened_night == pytest.approx(2 / 4)       # closes at 2 (< 4) and 23 (> 18)
    assert (r.Opens_All_Weekdays, r.Opens_Weekends_sunday) == (0, 0)


def test_split_positions_trim(spark, ansi):
    df = spark.createDataFrame([("A, B",), (None,), ("",)], "c string")
    rows = df.select(*split_positions("c", ",", 5)).collect()
    assert tuple(rows[0]) == ("A", "B", None, None, None)
    assert tuple(rows[1]) == (None,) * 5
    assert tuple(rows[2]) == ("",) + (None,) * 4


def test_tokens_null_and_empty(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "a, b")], "k int, c string")
    got = sorted((r.k, r.category) for r in tokens(df, "c", keep=["k"]).collect())
    assert got == [(2, ""), (3, "a"), (3, "b")]


def test_top_k_tie_break(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in top_k(df, "v", 2).collect()] == [("c", 2), ("a", 1)]


def test_top_k_tokens_trims_first(spark):
    df = spark.createDataFrame([("X, Y",), ("Y, X",)], "c string")
    assert sorted(tuple(r) for r in top_k_tokens(df, "c", 10).collect()) == [("X", 2), ("Y", 2)]


def test_allow_list_excludes_with_set_semantics(spark):
    top = spark.createDataFrame([("a", 3), ("b", 2), ("c", 1)], "category string, frequency long")
    assert sorted(allow_list(top, "category", ["b", "b", "zz"], 10)) == ["a", "c"]
    with pytest.raises(ValueError):
        allow_list(top, "category", [], 2)


def test_any_in(spark):
    df = spark.createDataFrame([("a", None), (None, "q"), ("x", "y")], "c1 string, c2 string")
    assert df.filter(any_in(["c1", "c2"], ["q", "a"])).count() == 2


def test_flags_null_delivery(spark, ansi):
    df = spark.createDataFrame([("True", None), ("False", "False"), (None, "None")],
                               "t string, d string")
    fix = [tuple(r) for r in df.select(*[c.alias(f"c{i}") for i, c in
                                         enumerate(flags("t", "d"))]).collect()]
    compat = [tuple(r) for r in df.select(*[c.alias(f"c{i}") for i, c in
                                            enumerate(flags("t", "d", compat=True))]).collect()]
    assert fix == [(1, 0, 1), (0, 0, 0), (0, 1, 1)]
    assert compat == [(1, 1, 1), (0, 0, 0), (0, 1, 1)]


def test_recode_default(spark):
    df = spark.createDataFrame([("True",), ("False",), ("",), (None,)], "c string")
    got = [r.r for r in df.select(recode("c", {"True": "Yes", "False": "No"}, "Missing")
                                  .alias("r")).collect()]
    assert got == ["Yes", "No", "Missing", "Missing"]


def test_text_flag_to_int(spark, ansi):
    df = spark.createDataFrame([("TRUE",), ("false",), ("maybe",), (None,)], "c string")
    assert [r.r for r in df.select(text_flag_to_int("c").alias("r")).collect()] == [1, 0, None, None]


def test_both_flags_one_row_per_key(spark):
    df = spark.createDataFrame([("k", "TRUE"), ("k", "FALSE"), ("m", "FALSE")],
                               "business_id string, `delivery or takeout` string")
    got = sorted(tuple(r) for r in covid_target(df).collect())
    assert got == [("k", 1), ("m", 0)]


def test_columns_ops(spark, ansi):
    df = spark.createDataFrame([("1", "x", "70000", "2020-01-01")],
                               "`a.b` string, `hours.Monday` string, n string, d string")
    s = sanitize_names(df)
    assert s.columns == ["a_b", "hours_Monday", "n", "d"]
    assert drop_prefix(s, "hours").columns == ["a_b", "n", "d"]
    assert drop_columns(s, ["A_B", "nope"]).columns == ["hours_Monday", "n", "d"]
    c = cast_columns(s, {"n": "short", "d": "date", "a_b": "int"}).first()
    assert (c.n, str(c.d), c.a_b) == (None, "2020-01-01", 1)


def test_zero_and_null_votes(spark, ansi):
    rows = [("r1", "b1", 4.0, 0, 0, 0, "2020-01-01"), ("r2", "b2", 3.0, None, 1, 1, "2020-02-01"),
            ("r3", "b2", 5.0, 1, 1, 1, "2020-03-01")]
    df = spark.createDataFrame(rows, "review_id string, business_id string, stars double, "
                                     "cool bigint, funny bigint, useful bigint, date string")
    got = {r.business_id: r for r in review_rollup(df, "2020-03-31").collect()}
    assert got["b1"].total_votes == 0 and got["b1"].ratio_cool is None
    assert got["b2"].total_votes == 3  # the row with a null vote has a null total
    assert got["b2"].ratio_cool == 0.33 and got["b2"].avg_votes == 3.0
    assert got["b2"].avg_stars == 4.0 and got["b2"].nbr_reviews == 2 and got["b2"].recent_review == 30


def test_one_hot_null_level_and_bound(spark):
    df = spark.createDataFrame([("A",), ("B",), (None,)], "state string")
    m = OneHotEncoder({"state": "state"}).fit(df)
    rows = [tuple(r) for r in m.transform(df).collect()]
    assert rows == [("A", 1, 0), ("B", 0, 1), (None, 0, 0)]
    with pytest.raises(ValueError):
        OneHotEncoder(["state"], max_levels=1).fit(df)


def test_one_hot_has_no_default_cap_and_a_vector_form(spark):
    from sheaf.operators.encode import one_hot_vector
    df = spark.range(1500).select((F.col("id") % 1201).cast("string").alias("s"))
    m = OneHotEncoder(["s"]).fit(df)
    assert len(m.values["s"]) == 1201
    v = one_hot_vector(spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "s string"), ["s"]).collect()
    assert [r["s_vec"].toArray().tolist() for r in v] == [[1, 0, 0], [0, 1, 0], [1, 0, 0], [0, 0, 1]]


def test_one_hot_names_feed_the_formula(spark):
    from sheaf.operators.model import rformula
    df = spark.createDataFrame([("St. Louis", 1, "a"), ("Paris", 0, "b"), ("St. Louis", 0, "c")],
                               "city string, y int, k string")
    hot = OneHotEncoder(["city"]).fit(df).transform(df).drop("city")
    assert hot.columns == ["y", "k", "city_Paris", "city_St_ Louis"]
    assert rformula(hot, "y", exclude=("k",)).transform(hot).count() == 3
    with pytest.raises(ValueError, match="share"):
        OneHotEncoder(["s"]).fit(spark.createDataFrame([("a.b",), ("a_b",)], "s string")).transform(
            spark.createDataFrame([("a.b",)], "s string"))


def test_one_hot_plan_has_no_python(spark):
    df = spark.createDataFrame([("A",), ("B",)], "state string")
    plan = OneHotEncoder(["state"]).fit(df).transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_fill_constant_casts(spark):
    df = spark.createDataFrame([(None, None)], "a bigint, b string")
    r = fill_constant(df, 0, ["a", "b"]).first()
    assert (r.a, r.b) == (0, "0")


def test_mean_impute_zero_filled_mean(spark, ansi):
    df = spark.createDataFrame([(2,), (None,), (4,)], "x bigint")
    m = MeanImputer(["x"]).fit(df)
    assert m.means == {"x": 2.0}
    assert [r.x for r in m.transform(df).collect()] == [2.0, 2.0, 4.0]
    df2 = spark.createDataFrame([(1.0,), (None,), (2.0,), (2.0,)], "x double")
    assert MeanImputer(["x"]).fit(df2).means == {"x": 1.25}


def test_quartiles_and_fences(spark, ansi):
    df = spark.createDataFrame([(float(i),) for i in range(1, 11)], "v double")
    r = iqr_bounds(df, ["v"]).first()
    assert (r.q1, r.q3, r.lower, r.upper) == (3.0, 8.0, -4.5, 15.5)


@pytest.mark.parametrize("skewed", [False, True])
def test_exact_quantiles_narrowing_matches_numpy(spark, skewed):
    rng = np.random.default_rng(7)
    vals = rng.normal(size=6000).round(3)
    if skewed:
        vals[: len(vals) // 3] = 0.25  # one value holds a third of all rows
    df = spark.createDataFrame([(float(v),) for v in vals], "v double")
    probs = [0.01, 0.25, 0.5, 0.75, 0.99]
    got = exact_quantiles(df, "v", probs, max_exact_rows=200, accuracy=100)
    s = np.sort(vals)
    want = [s[max(1, math.ceil(p * len(s))) - 1] for p in probs]
    assert got == pytest.approx(want)
    assert exact_quantiles(df, "v", probs) == pytest.approx(want)


@pytest.mark.parametrize("values,prob", [(2, 0.5), (4, 0.25), (4, 0.5), (4, 0.75), (500, 0.25), (500, 0.5)])
def test_exact_quantiles_between_heavy_neighbours(spark, values, prob):
    """The rank falls on the edge between two heavy values, with a limit below either's rows."""
    n = 50_000 if values == 500 else 1000
    df = spark.range(n).select((F.col("id") % values).cast("double").alias("v"))
    got = exact_quantiles(df, "v", [prob], max_exact_rows=50, accuracy=100)
    s = np.sort(np.arange(n) % values)
    assert got == [s[math.ceil(prob * n) - 1]]


def test_exact_quantiles_many_columns_mixed_paths(spark):
    from sheaf.operators.profile import exact_quantiles_multi
    rng = np.random.default_rng(11)
    a = rng.integers(0, 50, size=3000).astype(float)
    b = rng.exponential(size=3000).round(4)
    b[::3] = 7.0
    rows = [(float(x), float(y) if i % 10 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(rows, "a double, b double")
    probs = [0.1, 0.25, 0.75, 0.9]
    got = exact_quantiles_multi(df, ["a", "b"], probs, max_exact_rows=150, accuracy=50)
    for name, col in (("a", a), ("b", np.array([r[1] for r in rows if r[1] is not None]))):
        s = np.sort(col)
        assert got[name] == pytest.approx([s[max(1, math.ceil(p * len(s))) - 1] for p in probs])


def test_describe_dispatches_on_type(spark, ansi):
    from sheaf.operators.profile import describe
    df = spark.createDataFrame([("b", 1, 2.0, [1]), ("a", 3, None, [2]), (None, 5, 4.0, None)],
                               "t string, i int, d double, l array<int>")
    df = df.withColumn("day", F.lit("2020-01-02").cast("date"))
    got = {r["column"]: r for r in describe(df).collect()}
    assert tuple(got["t"])[1:] == (2, None, None, None, None, "a", "b")
    assert (got["i"]["mean"], got["i"]["min"], got["i"]["max"], got["i"]["stddev"]) == (3.0, 1.0, 5.0, 2.0)
    assert got["d"]["count"] == 2 and got["d"]["min_text"] is None
    assert got["day"]["min_text"] == "2020-01-02" and tuple(got["l"])[1:] == (2,) + (None,) * 6


def test_woe_fallback_join_gives_the_broadcast_result(spark):
    rows = [("hot" if i % 3 else (None if i % 2 else f"l{i % 7}"), i % 2) for i in range(300)]
    df = spark.createDataFrame(rows, "c string, y int")
    small = WoeEncoder(["c"], "y").fit(df).transform(df)
    large = WoeEncoder(["c"], "y", broadcast_limit=0).fit(df).transform(df)
    assert sorted(map(tuple, small.collect())) == sorted(map(tuple, large.collect()))


def test_imputed_columns_are_a_parameter(spark):
    from dataclasses import replace

    from sheaf.plans.catalog import FIX
    from sheaf.plans.features import LABEL, prepared
    df = spark.createDataFrame([(i, "a", i % 2, None if i % 3 else 1.0, None if i % 4 else 2.0) for i in range(60)],
                               f"business_id long, cat1 string, `{LABEL}` int, ratio_cool double, other double")
    p = replace(FIX, woe_cols=("cat1",), impute_cols=("ratio_cool",))
    out = prepared(df, p).agg(F.count_if(F.col("ratio_cool").isNull()).alias("a"),
                              F.count_if(F.col("other").isNull()).alias("b")).first()
    assert (out.a, out.b) == (0, 45)


def test_missing_counts_typed(spark, ansi):
    df = spark.createDataFrame(
        [("", 1.0, None, None, None), ("NaN", float("nan"), 3, True, None), ("x", None, 4, None, None)],
        "s string, f double, i int, b boolean, d date")
    plain = missing_counts(df).first().asDict()
    empty = missing_counts(df, empty_as_missing=True).first().asDict()
    assert plain == {"s": 1, "f": 2, "i": 1, "b": 2, "d": 3}
    assert empty["s"] == 2


def test_nan_text_matches_cast(spark, ansi):
    from sheaf.operators.profile import nan_text
    vals = ["NaN", " nan ", "+NaN", "-NaN", "NAN", "nanx", "1.5", "", None, "Infinity", "+nan"]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.a for r in df.select(nan_text(F.col("s")).alias("a")).collect()]
    ref = [r.b for r in df.select(F.coalesce(F.isnan(F.col("s").try_cast("double")), F.lit(False))
                                  .alias("b")).collect()]
    assert got == ref


def test_missing_share_and_sparse(spark):
    df = spark.createDataFrame([(1, None, ""), (2, None, None), (3, 1, None)], "a int, b int, c string")
    share = missing_share(df).first().asDict()
    assert share["a"] == 0.0 and share["b"] == pytest.approx(2 / 3) and share["c"] == pytest.approx(2 / 3)
    assert sparse_columns(df, 0.4) == ["b", "c"]
    assert sparse_columns(df, 0.4, keep=["c"]) == ["b"]
    long = {r.Variable: r.Value for r in to_long(missing_share(df)).collect()}
    assert long == share


def test_describe_numeric(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "x int")
    r = describe_numeric(df, ["x"]).first()
    assert (r.column, r["count"], r.mean, r.stddev, r["min"], r["max"]) == ("x", 3, 2.0, 1.0, 1.0, 3.0)


def test_table_shape(spark):
    df = spark.createDataFrame([(1, 2)] * 5, "a int, b int")
    assert tuple(table_shape(df).first()) == (5, 2)


def _woe_reference(cats, ys, r=1.0):
    p = sum(ys)
    n = len(ys) - p
    out = {}
    for c in set(cats):
        yy = [y for cc, y in zip(cats, ys) if cc == c]
        if len(yy) == 1:
            out[c] = 0.0
        else:
            pos = sum(yy)
            out[c] = math.log(((pos + r) / (p + 2 * r)) / ((len(yy) - pos + r) / (n + 2 * r)))
    return out


def test_woe_against_hand_formula(spark):
    cats = ["a", "a", "a", "b", "b", None, None, "s"]
    ys = [1, 0, 1, 0, 0, 1, 1, 1]
    df = spark.createDataFrame(list(zip(range(8), cats, ys)), "id int, c string, y int")
    model = WoeEncoder(["c"], "y", decimals=None).fit(df)
    ref = _woe_reference(cats, ys)
    got = {r.id: r.c for r in model.transform(df).collect()}
    for i, c in enumerate(cats):
        assert got[i] == pytest.approx(ref[c])
    rounded = {r.id: r.c for r in WoeEncoder(["c"], "y").fit(df).transform(df).collect()}
    assert all(rounded[i] == round(ref[c], 6) for i, c in enumerate(cats))
    new = spark.createDataFrame([(100, "unseen", 0)], "id int, c string, y int")
    assert model.transform(new).first().c == 0.0
    plan = model.transform(df)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan


def test_woe_rejects_non_binary_target(spark):
    df = spark.createDataFrame([("a", 2), ("b", 0)], "c string, y int")
    with pytest.raises(ValueError):
        WoeEncoder(["c"], "y").fit(df)


def test_hash_split_is_a_partition_and_stable(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    a, b = hash_split(df, "k")
    assert a.count() + b.count() == 2000
    assert a.join(b, "k").count() == 0
    assert 1200 < a.count() < 1600
    again = sorted(r.k for r in hash_split(df.repartition(7), "k")[0].collect())
    assert again == sorted(r.k for r in a.collect())
    labels = {r.split for r in df.select(split_label("k").alias("split")).collect()}
    assert labels == {"train", "test"}


def test_woe_mapping_not_broadcast_over_limit(spark):
    df = spark.createDataFrame([(i, f"v{i % 50}", i % 2) for i in range(200)], "id int, c string, y int")
    small = WoeEncoder(["c"], "y").fit(df)
    assert 0 < small.mapping_bytes < 100_000
    hinted = small.transform(df)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" in hinted
    big = WoeEncoder(["c"], "y", broadcast_limit=10).fit(df)
    unhinted = big.transform(df)._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in unhinted


def test_broadcast_threshold_parsing(spark):
    from sheaf.operators.joins import broadcast_threshold
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert broadcast_threshold(spark) == 0
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20MB")
        assert broadcast_threshold(spark) == 20 << 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_review_rollup_null_key_is_one_group(spark):
    rows = [("r1", None, 4.0, 1, 0, 0, "2020-03-01"), ("r2", None, 2.0, 1, 1, 0, "2020-03-02"),
            ("r2", None, 2.0, 1, 1, 0, "2020-03-02"), ("r3", "b", 5.0, 0, 0, 1, "2020-03-03")]
    df = spark.createDataFrame(rows, "review_id string, business_id string, stars double, "
                                     "cool bigint, funny bigint, useful bigint, date string")
    got = {r.business_id: r for r in review_rollup(df, "2020-03-31").collect()}
    assert set(got) == {None, "b"}
    assert got[None].nbr_reviews == 2 and got[None].total_cool == 3 and got[None].total_votes == 5
    assert got["b"].nbr_reviews == 1 and got["b"].ratio_useful == 1.0


def test_review_rollup_accepts_other_numeric_types(spark):
    rows = [("r1", "b", 4, 1, 0, 2, "2020-03-01"), ("r2", "b", 2, 0, 1, 0, "2020-03-05")]
    df = spark.createDataFrame(rows, "review_id string, business_id string, stars int, "
                                     "cool int, funny int, useful smallint, date string")
    r = review_rollup(df, "2020-03-31").first()
    assert (r.avg_stars, r.nbr_reviews, r.total_votes, r.avg_votes, r.recent_review) == \
        (3.0, 2, 4, 2.0, 26)
