from pyspark.sql import functions as F

from sheaf.functions import (date_parts, days_between, item, ratio, round_half_up, row_sum,
                             split_item, text_to_date, try_cast)
from sheaf.functions.arith import null_count


def one(spark, expr, schema="x string", row=("a",)):
    return spark.createDataFrame([row], schema).select(expr.alias("r")).first()["r"]


def test_short_list_positions_are_null(spark, ansi):
    df = spark.createDataFrame([("A, B",)], "c string")
    r = df.select(*[split_item("c", ",", i).alias(f"p{i}") for i in range(5)]).first()
    assert (r.p0, r.p1, r.p2, r.p3, r.p4) == ("A", " B", None, None, None)
    assert one(spark, item(F.array(F.lit(1)), 3)) is None


def test_bad_casts_are_null(spark, ansi):
    df = spark.createDataFrame([("", "abc", 70000, "True")], "a string, b string, c bigint, d string")
    r = df.select(try_cast("a", "short").alias("a"), try_cast("b", "date").alias("b"),
                  try_cast("c", "short").alias("c"), try_cast("d", "boolean").alias("d")).first()
    assert (r.a, r.b, r.c, r.d) == (None, None, None, True)


def test_timestamp_text_to_date_and_recency(spark, ansi):
    df = spark.createDataFrame([("2020-03-01 11:22:33",), ("garbage",), (None,)], "t string")
    rows = df.select(text_to_date("t").alias("d"),
                     days_between("2020-03-31", text_to_date("t")).alias("n")).collect()
    assert str(rows[0].d) == "2020-03-01" and rows[0].n == 30
    assert rows[1].d is None and rows[1].n is None
    assert rows[2].d is None


def test_date_parts(spark):
    df = spark.createDataFrame([("2019-07-04",)], "d string").select(F.col("d").cast("date").alias("d"))
    r = df.select(*date_parts("d")).first()
    assert (r.year, r.month, r.day) == (2019, 7, 4)


def test_ratio_zero_and_null(spark, ansi):
    df = spark.createDataFrame([(1, 0), (1, 3), (None, 3)], "a bigint, b bigint")
    got = [r.r for r in df.select(ratio("a", "b").alias("r")).collect()]
    assert got == [None, 0.33, None]


def test_round_half_up_on_decimal_value(spark):
    df = spark.createDataFrame([(2.675,), (0.125,), (-2.675,)], "x double")
    assert [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()] == [2.68, 0.13, -2.68]


def test_round_half_up_rounds_once(spark):
    df = spark.createDataFrame([(2.4949996,), (2.4950000,), (1.00499999,), (0.285,), (1.005,)], "x double")
    assert [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()] == [2.49, 2.5, 1.0, 0.29, 1.01]


def test_round_half_up_large_and_special(spark, ansi):
    df = spark.createDataFrame([(1500000000000000.25,), (1e40,), (float("nan"),), (None,)], "x double")
    got = [r.r for r in df.select(round_half_up("x", 2).alias("r")).collect()]
    assert got[0] == 1500000000000000.25 and got[1] == 1e40 and got[2] != got[2] and got[3] is None


def test_row_sum_null_and_overflow(spark, ansi):
    df = spark.createDataFrame([(1, 2, 3), (1, None, 3), (2 ** 62, 2 ** 62, 0)],
                               "a bigint, b bigint, c bigint")
    assert [r.s for r in df.select(row_sum(["a", "b", "c"]).alias("s")).collect()] == [6, None, None]


def test_null_count(spark):
    df = spark.createDataFrame([(None, 1, None)], "a int, b int, c int")
    assert df.select(null_count(["a", "b", "c"]).alias("n")).first().n == 2
