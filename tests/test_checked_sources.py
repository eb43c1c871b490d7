"""The JSON source that keeps rejects apart, and distinct counts by bitmap."""

import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from sheaf.operators.rollups import distinct_by_bitmap
from sheaf.sources import read_json_checked

SCHEMA = T.StructType([T.StructField("a", T.LongType()), T.StructField("b.c", T.StringType()),
                       T.StructField("d", T.DateType())])


def test_every_line_counts_once(spark, tmp_path):
    good = ['{"a": 1, "b.c": "x", "d": "2020-01-02", "new": [1]}', '{"a": null}', '{}', '  {"a": 3, "b.c": "ü"}  ']
    drifted = ['{"a": "none", "b.c": "y"}', '{"a": {"z": 1}, "d": "no date"}']
    bad = ['{"a": 1', 'plain text']
    odd = ['[1, 2]', '7', 'null', '"text"']
    path = os.path.join(tmp_path, "in")
    os.makedirs(path)
    with open(os.path.join(path, "x.json"), "w") as f:
        f.write("\n".join([*good, "", *drifted, "   ", *bad, *odd]))
    rows, rejects = read_json_checked(spark, path, SCHEMA)
    got = rows.collect()
    assert rows.columns == ["a", "b.c", "d", "drifted"] and len(got) == len(good) + len(drifted)
    assert [r.drifted for r in got] == [[], [], [], [], ["a"], ["a", "d"]]
    assert got[0].a == 1 and got[0]["b.c"] == "x" and str(got[0].d) == "2020-01-02" and got[3]["b.c"] == "ü"
    assert [(r.value, r.reason) for r in rejects.collect()] == [(x, "malformed") for x in bad] + [(x, "not an object") for x in odd]


def test_empty_input(spark, tmp_path):
    path = os.path.join(tmp_path, "in")
    os.makedirs(path)
    open(os.path.join(path, "x.json"), "w").close()
    rows, rejects = read_json_checked(spark, path, SCHEMA)
    assert rows.collect() == [] and rejects.collect() == []


def test_bitmap_counts(spark):
    df = spark.createDataFrame([(g, k) for g in (0, 1) for k in [0, 1, 1, 32767, 32768, 100_000, None, 0] if g or k != 1],
                               "g int, k long")
    got = {r.g: r.n_distinct for r in distinct_by_bitmap(df, F.col("k"), {"g": F.col("g")}).collect()}
    assert got == {0: 4, 1: 5}
    assert distinct_by_bitmap(df, F.col("k")).first().n_distinct == 5
    assert distinct_by_bitmap(df.filter("k IS NULL"), F.col("k"), {"g": F.col("g")}).first().n_distinct == 0
    assert distinct_by_bitmap(df.limit(0), F.col("k")).first().n_distinct == 0


def test_no_key_crosses_the_shuffle(spark):
    df = spark.range(100_000)
    plan = distinct_by_bitmap(df, F.col("id"))._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    at = next(i for i, x in enumerate(lines) if "partial_bitmap_construct_agg" in x)
    exchanges = [i for i, x in enumerate(lines) if "Exchange hashpartitioning" in x]
    assert exchanges and max(exchanges) < at and not any("_number" in lines[i] for i in exchanges)
