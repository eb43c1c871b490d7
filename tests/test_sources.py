import json

from pyspark.sql import functions as F

from sheaf.operators.columns import sanitize_names
from sheaf.operators.rollups import review_rollup
from sheaf.session import scratch_path
from sheaf.sources.json import flatten_structs, read_json, read_table


def test_nested_json_flattens_to_dotted_names(spark):
    path = scratch_path(spark, "nested").replace("file:", "")
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.json", "w") as f:
        f.write(json.dumps({"business_id": "b1", "attributes": {"RestaurantsTakeOut": "True",
                                                                "Parking": {"garage": False}},
                            "hours": {"Monday": "8:0-17:0"}}) + "\n")
        f.write("not json\n")
    df = flatten_structs(read_json(spark, path, schema=(
        "business_id string, attributes struct<RestaurantsTakeOut: string, "
        "Parking: struct<garage: boolean>>, hours struct<Monday: string>")))
    assert df.columns == ["business_id", "attributes.RestaurantsTakeOut",
                          "attributes.Parking.garage", "hours.Monday"]
    rows = sanitize_names(df).collect()
    assert rows[0].attributes_RestaurantsTakeOut == "True" and rows[0].hours_Monday == "8:0-17:0"
    assert rows[1].business_id is None  # malformed line: a null row, no failure


def test_declared_schema_reads_dotted_flat_names(spark):
    path = scratch_path(spark, "flat").replace("file:", "")
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.json", "w") as f:
        f.write(json.dumps({"business_id": "b1", "hours.Friday": "9:0-22:0", "stars": 4.5}) + "\n")
    r = read_table(spark, "business", path).first()
    assert r["hours.Friday"] == "9:0-22:0" and r["stars"] == 4.5 and r["categories"] is None


def test_rollup_under_a_hot_key(spark):
    rows = [(f"r{i}", "hot" if i % 3 == 0 else f"b{i % 50}", float(i % 5 + 1), i % 4, i % 3, i % 2,
             "2020-03-01") for i in range(30000)]
    df = spark.createDataFrame(rows, "review_id string, business_id string, stars double, "
                                     "cool bigint, funny bigint, useful bigint, date string")
    got = {r.business_id: r for r in review_rollup(df, "2020-03-31").collect()}
    hot = [r for r in rows if r[1] == "hot"]
    assert got["hot"].nbr_reviews == len(hot) == 10000
    assert got["hot"].total_cool == sum(r[3] for r in hot)
    assert got["hot"].total_votes == sum(r[3] + r[4] + r[5] for r in hot)
    assert got["hot"].avg_stars == round(sum(r[2] for r in hot) / len(hot), 2)


def test_nested_business_records_read_like_flat_ones(spark):
    path = scratch_path(spark, "business").replace("file:", "")
    import os
    os.makedirs(path)
    with open(f"{path}/part-0.json", "w") as f:
        f.write(json.dumps({"business_id": "b1", "attributes": {"RestaurantsTakeOut": "True"},
                            "hours": {"Monday": "8:0-17:0"}}) + "\n")
        f.write(json.dumps({"business_id": "b2", "attributes.RestaurantsTakeOut": "False", "hours": None}) + "\n")
    a, b = sorted(read_table(spark, "business", path).collect(), key=lambda r: r["business_id"])
    assert a["attributes.RestaurantsTakeOut"] == "True" and a["hours.Monday"] == "8:0-17:0"
    assert b["attributes.RestaurantsTakeOut"] == "False" and b["hours.Monday"] is None


def test_tables_are_read_with_their_present_schema(spark):
    from sheaf.sources.tables import load
    path = scratch_path(spark, "sf")
    spark.range(3).write.parquet(f"{path}/region.parquet")
    assert load(spark, path, "region").columns == ["id"]
    spark.range(3).withColumn("more", F.lit(1)).write.mode("overwrite").parquet(f"{path}/region.parquet")
    assert load(spark, path, "region").columns == ["id", "more"]


def test_clean_scratch_removes_what_was_written(spark, monkeypatch):
    import os

    from sheaf import session
    monkeypatch.setattr(session, "_SCRATCH", [])  # leave the tables of other tests alone
    kept = session.materialize(spark.range(3), "gone")
    folder = kept.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]
    assert os.path.isdir(folder) and session.clean_scratch(spark) == 1
    assert not os.path.exists(folder) and session.clean_scratch(spark) == 0


def test_materialize_round_trip(spark):
    from sheaf.session import materialize
    df = spark.createDataFrame([(1, None, 2.5), (2, "x", None)],
                               "k bigint, `days_since last_tip` string, `a.b` double")
    a = materialize(df, "t")
    b = materialize(df, "t")
    assert a.columns == df.columns and a.dtypes == df.dtypes
    assert sorted(tuple(r) for r in a.collect()) == sorted(tuple(r) for r in df.collect())
    assert a.inputFiles()[0].rsplit("/", 1)[0] != b.inputFiles()[0].rsplit("/", 1)[0]
