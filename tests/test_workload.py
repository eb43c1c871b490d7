"""The workload from JSON-lines files gives the same base table as from the parquet fixtures."""

from pyspark.sql import functions as F

from sheaf.plans.catalog import FIX, tables
from sheaf.plans.features import base_table
from sheaf.plans.workload import run, tables_from_json
from sheaf.session import scratch_path
from sheaf.sources.json import write_json

SF = "/root/testdata/sf0.001"


def test_base_table_from_json_matches_parquet(spark):
    t = tables(spark, SF)
    paths = {}
    for name in ("business", "review", "checkin", "tip", "covid"):
        df = getattr(t, name).withColumn("business_id", F.col("business_id").cast("string"))
        if name == "review":
            df = df.withColumn("date", F.date_format("date", "yyyy-MM-dd HH:mm:ss"))
        paths[name] = write_json(df, scratch_path(spark, f"wl-{name}"))
    from_json = base_table(tables_from_json(spark, paths), FIX)
    from_parquet = base_table(t, FIX).withColumn("business_id", F.col("business_id").cast("string"))
    assert from_json.columns == from_parquet.columns
    a = sorted(tuple(r) for r in from_json.collect())
    b = sorted(tuple(r) for r in from_parquet.collect())
    assert len(a) > 0 and a == b


def test_run_produces_every_result(spark):
    out = run(tables(spark, SF), FIX, folds=2)
    assert {"base_table", "lr_grid", "rf_grid", "lr_predictions", "rf_importances"} <= set(out)
    assert 0.0 <= out["lr_auc_roc"] <= 1.0 and 0.0 <= out["rf_auc_roc"] <= 1.0
    assert out["lr_grid"].count() == 6 and out["rf_grid"].count() == 3
