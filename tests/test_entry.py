import __spark_entry__ as E


def test_contract(spark):
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 60 and all(callable(f) for f in qs.values())


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert {"business_id", "delivery_or_takeout", "split"} <= set(df.columns)
    assert E.entry(spark).columns == df.columns  # stable schema
    labels = {r["delivery_or_takeout"] for r in rows}
    assert labels == {None, 0, 1}  # businesses without a label are kept
    assert len(rows) == E.queries()["feature_join"](spark, E.SMOKE_DIR).count()
