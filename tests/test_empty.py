"""Operators on empty input: no crash, empty or null results (never a division error)."""

import pytest

from sheaf.operators.encode import OneHotEncoder, WoeEncoder
from sheaf.operators.hours import opening_hours
from sheaf.operators.impute import MeanImputer
from sheaf.operators.metrics import accuracy, hard_label_metrics
from sheaf.operators.profile import (describe_numeric, iqr_bounds, missing_counts, missing_share,
                                     sparse_columns)
from sheaf.operators.rollups import checkin_rollup, review_rollup, table_shape
from sheaf.operators.topk import top_k_tokens


def test_empty_inputs(spark, ansi):
    e = spark.createDataFrame([], "x double, s string, label double, prediction double")
    assert missing_counts(e).first().asDict() == {"x": 0, "s": 0, "label": 0, "prediction": 0}
    assert missing_share(e).first().x is None
    assert sparse_columns(e) == []
    assert iqr_bounds(e, ["x"]).first().q1 is None
    assert describe_numeric(e, ["x"]).first()["count"] == 0
    assert MeanImputer(["x"]).fit(e).means == {"x": None}
    assert OneHotEncoder(["s"]).fit(e).values == {"s": []}
    with pytest.raises(ValueError):
        WoeEncoder(["s"], "label").fit(e)
    h = hard_label_metrics(e).first()
    assert h.auc_roc is None and h.accuracy is None
    assert accuracy(e).first().accuracy is None
    assert tuple(table_shape(e).first()) == (0, 4)
    assert top_k_tokens(e, "s", 5).count() == 0


def test_empty_rollups_and_hours(spark):
    r = spark.createDataFrame([], "review_id string, business_id string, stars double, cool bigint, "
                                  "funny bigint, useful bigint, date string")
    assert review_rollup(r, "2020-03-31").count() == 0
    c = spark.createDataFrame([], "business_id string, date string")
    assert checkin_rollup(c, "2020-03-31").count() == 0
    h = spark.createDataFrame([], ", ".join(f"hours_{d} string" for d in (
        "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")))
    assert opening_hours(h).count() == 0
