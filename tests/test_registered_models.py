"""Every registered query without oracle SQL runs and returns its expected row count."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"
EXPECTED = {"cv_grid_metrics": 6, "rf_grid_metrics": 3, "lr_metrics": 1, "rf_metrics": 1, "feature_importance": 10,
            "lr_predict": None, "rf_predict": None, "random_split": None, "forest_importance_of_nodes": None}


def test_list_of_queries_without_sql():
    sqls = E.oracle_sql()
    assert {k for k in E.queries() if k not in sqls and k != "pipeline" and not k.startswith("op")} == set(EXPECTED)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_runs(spark, name):
    n = len(E.queries()[name](spark, SF).collect())
    if name == "random_split":
        assert n == E.queries()["feature_join"](spark, SF).count()
    else:
        assert n == EXPECTED[name] or (EXPECTED[name] is None and n > 0)
