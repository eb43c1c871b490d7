"""Every oracle-checked query gives the same rows with ANSI mode on and off."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import rows_of

SF = "/root/testdata/sf0.001"


# The cross-validated models are not ANSI-dependent and take minutes.
@pytest.mark.parametrize("name", sorted(set(E.oracle_sql()) - {"lr_checked", "rf_checked"}))
def test_same_answer_in_both_modes(spark, name):
    old = spark.conf.get("spark.sql.ansi.enabled")
    out = []
    try:
        for mode in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", mode)
            df = E.queries()[name](spark, SF)
            out.append(rows_of(df.columns, [tuple(r) for r in df.collect()]))
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)
    assert out[0] == out[1]
