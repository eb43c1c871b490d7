"""Every query with an oracle SQL matches DuckDB at sf0.01 (names, row count, values)."""

import pytest

import __spark_entry__ as E
from tools.oracle_check import compare, duck

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_matches_oracle(spark, con, name):
    assert compare(spark, con, name, E.queries()[name], E.oracle_sql()[name], SF)
