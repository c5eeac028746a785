"""Each catalog query equals its DuckDB oracle (unfused reference form)."""

import os

import pytest

from buyerlens.plans.catalog import QUERIES
from buyerlens.plans.oracle import oracle_sql
from helpers import assert_same_rows
from conftest import SF_MID, SF_SMALL, register

SF = SF_MID if os.environ.get("BUYERLENS_TEST_SF") == "0.01" else SF_SMALL
ORACLE = oracle_sql()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    register(duck, SF)
    assert_same_rows(QUERIES[name](spark, SF), duck.sql(ORACLE[name]))


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert len(df.columns) == 56
    assert df.count() > 0
