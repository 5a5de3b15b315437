"""Every registered query runs, and equals its SQL where it has one."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from pricelake.plans.registry import ORACLES, QUERIES
from tests.compare import difference, duck, rows_of_duck, rows_of_spark

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    got = rows_of_spark(QUERIES[name](spark, SF_DIR))
    spark.catalog.clearCache()
    assert difference(got, rows_of_duck(con, ORACLES[name])) is None


def test_entry_has_all_queries():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())


def test_entry(spark):
    assert entry(spark).count() == 30
