import os

import pytest
from compare import connect, spark_rows, sql_rows

import __spark_entry__ as entry_points
from knockwatch.plans.catalog import QUERIES
from knockwatch.plans.checks import CHECKS

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no benchmark tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(CHECKS)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(CHECKS) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF_DIR)) == sql_rows(con, CHECKS[name])
