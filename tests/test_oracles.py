"""Every registered query against its SQL counterpart, and the entry points themselves."""

import __spark_entry__ as entry_points
import pytest
from compare import compare, database

from tillstar import registry

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, con, name):
    good, note = compare(spark, con, name, FOLDER)
    assert good, note


def test_every_oracle_has_a_query():
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_every_query_has_an_oracle():
    assert set(registry.queries()) <= set(entry_points.oracle_sql())


def test_entry(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["year", "month", "month_name", "txn_count", "total_amount", "avg_amount"]
    assert df.count() > 0
