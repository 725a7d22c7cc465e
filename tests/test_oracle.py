"""Every query against its SQL."""

import compare
import pytest
from compare import DATA

import __spark_entry__ as entry


@pytest.fixture(scope="module")
def duck():
    return compare.connect(DATA)


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(entry._CHECKS) <= set(entry.oracle_sql())


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


# The queries of the training-data package are compared in its own tests.
@pytest.mark.parametrize("name", sorted(entry._CHECKS))
def test_query_equals_sql(spark, duck, name):
    rows = entry.queries()[name](spark, DATA)
    assert compare.difference(rows, duck, entry.oracle_sql()[name]) is None
