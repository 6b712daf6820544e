"""Every catalogue query against its reference SQL on the small tables."""

import pytest

import __spark_entry__ as entry
from tests import oracle

SF = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, con, name):
    assert oracle.compare(con, entry.queries()[name](spark, SF), SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_rows_only(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
