"""Every registered query against its SQL at the smallest scale."""

import pytest

import __spark_entry__ as spark_entry
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
CHECKED = sorted(spark_entry.oracle_sql())
UNCHECKED = sorted(set(spark_entry.queries()) - set(CHECKED))


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, con, name):
    assert differences(spark, FOLDER, name, con) is None


@pytest.mark.parametrize("name", UNCHECKED)
def test_query_without_sql_has_rows(spark, name):
    assert spark_entry.queries()[name](spark, FOLDER).head(1)


def test_every_sql_has_a_query():
    assert set(CHECKED) <= set(spark_entry.queries())


def test_entry(spark):
    assert spark_entry.entry(spark).columns[:2] == ["customer_id", "state"]
