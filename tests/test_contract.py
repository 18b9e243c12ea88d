"""Every registered query of the library gives the rows of its SQL."""

import pytest

import __spark_entry__ as entry
from casona.plans.catalogue import QUERIES, SQL


def test_each_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_rows_of_sql(name, same_as_sql):
    same_as_sql(QUERIES[name], SQL[name])


def test_entry(spark, small):
    rows = entry.entry(spark).collect()
    assert rows and set(rows[0].asDict()) == {"listing_id", "project", "min_price", "available", "rank"}
