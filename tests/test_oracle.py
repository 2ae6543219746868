"""Every mart, view and job against independent SQL."""

import pytest
from compare import same

from medallion_marts.queries import ORACLE_SQL, QUERIES


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, small, name):
    same(QUERIES[name](spark, small), ORACLE_SQL[name], small)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
