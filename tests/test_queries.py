import pytest
from oracle import check

from ploidlake.queries import domain, problems

ALL = problems.QUERIES | domain.QUERIES
SQL = problems.SQL | domain.SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, data, name):
    check(spark, data, ALL[name], SQL[name])


def test_queries_without_sql_are_tested_elsewhere():
    assert set(ALL) - set(SQL) == {"genotype", "reassign_density", "rescue_density", "lis_merge", "greedy_pairs"}  # tests/test_walks.py


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
