import pytest
from compare import compare, duck

import __spark_entry__ as entry
from vitals.plans.oracle import oracle_sql
from vitals.plans.queries import queries

SF = "/root/testdata/sf0.001"
QUERIES = entry.queries()
EXPECTED = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_query_equals_sql(spark, con, name):
    assert compare(QUERIES[name](spark, SF), con, EXPECTED[name]) == []


def test_every_query_has_sql():
    assert set(queries()) == set(oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert "health_score" in df.columns and df.count() > 0
