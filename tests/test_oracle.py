import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tests.conftest import SF
from workload.compare import connect, differences
from workload.queries import CATALOG

SQL = oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", [name for name in queries() if name in SQL])
def test_query_matches_duckdb(spark, con, name):
    assert differences(queries()[name](spark, SF), con, SQL[name]) == []


def test_only_corpus_operators_go_without_sql():
    assert all(name in SQL for name in CATALOG)


def test_entry(spark):
    assert entry(spark).count() > 0
