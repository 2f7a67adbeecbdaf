"""Every query against its SQL."""

import pytest

from conformance.compare import difference, oracle_connection
from conformance.oracle import ORACLE_SQL
from conformance.queries import QUERIES

JOINING = [
    "table_verification",
    "table_bad_members",
    "table_good_customers",
    "join_repayment_member",
    "score_base",
    "loan_score",
]


@pytest.fixture(scope="module")
def connection(sf_dir):
    return oracle_connection(sf_dir)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, connection, name):
    assert difference(QUERIES[name](spark, sf_dir), connection.sql(ORACLE_SQL[name]).df()) is None


@pytest.mark.parametrize("name", JOINING)
def test_query_without_broadcast(spark, sf_dir, connection, no_broadcast, name):
    assert difference(QUERIES[name](spark, sf_dir), connection.sql(ORACLE_SQL[name]).df()) is None


def test_entry(spark):
    import __spark_entry__ as driver

    assert driver.entry(spark).count() == 564
    assert set(driver.oracle_sql()) >= set(ORACLE_SQL)
    assert set(driver.queries()) >= set(driver.oracle_sql())
