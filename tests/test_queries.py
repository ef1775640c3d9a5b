"""Every query of the lake against DuckDB."""

import pytest

import __spark_entry__ as contract
from cartlake.catalogue import QUERIES
from cartlake.oracle import ORACLE as SQL
from compare import differences, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == ""


def test_entry(spark):
    fact = contract.entry(spark)
    assert fact.count() > 0
    assert fact.columns[0] == "order_id"


def test_streams_do_not_pile_up(spark, connection):
    for _ in range(2):
        df = QUERIES["stream_clicks"](spark, FOLDER)
        assert differences(df, connection, SQL["stream_clicks"]) == ""


def test_another_session_zone_changes_nothing(spark, connection):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
        for name in ("stg_order_items", "stg_order_status_history", "fct_orders", "freshness"):
            assert differences(QUERIES[name](spark, FOLDER), connection, SQL[name]) == ""
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
