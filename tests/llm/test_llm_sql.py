"""Registered queries of the subpackage that have SQL, against DuckDB."""

import pytest

from cartlake.llm.queries import ORACLE, QUERIES
from compare import differences, duck

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return duck(FOLDER)


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, connection, name):
    assert differences(QUERIES[name](spark, FOLDER), connection, ORACLE[name]) == ""
