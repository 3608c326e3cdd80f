"""Every SQL form against its query, on the smallest given tables."""

import pytest

from oracle import compare, connect
from tidemark.llm.queries import REGISTERED, STATEMENTS

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(STATEMENTS))
def test_query_equals_its_sql(spark, connection, name):
    assert compare(spark, connection, FOLDER, REGISTERED[name], STATEMENTS[name]) is None
