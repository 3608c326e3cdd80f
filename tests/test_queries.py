"""Every registered query against its SQL on the same files."""

import functools
import os

import pytest

import __spark_entry__ as entry_points
import oracle
from workload import queries, sql

FOLDER = os.environ.get("TIDEMARK_TESTDATA", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(FOLDER)


@pytest.fixture(scope="module", autouse=True)
def shared_passes():
    """The queries about whole passes look at one and the same pair of passes."""
    build = queries.two_passes
    kept = {}

    @functools.wraps(build)
    def once(roles):
        if roles.folder not in kept:
            kept[roles.folder] = build(roles)
        return kept[roles.folder]

    queries.two_passes = once
    yield
    queries.two_passes = build


def test_every_query_has_its_sql():
    assert set(queries.REGISTERED) == set(sql.STATEMENTS)
    assert set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry(spark):
    row = entry_points.entry(spark).first()
    assert row["insert"] > 0 and row["update"] > 0 and row["reject"] > 0


@pytest.mark.parametrize("name", sorted(queries.REGISTERED))
def test_query(spark, connection, name):
    problem = oracle.compare(
        spark, connection, FOLDER, queries.REGISTERED[name], sql.STATEMENTS[name]
    )
    assert problem is None, problem
