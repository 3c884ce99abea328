"""Every registered report against its checking SQL on the smallest generated tables."""

import os

import pytest

import __spark_entry__ as registry
from sqlchecks.compare import connect, difference

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# the text operators have their own tests
QUERIES = {n: q for n, q in registry.queries().items() if n[:2] != "op" and n != "pipeline"}
STATEMENTS = {n: s for n, s in registry.oracle_sql().items() if n[:2] != "op"}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="generated tables missing")


@pytest.fixture(scope="module")
def connection():
    pytest.importorskip("duckdb")
    return connect(FOLDER)


def test_every_report_has_a_statement():
    assert set(QUERIES) == set(STATEMENTS)


@pytest.mark.parametrize("name", QUERIES)
def test_report(name, spark, connection):
    assert difference(QUERIES[name](spark, FOLDER), connection, STATEMENTS[name]) is None


def test_flagship_is_not_empty(spark):
    assert registry.entry(spark).count() == 62
