"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from telemetra import plans
from tests.oracle import connect, duck_rows, schema_mismatch, spark_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()
# The corpus queries are an optional part with tests of its own.
KEYS = sorted(set(plans.queries()) | set(ORACLES))


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("key", KEYS)
def test_query_equals_sql(spark, duck, key):
    df = QUERIES[key](spark, SF_DIR)
    assert key in ORACLES
    assert not schema_mismatch(duck, ORACLES[key], df)
    assert spark_rows(df) == duck_rows(duck, ORACLES[key])


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
