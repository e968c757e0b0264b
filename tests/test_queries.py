"""Every registered query against its independent SQL."""

import pytest

import __spark_entry__ as entry
import oracles
from duebook.plans.catalog import runnable
from tests.compare import differences, duck

FOLDER = "/root/testdata/sf0.001"
QUERIES = runnable()
ORACLES = oracles.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert differences(spark, con, FOLDER, name, QUERIES[name], ORACLES.get(name)) is None


def test_entry(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert {"customer_id", "risk_score", "risk_level"} <= set(rows.columns)
