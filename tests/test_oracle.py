"""Every job against its SQL on the smallest tables."""

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tidelog.plans.compare import oracle_connection, same_rows
from tidelog.plans.jobs import JOBS
from tidelog.plans.sql import ORACLE

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are missing")


@pytest.fixture(scope="module")
def connection():
    return oracle_connection(SF_DIR)


def test_every_job_has_sql():
    assert set(JOBS) == set(ORACLE)
    assert set(JOBS) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_equals_sql(spark, connection, name):
    assert same_rows(queries()[name](spark, SF_DIR), connection, oracle_sql()[name]) is None


def test_entry(spark):
    ranges = entry(spark).collect()
    assert sorted((r["partition"], r["from_offset"], r["until_offset"], r["n"]) for r in ranges) == [
        (p, 0, 250, 250) for p in range(4)
    ]
