"""Every job against its SQL on the same tables."""

import compare
import pytest

import __spark_entry__ as entry

JOBS = {name: job for name, job in entry.queries().items() if name in entry._JOBS}
SQL = {name: sql for name, sql in entry.oracle_sql().items() if name in entry._JOBS}


@pytest.fixture(scope="module")
def con(sf_dir):
    return compare.connect(sf_dir)


def test_every_job_has_sql():
    assert set(JOBS) == set(SQL)


@pytest.mark.parametrize("name", sorted(JOBS))
def test_job_equals_sql(spark, sf_dir, con, name):
    assert compare.diff(JOBS[name](spark, sf_dir), con, SQL[name]) == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0
