"""Every job against its oracle on the smallest tables."""

import pytest
from check import connect, difference
from conftest import TABLES

from weftline.plans import all_jobs


@pytest.fixture(scope="module")
def oracle():
    return connect(TABLES)


@pytest.mark.parametrize("name", sorted(all_jobs()))
def test_job_equals_oracle(spark, oracle, name):
    job, sql = all_jobs()[name]
    problem, rows = difference(spark, oracle, TABLES, job, sql)
    assert problem is None
    assert rows > 0


def test_entry_points(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).columns == ["year", "F", "O", "P", "other", "missing", "total", "sort_key"]
