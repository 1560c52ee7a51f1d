"""Every registered query runs, and equals its SQL check, at the smallest scale."""

import oracle
import pytest

import __spark_entry__
from feedmill.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
# Covered end to end by test_jobs; slow here.
SLOW = {"job_01_load_queued_files", "job_03_06_drain_and_reset", "job_04_all_targets", "str_02_file_stream", "ddl_04_create_tables"}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", [n for n in all_queries() if n not in SLOW])
def test_query(spark, con, name):
    difference, _ = oracle.compare(spark, con, all_queries()[name], SF_DIR)
    assert difference == ""


def test_entry_points(spark):
    assert __spark_entry__.entry(spark).columns == ["tpa", "STATUS", "claims", "total", "last_service"]
    assert set(__spark_entry__.oracle_sql()) < set(__spark_entry__.queries())
