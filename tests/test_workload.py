"""Every query against its SQL on the small driver tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from workload.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    function, sql = entry.queries()[name], entry.oracle_sql().get(name)
    assert compare(spark, con, name, function, sql, SF_DIR) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
