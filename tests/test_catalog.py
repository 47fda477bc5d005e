"""Every catalogue query against its SQL on the smallest driver tables."""

import os

import pytest
from check_oracle import compare, connect

import __spark_entry__ as entry

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no driver tables")


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "video_key"


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, name):
    sql = entry.oracle_sql().get(name)
    assert compare(spark, connect(FOLDER), FOLDER, name, entry.queries()[name], sql) is None
