import os

import pytest

import __spark_entry__ as entry
from checks.oracle import oracle_sql
from checks.queries import queries
from tests.oracle_run import compare, connect

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")


def test_every_query_has_sql():
    assert queries().keys() == oracle_sql().keys()
    assert queries().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", list(queries()))
def test_query_matches_sql(spark, name):
    assert compare(spark, connect(SF_DIR), SF_DIR, name) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
