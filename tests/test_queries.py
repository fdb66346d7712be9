"""Every registered query gives the rows of its SQL, and none runs on made-up input."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import differences, duck
from checks.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the test tables are not there")


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLES[name]) is None


def test_entry(spark):
    assert entry.entry(spark).count() > 0
