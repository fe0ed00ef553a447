"""Every registered query against its SQL oracle, on the smallest tables."""

import os
from pathlib import Path

import pytest
from oracle_compare import connect, differences

import __spark_entry__ as entry
from verification.registry import REGISTRY

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_survey_query_has_an_oracle():
    assert set(REGISTRY) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query(spark, connection, name):
    result = entry.queries()[name](spark, SF_DIR)
    assert differences(result, connection, entry.oracle_sql()[name]) is None
