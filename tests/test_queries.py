"""Every registered query against its SQL, on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.run import compare, duck

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no driver tables here")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    result = compare(spark, con, SF_DIR, name, contract.queries()[name], contract.oracle_sql().get(name))
    assert not result.startswith("BAD"), result


def test_entry(spark):
    frame = contract.entry(spark)
    assert frame.columns == ["seq", "title", "url", "source_id", "uplifting_score"] and frame.count() > 0
