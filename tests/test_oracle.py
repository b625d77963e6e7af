"""Every registered query against its check SQL, over whole tables."""

import pytest
from oracle import compare, connect

from groundsheet.plans import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    ok, note = compare(spark, con, name, SF)
    assert ok, note
