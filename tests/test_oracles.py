"""Every registered query against its SQL on the smallest data set."""

import pytest

from starloom.queries import ORACLES, QUERIES
from tests.oracle import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    assert compare(QUERIES[name](spark, SF_DIR), con, ORACLES[name]) == []
