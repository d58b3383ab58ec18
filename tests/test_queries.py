"""Every registered query against its SQL, on the smallest tables."""

import pytest

from compare import connect, differences
from checks.oracles import ORACLES
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, con, name):
    problem, n_rows, _ = differences(spark, con, SF_DIR, name)
    assert not problem
    assert n_rows > 0
