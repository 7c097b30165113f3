"""Every registered query against its SQL on the smallest tables."""

import pytest
from compare import connect, difference

from tidegauge.plans import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def engine():
    connection = connect(FOLDER)
    yield connection
    connection.close()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, engine, name):
    frame = QUERIES[name](spark, FOLDER)
    assert len(set(frame.columns)) == len(frame.columns)
    assert difference(frame, engine, ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
