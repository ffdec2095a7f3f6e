"""Every registered query against its independent SQL."""

import pytest
from compare import connect, differences
from conftest import DATA

import __spark_entry__ as entry
from tapemill.catalog import QUERIES
from tapemill.oracles import ORACLES


@pytest.fixture(scope="module", params=["sf0.001"])
def data(request):
    path = f"{DATA}/{request.param}"
    con = connect(path)
    yield path, con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, data, name):
    path, con = data
    rows, diff = differences(entry.queries()[name](spark, path), con, entry.oracle_sql()[name])
    assert rows > 0
    assert not diff


def test_entry_has_rows(spark):
    assert entry.entry(spark).limit(1).count() == 1
