"""Every registered query against its SQL oracle."""

import pytest
from oracle import compare, connect

from __spark_entry__ import entry
from barloom.oracles import ORACLES
from barloom.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert compare(spark, con, name, SF_DIR).startswith("ok ")


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry_has_eight_metrics(spark):
    assert entry(spark).count() == 8
