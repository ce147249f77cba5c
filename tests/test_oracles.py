"""Every registered query against its SQL oracle, over whole tables."""

import pytest

import __spark_entry__ as entry_points
from workload.check import compare, connect
from workload.oracles import ORACLES
from workload.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    # The corpus operators, where they are installed, come on top.
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


def test_entry_returns_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_oracle(spark, duck, sf_dir, name):
    assert compare(spark, duck, name, sf_dir) == ""
