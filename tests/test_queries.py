"""Every registered query against its SQL on the smallest tables."""

import check
import pytest

import __spark_entry__ as entry
from gatewright.plans import all_queries

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return check.duck(FOLDER)


def test_every_query_has_sql():
    assert all_queries.QUERIES.keys() == all_queries.ORACLES.keys()
    assert all_queries.QUERIES.keys() <= entry.queries().keys()
    assert entry.oracle_sql().keys() <= entry.queries().keys()


@pytest.mark.parametrize("name", sorted(all_queries.QUERIES))
def test_query_equals_sql(spark, duck, name):
    verdict = check.compare(entry.queries()[name](spark, FOLDER), duck, entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_entry(spark):
    assert entry.entry(spark).count() == 7
