"""Every registered query against its SQL, on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check
from clearspark.plans import catalog, oracles

FOLDER = os.path.join(os.environ.get("TESTDATA", "/root/testdata"), "sf0.001")


@pytest.fixture(scope="module")
def con():
    return check.connect(FOLDER)


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(oracles.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_sql(spark, con, name):
    found = entry.queries()[name](spark, FOLDER)
    assert check.differences(found, con, entry.oracle_sql()[name]) == ""


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert {r.outcome for r in rows} == {"settled", "dead_letter"}
