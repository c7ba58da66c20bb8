"""Every registered query with SQL against its SQL. QUERIES=name,name runs some of them."""

import os

import pytest

import __spark_entry__ as entry
import check
from panelwright.plans import catalog

SF = "/root/testdata/sf0.001"
NAMES = os.environ["QUERIES"].split(",") if os.environ.get("QUERIES") else list(catalog.ORACLES)


@pytest.fixture(scope="module")
def duck():
    return check.duck(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_agrees_with_sql(spark, duck, name):
    """The same rows, and at least one."""
    assert check.compare(entry.queries()[name](spark, SF), duck, entry.oracle_sql()[name]) is None


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
