"""Every registered query against its SQL on the smallest tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
import compare  # noqa: E402
from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from lastword.plans.catalogue import ENTRIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return compare.database(FOLDER)


def test_every_query_has_its_sql():
    assert set(ENTRIES) <= set(oracle_sql()) and set(ENTRIES) <= set(queries())


@pytest.mark.parametrize("name", list(ENTRIES))
def test_query_equals_its_sql(spark, db, name):
    _, problem, _ = compare.compare(spark, db, FOLDER, name)
    assert problem is None


def test_entry(spark):
    assert entry(spark).count() > 0
