"""Every registered query against its SQL on the smallest shared tables."""

from __future__ import annotations

import os

import pytest

from oracle import compare, connect
from palimpsest.suite import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no shared tables here")


@pytest.fixture(scope="module")
def db():
    return connect(DATA)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    problem, _ = compare(spark, db, DATA, QUERIES[name], ORACLE[name])
    assert problem is None, problem


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
