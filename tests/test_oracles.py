"""Every query with SQL against that SQL, on the smallest data set."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check import compare, connect
from conftest import SF


@pytest.fixture(scope="module")
def db():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, db, name):
    ok, note = compare(spark, db, SF, name, queries()[name], oracle_sql()[name])
    assert ok, note


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())
