"""Every registered query against its SQL twin, over the given tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import assert_same, duckdb_over


@pytest.fixture(scope="module")
def duck(sf_dir):
    with duckdb_over(sf_dir) as connection:
        yield connection


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_query_equals_sql(spark, sf_dir, duck, key):
    assert_same(queries()[key](spark, sf_dir), duck, oracle_sql()[key])


@pytest.mark.parametrize("key", sorted(set(queries()) - set(oracle_sql())))
def test_query_without_twin_gives_rows(spark, sf_dir, key):
    assert queries()[key](spark, sf_dir).count() > 0


def test_every_twin_has_a_query():
    assert set(oracle_sql()) <= set(queries())


def test_entry(spark):
    assert entry(spark).count() == 15
