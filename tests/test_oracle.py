"""Every registered query against its SQL in DuckDB."""

import pytest

import __spark_entry__ as registered
from check import compare, connect
from storelens.catalog.registry import ENTRIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", list(ENTRIES))
def test_agrees_with_sql(spark, con, sf_dir, name):
    assert compare(spark, con, sf_dir, name) == ""


def test_every_query_has_sql():
    assert set(ENTRIES) <= set(registered.queries()) and set(ENTRIES) <= set(registered.oracle_sql())


def test_entry_gives_three_sellers_per_state(spark):
    rows = registered.entry(spark).collect()
    per_state = {}
    for row in rows:
        per_state.setdefault(row.state, []).append(row.total_revenue)
    assert rows and all(len(v) <= 3 and v == sorted(v, reverse=True) for v in per_state.values())
