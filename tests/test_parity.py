"""Every query with a SQL twin agrees with DuckDB on the small fixture."""

from __future__ import annotations

import pytest

from conftest import SMALL
from parity import compare
from tillwise.plans.registry import oracle_sql, queries

SQL = oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, duck_small, name):
    ok, msg = compare(queries()[name](spark, SMALL), duck_small, SQL[name])
    assert ok, msg


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
