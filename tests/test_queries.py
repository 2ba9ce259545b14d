"""Every registered query runs; every one with an SQL text matches it value by value."""

import pytest
from conftest import SF
from oracle import compare

from lossgrid.plans.registry import load_all

QUERIES = load_all()


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, con, key):
    status, note = compare(spark, con, QUERIES[key], SF)
    assert status in ("ok", "rows"), f"{key}: {note}"


def test_contract(spark):
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() == 3
