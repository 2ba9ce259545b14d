"""Queries with an SQL text match it value by value."""

import pytest
from conftest import SF
from oracle import rows

from lossgrid.llm import queries as Q
from lossgrid.session import ship_package


@pytest.mark.parametrize("name", sorted(Q.ORACLE_SQL))
def test_matches_sql(spark, con, name):
    assert rows(Q.QUERIES[name](ship_package(spark), SF).toArrow()) == rows(
        con.execute(Q.ORACLE_SQL[name]).to_arrow_table()
    )


def test_one_query_for_each_operator():
    numbers = [int(n[2:].split("_")[0]) for n in Q.QUERIES if n != "pipeline"]
    assert sorted(numbers) == list(range(1, 14))
