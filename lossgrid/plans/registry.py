"""Query registry: each entry pairs a DataFrame plan with an independent SQL text.

``money`` names double columns compared at 2 decimals (sums of amounts), ``cents``
at 4 (sums of amounts that carry at most 4), ``ratio`` at 6; rounding happens only at this outer edge, on both
sides, because floating-point sums depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.sources.tables import BASE_TABLES, DERIVED, Tables, references


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Tables], DataFrame]
    sql: str | None
    rounding: dict[str, int]

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Tables.of(spark, sf_dir))
        if not self.rounding:
            return df
        return df.select(
            *[F.round(F.col(c), self.rounding[c]).alias(c) if c in self.rounding else F.col(c) for c in df.columns]
        )

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        body = self.sql.strip()
        if self.rounding:
            terms = ", ".join(f"round({c}, {d}) AS {c}" for c, d in self.rounding.items())
            body = f"SELECT * REPLACE ({terms}) FROM (\n{body}\n) AS answer"
        return with_tables(body)


QUERIES: dict[str, Query] = {}

# tables only the SQL texts use (the Spark side reaches the same rows through operators)
SQL_ONLY: dict[str, str] = {}


def query(key: str, sql: str | None = None, money: str = "", ratio: str = "", cents: str = ""):
    """Register ``build(tables)`` under ``key``."""

    def register(build):
        if key in QUERIES:
            raise ValueError(f"duplicate query {key}")
        rounding = {c: 2 for c in money.split()} | {c: 4 for c in cents.split()} | {c: 6 for c in ratio.split()}
        QUERIES[key] = Query(key, build, sql, rounding)
        return build

    return register


def _closure(sql: str, seen: dict[str, str]) -> None:
    for name in references(sql):
        text = SQL_ONLY.get(name) or DERIVED.get(name)
        if text is None:
            if name not in BASE_TABLES:
                raise KeyError(f"unknown table {name}")
        elif name not in seen:
            _closure(text, seen)
            seen[name] = text


def with_tables(sql: str) -> str:
    """Prefix the CTEs a text refers to and resolve its ``{table}`` marks."""
    ctes: dict[str, str] = {}
    _closure(sql, ctes)
    plain = {n: n for n in (*BASE_TABLES, *DERIVED, *SQL_ONLY)}
    body = sql.format(**plain)
    if not ctes:
        return body
    parts = ",\n".join(f"{name} AS ({text.format(**plain).strip()})" for name, text in ctes.items())
    return f"WITH {parts}\n{body}"


def load_all() -> dict[str, Query]:
    """Import every query module once."""
    from lossgrid.plans import (  # noqa: F401
        q_explain,
        q_features,
        q_joins,
        q_models,
        q_quality,
        q_reports,
        q_rules,
        q_sinks,
        q_stress,
        q_streams,
        q_windows,
    )

    return QUERIES
