"""Side-by-side comparison of a registered query with its SQL text."""

from __future__ import annotations

import datetime as dt
import math
import time

import duckdb
import pyarrow as pa

from lossgrid.sources.tables import BASE_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in BASE_TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "~"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return str(v)


def _kind(t: pa.DataType) -> str:
    t = str(t)
    if t.startswith("large_string") or t == "string":
        return "string"
    if t.startswith("timestamp"):
        return "timestamp"
    return t


def rows(table: pa.Table) -> tuple[dict[str, str], list[tuple]]:
    names = sorted(table.column_names)
    cols = [table.column(n).to_pylist() for n in names]
    kinds = {n: _kind(table.schema.field(n).type) for n in names}
    return kinds, sorted(tuple(_canon(c[i]) for c in cols) for i in range(table.num_rows))


def compare(spark, con, q, sf_dir: str) -> tuple[str, str]:
    t0 = time.time()
    spark_kinds, got = rows(q.run(spark, sf_dir).toArrow())
    took = time.time() - t0
    if q.sql is None:
        return "rows", f"{len(got)} rows {took:.2f}s"
    t0 = time.time()
    kinds, want = rows(con.execute(q.oracle()).to_arrow_table())
    note = f"{len(got)} rows spark {took:.2f}s sql {time.time() - t0:.2f}s"
    if spark_kinds.keys() != kinds.keys():
        return "FAIL", f"columns {sorted(spark_kinds)} vs {sorted(kinds)}"
    if len(got) != len(want):
        return "FAIL", f"rows {len(got)} vs {len(want)}"
    if got != want:
        bad = [(g, w) for g, w in zip(got, want) if g != w]
        return "FAIL", f"{len(bad)} differ of {len(got)}; columns {sorted(kinds)}; first {bad[0]}"
    if spark_kinds != kinds:
        return "TYPE", f"{ {n: (spark_kinds[n], kinds[n]) for n in kinds if kinds[n] != spark_kinds[n]} }"
    return "ok", note
