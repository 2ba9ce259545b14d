"""Line de-duplication across documents with DataFrame functions only.

The text itself is shuffled once, at the end.  What is counted, joined and grouped before that are line hashes of 128 bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import SPACES, col, free_names, text_of

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rank of a missing document id: such rows count as one document after all others.
LAST_ID = (1 << 63) - 1


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """What makes two lines equal: stripped at both ends, ASCII capitals lowered."""
    stripped = F.btrim(line, F.lit(SPACES))
    plain = F.octet_length(stripped) == F.length(stripped)  # then lower() touches ASCII capitals alone, and is faster
    return F.when(plain, F.lower(stripped)).otherwise(F.translate(stripped, UPPER, UPPER.lower()))


def _hashes(value: Column, *names: str) -> list[Column]:
    """128 bits of a text: two hashes with different seeds."""
    return [F.xxhash64(F.lit(seed), value).alias(name) for seed, name in enumerate(names)]


def drop_repeated_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, min_docs: int = 2
) -> DataFrame:
    """``docs`` with ``text_col`` cleaned, and ``n_lines`` and ``n_dropped`` (replaced if ``docs`` has such columns).

    A key of at least ``min_chars`` code points in at least ``min_docs`` documents stays in the document with the
    smallest id alone.  Null and empty texts are one empty line.  Rows that share an id are one document: none of them
    makes a line a repeat for another.  Rows without an id are one document after all others.  An empty table stays
    empty; all other columns pass through untouched.
    """
    order, d1, d2, lines, gone = free_names(docs, "_doc", "_d1", "_d2", "_lines", "_gone")
    rows = docs.select(
        "*",
        F.coalesce(col(id_col).cast("long"), F.lit(LAST_ID)).alias(order),
        *_hashes(text_of(text_col), d1, d2),
    )
    seen = rows.select(
        F.col(order).alias("doc"),
        F.col(d1).alias("d1"),
        F.col(d2).alias("d2"),
        F.posexplode(lines_of(text_of(text_col))).alias("pos", "line"),
    )
    seen = seen.select("doc", "d1", "d2", "pos", line_key(F.col("line")).alias("key"))
    seen = seen.where(F.length("key") >= min_chars).select("doc", "d1", "d2", "pos", *_hashes(F.col("key"), "k1", "k2"))

    repeated = (
        seen.groupBy("k1", "k2", "doc")
        .agg(F.lit(1).alias("one"))
        .groupBy("k1", "k2")
        .agg(F.count("*").alias("docs"), F.min("doc").alias("first"))
        .where(F.col("docs") >= min_docs)
        .select("k1", "k2", "first")
    )
    # the third key makes both sides of the join arrive by a shuffle of its own, so that a very common line is split
    both = F.col("k1").bitwiseXOR(F.col("k2")).alias("k")
    drops = (
        seen.select("*", both)
        .join(repeated.select("*", both), ["k1", "k2", "k"])
        .where(F.col("doc") > F.col("first"))
        .groupBy("doc", "d1", "d2")
        .agg(F.collect_set("pos").alias("gone"))
    )

    marked = rows.join(drops.toDF(order, d1, d2, gone), [order, d1, d2], "left").withColumn(
        lines, lines_of(text_of(text_col))
    )
    kept = F.array_except(
        F.sequence(F.lit(0), F.size(lines) - 1), F.coalesce(F.col(gone), F.array().cast("array<int>"))
    )
    cleaned = F.when(F.col(gone).isNull(), text_of(text_col)).otherwise(
        F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    )
    out = {c: cleaned.alias(c) if c == text_col else col(c) for c in docs.columns if c.lower() not in COUNTS}
    return marked.select(
        *out.values(),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_dropped"),
    )


COUNTS = ("n_lines", "n_dropped")

#: DuckDB text of the query on ``documents``.
SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
marked AS (
  SELECT k.*, coalesce(k.doc_id > r.first, false) AS gone FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
