"""Ranked lexical search by pipelined term partitioning.

Documents are indexed where they are read: a task turns some thousand documents at a time into a segment, one posting
list a term.  Terms belong to owners by how common they are.  Items travel in bundles: for every segment a bundle's
items carry sparse accumulators (document, score so far) from one owner to the next, the rarest terms first.  At an
owner the bundle is co-grouped with the segment's postings of the owner's terms, adds their integer contributions and
goes on.  After the last owner the best of each segment are merged.

Contributions are never negative, so the 20th best score so far is a bound that the final 20th best cannot fall below.
What a document can still gain is known from the terms of the owners ahead.  Accumulators that cannot reach the bound
any more are left behind, and none are opened once new ones could not reach it: the result is that of adding
everything, ties included.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lossgrid.llm.common import col, text_of, written
from lossgrid.llm.terms import PATTERN, terms_of

#: Documents in a segment and items in a bundle (on average): what one group of a stage holds.
SEGMENT_DOCS, BUNDLE_ITEMS = 4000, 256

#: Owners by the share of documents that hold a term: below the first share, below the second, ..., all others.
SHARES = (0.001, 0.01, 0.1)

#: The items' terms are first sifted by one bit for each value of so many hash bits; what slips through is joined away.
SIFT_BITS = 20

#: Stands for a missing id inside the operator.
NONE = -(1 << 63)

INDEX = "segment long, term string, df long, most long, total long, docs binary, counts binary"
STATE = "segment long, bundle int, item long, docs binary, scores binary, best array<bigint>"
FOUND = "item long, doc_id long, score long"


def _posting_lists(batches: Iterator[pd.DataFrame], sieve: bytes) -> Iterator[pd.DataFrame]:
    """Segments of a task: a row for each term, and one without a term for the documents' lengths and ids."""
    asked = np.unpackbits(np.frombuffer(sieve, dtype=np.uint8)).astype(bool).tolist()
    mask = len(asked) - 1
    segment = TaskContext.get().partitionId() << 33
    ids: list[int] = []
    sizes: list[int] = []
    lists: dict[bytes, tuple[list[int], list[int]]] = {}

    def rows() -> pd.DataFrame:
        out = [
            (segment, term.decode("utf-8", "replace"), len(docs), max(counts), 0, _bytes(docs, "<u4"), _bytes(counts, "<u4"))
            for term, (docs, counts) in lists.items()
        ]
        filled = sum(1 for n in sizes if n)
        out.append((segment, None, filled, 0, sum(sizes), _bytes(sizes, "<i8"), _bytes(ids, "<i8")))
        return pd.DataFrame(out, columns=["segment", "term", "df", "most", "total", "docs", "counts"])

    for batch in batches:
        for doc, text in zip(batch["doc_id"].tolist(), batch["text"]):
            terms = terms_of(text)
            place = len(ids)
            ids.append(doc)
            sizes.append(len(terms))
            for term, count in Counter(terms).items():
                if asked[crc32(term) & mask]:
                    held = lists.get(term)
                    if held is None:
                        held = lists[term] = ([], [])
                    held[0].append(place)
                    held[1].append(count)
            if len(ids) >= SEGMENT_DOCS:
                yield rows()
                segment, ids, sizes, lists = segment + 1, [], [], {}
    if ids:
        yield rows()


def _bytes(values: list[int], kind: str) -> bytes:
    return np.array(values, dtype=kind).tobytes()


def _at_owner(
    bundle: pd.DataFrame, postings: pd.DataFrame, documents: int, length: int, top: int, last: bool
) -> pd.DataFrame:
    """A bundle's accumulators in one segment with the contributions of one owner's terms."""
    whole = postings["term"].isna()
    sizes = np.frombuffer(postings.loc[whole, "docs"].iloc[0], dtype="<i8")
    ids = np.frombuffer(postings.loc[whole, "counts"].iloc[0], dtype="<i8")
    m = 75 + 25 * sizes * documents // max(length, 1)
    gains: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    held = postings[~whole]
    for weight, items, docs, counts in zip(held["weight"], held["items"], held["docs"], held["counts"]):
        at = np.frombuffer(docs, dtype="<u4")
        tf = np.frombuffer(counts, dtype="<u4").astype(np.int64)
        each = int(weight) * (1_000_000_000 * tf // (1000 * tf + 12 * m[at]))
        for asked in items:
            gains.setdefault(asked["item"], []).append((at, each * asked["times"]))
    out = []
    scores = np.zeros(len(sizes), dtype=np.int64)
    columns = zip(*(bundle[c] for c in ("segment", "bundle", "item", "docs", "scores", "ahead", "beyond", "bound")))
    for segment, group, item, docs, so_far, ahead, beyond, bound in columns:
        scores[:] = 0
        open_ = np.frombuffer(docs, dtype="<u4")
        scores[open_] = np.frombuffer(so_far, dtype="<i8")
        for at, each in gains.get(item, ()):
            scores[at] += each
        if ahead < bound:  # what is not open yet cannot get there
            kept = open_[scores[open_] > 0]
        else:
            kept = np.flatnonzero(scores)
        kept = kept[scores[kept] + beyond >= bound]
        if last:
            if len(kept) > top:
                cutoff = np.partition(scores[kept], len(kept) - top)[len(kept) - top]
                kept = kept[scores[kept] >= cutoff]
            order = kept[np.lexsort((ids[kept], -scores[kept]))][:top]
            out += [(item, doc, score) for doc, score in zip(ids[order].tolist(), scores[order].tolist())]
        else:
            best = scores[kept]
            if len(best) > top:
                best = np.partition(best, len(best) - top)[len(best) - top :]
            out.append((segment, group, item, kept.astype("<u4").tobytes(), scores[kept].tobytes(), best.tolist()))
    names = ["item", "doc_id", "score"] if last else ["segment", "bundle", "item", "docs", "scores", "best"]
    return pd.DataFrame(out, columns=names)


def _best_so_far(state: DataFrame, top: int) -> DataFrame:
    """``item``, ``bound``: the score so far that ``top`` documents of all segments have at least."""
    scores = state.select("item", F.explode("best").alias("score"))
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score")))
    first = scores.withColumn("place", place).where(F.col("place") <= top)
    return first.groupBy("item").agg(F.count("*").alias("n"), F.min("score").alias("bound")).where(F.col("n") == top).drop("n")


def _terms(table: DataFrame) -> DataFrame:
    """``item``, ``term``, ``times``."""
    split = F.pandas_udf(lambda texts: texts.map(lambda t: [x.decode("utf-8", "replace") for x in terms_of(t)]), "array<string>")
    rows = table.select("item", F.explode(split("text")).alias("term"))
    return rows.groupBy("item", "term").agg(F.count("*").alias("times"))


def _sieve(asked: DataFrame) -> bytes:
    """One bit for each hash value; at most ``2**SIFT_BITS`` small rows come to the driver."""
    bits = np.zeros(1 << SIFT_BITS, dtype=bool)
    hashes = asked.select((F.crc32(F.col("term").cast("binary")) % (1 << SIFT_BITS)).cast("int").alias("h")).distinct()
    bits[np.array(hashes.toPandas()["h"], dtype=np.int64)] = True
    return np.packbits(bits).tobytes()


def _most(tf: Column, m: int = 75) -> Column:
    """The largest factor of a term that no document holds more than ``tf`` times."""
    return F.floor(tf * 1_000_000_000 / (tf * 1000 + 12 * m)) + 1


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``item_id``, ``rank``, ``doc_id``, ``score``: each item's ``top`` documents with a score above 0, best first.

    A term's weight is ``floor(1000 * ln((2N + 2) / (2 df + 1)))`` for N documents with any term; a document that holds
    it tf times adds ``weight * (10^9 tf div (1000 tf + 12 m))`` for every time the item has it, with
    ``m = 75 + (25 n N) div L`` for a document of n terms and L terms in all.

    Equal scores come in the order of ids, a missing id first.  Null and empty texts have no terms and are neither found
    nor counted; very long ones are indexed whole.  Rows of ``docs`` that repeat an id are documents of their own; rows
    of ``items`` that share an id (or have none) are one item with the terms of all.  Empty tables give no rows.  Other
    columns are not returned.
    """
    rows = docs.select(F.coalesce(col(id_col).cast("long"), F.lit(NONE)).alias("doc_id"), text_of(text_col).alias("text"))
    asked = items.select(F.coalesce(col(item_col).cast("long"), F.lit(NONE)).alias("item"), text_of(item_text_col).alias("text"))
    asked = written(_terms(asked), "asked")
    sieve = _sieve(asked)
    index = written(rows.mapInPandas(lambda batches: _posting_lists(batches, sieve), INDEX), "index")

    whole = index.where(F.col("term").isNull())
    documents, length = whole.agg(F.sum("df"), F.sum("total")).first()
    documents, length = documents or 0, length or 0
    known = asked.select("term").distinct()
    held = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("df").alias("df"), F.max("most").alias("most"))
    owner = sum(((F.col("df") >= F.lit(s) * documents).cast("int") for s in SHARES), F.lit(0))
    weight = F.floor(F.log((F.lit(documents) * 2 + 2).cast("double") / (F.col("df") * 2 + 1)) * 1000)
    terms = held.join(known, "term").select("term", "most", weight.alias("weight"), owner.alias("owner"))
    query = asked.join(terms.where(F.col("weight") > 0), "term")
    n_items = asked.agg(F.count_distinct("item")).first()[0]
    bundles = max(1, -(-n_items // BUNDLE_ITEMS))
    bundle = F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int")
    query = written(query.withColumn("bundle", bundle).withColumn("limit", F.col("times") * F.col("weight") * _most(F.col("most"))), "query")

    stages = len(SHARES) + 1
    gain = [F.sum(F.when(F.col("owner") >= s, F.col("limit")).otherwise(0)) for s in range(stages + 1)]
    hopes = written(query.groupBy("bundle", "item").agg(F.array(*gain).alias("hopes")), "hopes")
    empty = F.lit(b"")
    places = whole.select("segment", F.explode(F.sequence(F.lit(0), F.lit(bundles - 1))).alias("bundle"))
    state = places.join(hopes.select("bundle", "item"), "bundle").select(
        "segment", "bundle", "item", empty.alias("docs"), empty.alias("scores"), F.array().cast("array<bigint>").alias("best")
    )
    state = written(state, "bundles")
    for s in range(stages):
        last = s == stages - 1
        of_owner = query.where(F.col("owner") == s)
        asks = of_owner.groupBy("bundle", "term", "weight").agg(F.collect_list(F.struct("item", "times")).alias("items"))
        postings = index.join(asks, "term").select("segment", "bundle", "term", "weight", "items", "docs", "counts")
        measures = whole.select("segment", "docs", "counts").join(places, "segment")
        none = (F.lit(None).cast(t).alias(n) for n, t in (("term", "string"), ("weight", "long"), ("items", "array<struct<item:bigint,times:bigint>>")))
        postings = postings.unionByName(measures.select("segment", "bundle", *none, "docs", "counts"))
        carried = state.join(hopes.select("item", F.col("hopes")[s].alias("ahead"), F.col("hopes")[s + 1].alias("beyond")), "item")
        if s:
            carried = carried.join(_best_so_far(state, top), "item", "left")
            carried = carried.withColumn("bound", F.coalesce("bound", F.lit(0)))
        else:
            carried = carried.withColumn("bound", F.lit(0).cast("long"))
        both = carried.groupBy("segment", "bundle").cogroup(postings.groupBy("segment", "bundle"))
        step = both.applyInPandas(_stage(documents, length, top, last), FOUND if last else STATE)
        state = step if last else written(step, f"owner-{s}")
    place = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return (
        state.withColumn("rank", place)
        .where(F.col("rank") <= top)
        .select(F.nullif("item", F.lit(NONE)).alias("item_id"), "rank", F.nullif("doc_id", F.lit(NONE)).alias("doc_id"), "score")
    )


def _stage(documents: int, length: int, top: int, last: bool):
    def at_owner(bundle: pd.DataFrame, postings: pd.DataFrame) -> pd.DataFrame:
        return _at_owner(bundle, postings, documents, length, top, last)

    return at_owner


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = rf"""
WITH held AS (
  SELECT doc_id, term, count(*) AS tf
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{PATTERN}')) AS term FROM documents) GROUP BY ALL),
sizes AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM held GROUP BY doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM held GROUP BY term), whole),
asked AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{PATTERN}')) AS term FROM benchmark),
scored AS (
  SELECT item_id, doc_id, CAST(sum(w * (1000000000 * tf // (1000 * tf + 12 * (75 + 25 * n * docs // terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN held USING (term) JOIN sizes USING (doc_id), whole GROUP BY item_id, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""
