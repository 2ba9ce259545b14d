"""Importance resampling: draws the documents that look most like a target collection, by hashed n-grams.

A document's features are its runs of one to ``max_words`` consecutive terms, joined by one space; a feature's bucket is
the CRC-32 of its bytes modulo ``buckets``.  Each document is scanned once: the CRC of the text from its start to every
term's end is kept, and the CRC of any run follows from two of these.  With A the text before the run and B the run,
``crc(AB) = shift(crc(A), len(B)) xor crc(B)``, where shifting by n bytes is a linear map over GF(2).  The maps of
1, 2, 4, 8, ... bytes are tables, so a run of any length costs a few look-ups whatever its number of terms.

Bucket counts of documents and target are a fixed number of sums, added up in the tasks first.  A bucket's gain is the
smoothed log ratio of its shares; a document's weight is the sum over its features.  Gumbel noise from a hash of the
document's id turns weights into scores whose highest are a draw without replacement.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache
from itertools import accumulate
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid.llm.common import col, text_of, written
from lossgrid.llm.terms import terms_of
from lossgrid.operators.scale import distributed_row_number

#: The reflected polynomial of CRC-32.
POLYNOMIAL = 0xEDB88320

#: Terms whose features are worked out at a time.
BLOCK_TERMS = 200_000


# -- running CRCs ------------------------------------------------------------


@cache
def _byte_table() -> np.ndarray:
    """What feeding a zero byte to the register makes of each low byte."""
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = (out >> np.uint32(1)) ^ (np.uint32(POLYNOMIAL) * (out & np.uint32(1)))
    return out


def _apply(tables: np.ndarray, crcs: np.ndarray) -> np.ndarray:
    """A linear map of 32 bits, given by a table for each byte."""
    out = tables[0][crcs & np.uint32(0xFF)]
    for k in range(1, 4):
        out ^= tables[k][(crcs >> np.uint32(8 * k)) & np.uint32(0xFF)]
    return out


@cache
def _shift_by_power(power: int) -> np.ndarray:
    """The map of shifting by ``2**power`` bytes: the one before, twice."""
    each = np.arange(256, dtype=np.uint32) << (np.arange(4, dtype=np.uint32) * np.uint32(8))[:, None]
    if power:
        half = _shift_by_power(power - 1)
        return _apply(half, _apply(half, each))
    return _byte_table()[each & np.uint32(0xFF)] ^ (each >> np.uint32(8))


def shifted(crcs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """CRCs as they enter the CRC of a text that goes on for ``lengths`` bytes."""
    out = crcs.copy()
    for power in range(int(lengths.max(initial=0)).bit_length()):
        on = np.flatnonzero((lengths >> power) & 1)
        out[on] = _apply(_shift_by_power(power), out[on])
    return out


def after_space(crcs: np.ndarray) -> np.ndarray:
    """CRCs of the same texts with a space behind."""
    register = ~crcs
    return ~(_byte_table()[(register ^ np.uint32(32)) & np.uint32(0xFF)] ^ (register >> np.uint32(8)))


def running_crcs(terms: list[bytes]) -> np.ndarray:
    """For each term the CRC of the normalised text up to its end."""
    scan = accumulate(terms[1:], lambda crc, term: crc32(term, crc32(b" ", crc)), initial=crc32(terms[0]))
    return np.fromiter(scan, dtype=np.uint32, count=len(terms))


def feature_crcs(documents: list[list[bytes]], max_words: int) -> tuple[np.ndarray, np.ndarray]:
    """CRC-32 of every feature of every document, and the number of its document."""
    filled = [k for k, terms in enumerate(documents) if terms]
    if not filled:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    sizes = np.array([len(documents[k]) for k in filled])
    ends = np.concatenate([running_crcs(documents[k]) for k in filled])
    owner = np.repeat(np.array(filled), sizes)
    length = np.fromiter((len(t) for k in filled for t in documents[k]), dtype=np.int64, count=len(ends))
    first = np.zeros(len(ends), dtype=bool)
    first[np.cumsum(sizes) - sizes] = True
    starts = np.empty_like(ends)
    starts[1:] = after_space(ends[:-1])
    starts[first] = 0  # nothing stands before a document's first term
    # where terms end, were all documents one text; only differences within a document are used
    end_at = np.cumsum(length + 1)
    start_at = end_at - length
    crcs, owners = [], []
    for width in range(1, max_words + 1):
        head = np.arange(len(ends) - width + 1)
        tail = head + width - 1
        head = head[owner[head] == owner[tail]]
        tail = head + width - 1
        crcs.append(ends[tail] ^ shifted(starts[head], end_at[tail] - start_at[head]))
        owners.append(owner[head])
    return np.concatenate(crcs), np.concatenate(owners)


def _blocks(texts: Iterator[str]) -> Iterator[list[list[bytes]]]:
    """Terms of the texts, some documents at a time; a long document is a block of its own."""
    block, size = [], 0
    for text in texts:
        terms = terms_of(text)
        block.append(terms)
        size += len(terms)
        if size >= BLOCK_TERMS:
            yield block
            block, size = [], 0
    if block:
        yield block


# -- counts, weights, draw ---------------------------------------------------


def bucket_counts(docs: DataFrame, buckets: int, max_words: int, text_col: str = "text") -> DataFrame:
    """``bucket``, ``n``: how many features of all texts fall into each bucket that has any."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, dtype=np.int64)
        for block in _blocks(text for batch in batches for text in batch["text"]):
            crcs, _ = feature_crcs(block, max_words)
            total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pd.DataFrame({"bucket": held, "n": total[held]})

    rows = docs.select(text_of(text_col).alias("text")).mapInPandas(count, "bucket long, n long")
    return rows.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int, max_words: int, text_col: str = "text") -> np.ndarray:
    """A gain for every bucket; what reaches the driver is one row for each of ``buckets`` at most."""
    held = bucket_counts(docs, buckets, max_words, text_col).withColumnRenamed("n", "s")
    wanted = bucket_counts(target, buckets, max_words, text_col).withColumnRenamed("n", "t")
    s, t = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for row in held.join(wanted, "bucket", "full").select("bucket", "s", "t").collect():
        s[row["bucket"]], t[row["bucket"]] = row["s"] or 0, row["t"] or 0
    all_s, all_t = int(s.sum()), int(t.sum())
    ratio = ((a + 1) * (all_s + buckets) / ((b + 1) * (all_t + buckets)) for a, b in zip(t.tolist(), s.tolist()))
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], dtype=np.int64)


def weighted(docs: DataFrame, gains: np.ndarray, max_words: int, id_col: str, text_col: str) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features`` and ``weight`` of every row."""
    buckets = np.uint32(len(gains))

    def weigh(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            out = []
            for block in _blocks(iter(texts)):
                crcs, owners = feature_crcs(block, max_words)
                features = np.bincount(owners, minlength=len(block))
                order = np.argsort(owners, kind="stable")
                upto = np.concatenate([[0], np.cumsum(gains[crcs[order] % buckets])])
                ends = np.cumsum(features)
                out += zip(map(len, block), features.tolist(), (upto[ends] - upto[ends - features]).tolist())
            yield pd.DataFrame(out, columns=["n_words", "n_features", "weight"])

    measure = F.pandas_udf(weigh, "n_words long, n_features long, weight long")
    rows = docs.select(col(id_col).cast("long").alias("doc_id"), measure(text_of(text_col)).alias("m"))
    return rows.select("doc_id", "m.*")


def gumbel_noise(doc_id: Column, seed: str) -> Column:
    """Thousandths of a Gumbel variate, from a hash of the document's id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.log(-F.log((h + 0.5) / 4294967296.0)) * -1000.0)


def resample(
    docs: DataFrame,
    target: DataFrame,
    buckets: int = 10_000,
    max_words: int = 2,
    percent: int = 10,
    least_words: int = 20,
    seed: str = "2024",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` of every row of ``docs``.

    Of the N documents with at least ``least_words`` terms the ``floor(percent * N / 100)`` with the highest scores are
    drawn; ``rank`` counts them from 1, equal scores by smaller id (no id first), and is null for all others.

    A null or empty text has no features and weight 0.  A document without an id gets the noise of the empty id.
    Rows that repeat an id are documents of their own with the same noise; equal rows come in either order.  Very
    long texts are scanned whole.  An empty ``target`` or ``docs`` counts as no features: gains come from the smoothing
    alone, and an empty ``docs`` gives no rows.  Other columns of the tables are neither read nor returned.
    """
    gains = bucket_gains(docs, target, buckets, max_words, text_col)
    measured = weighted(docs, gains, max_words, id_col, text_col)
    scored = written(
        measured.withColumn("score", F.col("weight") + gumbel_noise(F.col("doc_id"), seed)), "scored"
    )
    eligible = F.col("n_words") >= least_words
    drawn = scored.where(eligible).count() * percent // 100
    ranked = distributed_row_number(
        scored.where(eligible).withColumn("_down", -F.col("score")), [], ["_down", "doc_id"], "rank"
    ).drop("_down")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    others = scored.where(~eligible).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(others).select("doc_id", "n_words", "n_features", "weight", "score", "rank")
