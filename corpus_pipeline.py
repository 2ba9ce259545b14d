"""Corpus preparation as stages over ``documents``; each stage is written as Parquet and read by the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.llm import bpe, decontaminate, line_dedup, near_dedup, toxicity
from lossgrid.llm.common import free_names, prepare, read
from lossgrid.sources.scratch import fresh_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored below the threshold; the classifier learns from the labels of these documents."""
    prepare(spark)
    model = toxicity.fit(docs, read(spark, sf_dir, "labels"))
    (score,) = free_names(docs, "_score")
    scored = toxicity.score_texts(docs, model, score_col=score)
    return scored.where(F.col(score) < toxicity.THRESHOLD).select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, each line kept in the first document that holds it; ``n_chars``, if there, is counted anew.

    All other columns pass through, also those with the names of the operator's own counts.
    """
    prepare(spark)
    own = [c for c in docs.columns if c.lower() in line_dedup.COUNTS]
    aside = dict(zip(own, free_names(docs, *[f"_{c}" for c in own])))
    cleaned = line_dedup.drop_repeated_lines(docs.withColumnsRenamed(aside)).drop(*line_dedup.COUNTS)
    cleaned = cleaned.withColumnsRenamed({there: c for c, there in aside.items()})
    if "n_chars" in docs.columns:
        cleaned = cleaned.withColumn("n_chars", F.length("text").cast("long"))
    return cleaned.select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    prepare(spark)
    return near_dedup.keep_one_of_each(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that leak no item of the benchmark."""
    prepare(spark)
    (items,) = free_names(docs, "_items")
    found = decontaminate.find_leaks(docs, read(spark, sf_dir, "benchmark"), out_col=items)
    return found.where(F.size(items) == 0).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its tokens, and whether they decode to its text; of other columns only language and source."""
    prepare(spark)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode_texts(docs, ranks, public_tokenizers.PATTERN)
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    kept = [c for c in ("doc_id", "lang", "source") if c in docs.columns]
    return coded.select(*kept, "ids", "n_tokens", (F.col("decoded") == text).alias("decodes_to_text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("byte-level BPE", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last goes through a Parquet folder in the shared scratch."""
    docs = read(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            path = fresh_path(spark, f"stage-{k + 1}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs


#: Models, near copies and byte pairs have no SQL form; the tests hold the stages against brute force.
ORACLE_SQL = None
