"""Queries of the corpus operators, each over its whole table, and their SQL texts where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.llm import (
    bpe,
    chat,
    decontaminate,
    licenses,
    line_dedup,
    near_dedup,
    packing,
    pages,
    pii,
    quality,
    resample,
    search,
    toxicity,
)
from lossgrid.llm.common import read


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = near_dedup.duplicate_classes(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return classes.select(F.col("node").alias("doc_id"), "class_id")


def op2_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.personal_data_digests(docs, pii.fit(docs))


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return bpe.token_digests(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256")
    )


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pages.main_text(read(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaked_pairs(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files ``source/lang/doc_id``."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("source", "lang", "doc_id")]
    files = read(spark, sf_dir, "documents").select("doc_id", F.concat_ws("/", *parts).alias("path"), "text")
    return licenses.scan_licenses(files).select(
        "doc_id", "path", "license", "origin", "license_dir", F.round("cosine", 6).alias("cosine")
    )


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.chat_digests(chats.unionByName(spark.sql(chat.PROBE)))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.score_quality(docs).select("doc_id", *quality.OUTPUTS)


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, read(spark, sf_dir, "labels").select("doc_id", "toxic"))
    return toxicity.score_texts(docs, model, score_col="score").select(
        "doc_id",
        toxicity.held_out().alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    packed = packing.pack(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return packed.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"), "sequence_id", "offset"
    )


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    drawn = resample.resample(docs, target, max_words=1)
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_near_dedup,
        op2_personal_data,
        op3_byte_bpe,
        op4_line_dedup,
        op5_main_text,
        op6_decontaminate,
        op7_license_scan,
        op8_chat_format,
        op9_quality_rules,
        op10_toxicity,
        op11_ranked_search,
        op12_best_fit_packing,
        op13_resample,
        pipeline,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op4_line_dedup": line_dedup.SQL,
    "op8_chat_format": chat.SQL,
    "op9_quality_rules": quality.SQL,
    "op11_ranked_search": search.SQL,
}
