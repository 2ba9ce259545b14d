"""Deterministic samples, splits and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lossgrid import config as C
from lossgrid.operators.scale import smallest_rank_threshold

#: A prime and a factor below it: products of remainders fit a long and wrap for small ids too.
_MODULUS = 2147483647
HASH_FACTOR = 1103515245


def loan_hash(loan_id: str = "loan_id", factor: int = HASH_FACTOR) -> Column:
    """Repeatable pseudo-random key of a loan, one to one for numbers below the modulus; ties go by loan id."""
    number = F.substring(loan_id, F.lit(2), F.length(loan_id)).cast("long")
    return ((number % F.lit(_MODULUS)) * F.lit(factor).cast("long")) % F.lit(_MODULUS)


def sample_n(df: DataFrame, n: int) -> DataFrame:
    """n rows by hash order: every task keeps n candidates, so nothing is sorted globally."""
    return df.withColumn("_h", loan_hash()).orderBy("_h", "loan_id").limit(n).drop("_h")


def stratified_sample(df: DataFrame, stratum: str, sizes: Mapping[str, int]) -> DataFrame:
    """Up to ``sizes[s]`` rows of every stratum, each as its own top-k."""
    parts = [sample_n(df.where(F.col(stratum) == s), n) for s, n in sizes.items()]
    return union_batches(parts)


def union_batches(parts: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_stratified(
    df: DataFrame, stratum: str, train_share: float = 0.8, strata: Sequence[str] = C.STAGES
) -> DataFrame:
    """Adds ``is_train``: exactly floor(share * n) rows of every listed stratum.

    The split point per stratum is an exact order statistic of the hash, so no
    stratum is ever ranked in one task.  Rows of unlisted strata stay in training.
    """
    hashed = df.withColumn("_h", loan_hash().cast("double"))
    listed = hashed.where(F.col(stratum).isin(*strata)).select(stratum, "_h")
    cut = smallest_rank_threshold(listed, "_h", [stratum], train_share, bounded=True).select(stratum, "threshold")
    return (
        hashed.join(F.broadcast(cut), stratum, "left")  # at most one row per listed stratum
        .withColumn("is_train", F.coalesce(F.col("_h") < F.col("threshold"), F.lit(True)))
        .drop("_h", "threshold")
    )


def overlap_count(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on both sides."""
    return left.select(key).intersect(right.select(key)).agg(F.count("*").alias("overlap"))
