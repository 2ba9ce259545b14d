"""Pairwise moments of many columns in one pass: counts, means, squares and products of what both columns have."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_PART = "a int, b int, n double, mean_a double, mean_b double, square_a double, square_b double, product double"


def _partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A task's moments of every pair of columns, about the pair's own means."""
    shift = both = first = square = product = None
    for batch in batches:
        values = batch.to_numpy(dtype=np.float64)
        there = ~np.isnan(values)
        if both is None:
            k = values.shape[1]
            both, first, square, product = (np.zeros((k, k)) for _ in range(4))
            shift = np.zeros(k)
            for c in range(k):  # digits are lost on large means, so values are taken from near theirs
                shift[c] = values[there[:, c], c].mean() if there[:, c].any() else 0.0
        held = there.astype(float)
        moved = np.where(there, values - shift, 0.0)
        both += held.T @ held
        first += moved.T @ held
        square += (moved * moved).T @ held
        product += moved.T @ moved
    if both is None:
        return
    rows = []
    for a in range(len(both)):
        for b in range(a, len(both)):
            if n := both[a, b]:
                rows.append(
                    (
                        a, b, n, shift[a] + first[a, b] / n, shift[b] + first[b, a] / n,
                        square[a, b] - first[a, b] ** 2 / n, square[b, a] - first[b, a] ** 2 / n,
                        product[a, b] - first[a, b] * first[b, a] / n,
                    )
                )
    yield pd.DataFrame(rows, columns=[c.split()[0] for c in _PART.split(", ")])


def cross_moments(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a``, ``b``, ``n``, ``mean_a``, ``mean_b``, ``square_a``, ``square_b``, ``product`` for every pair of columns.

    Over the rows in which neither is null (or NaN): the number of rows, the means, and the sums of squared and multiplied
    distances from them.  A pair comes once, in the order of ``columns``, and each column with itself; pairs that no row
    has are left out.  Each task hands on one row per pair, so what is shuffled does not depend on the number of rows.
    """
    parts = df.select(*[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(columns)]).mapInPandas(_partial, _PART)
    whole = Window.partitionBy("a", "b")
    means = {f"all_{x}": F.sum(F.col("n") * F.col(f"mean_{x}")).over(whole) / F.sum("n").over(whole) for x in "ab"}
    off_a, off_b = (F.col(f"mean_{x}") - F.col(f"all_{x}") for x in "ab")
    names = F.array(*[F.lit(c) for c in columns])
    return (
        parts.withColumns(means)
        .groupBy("a", "b")
        .agg(
            F.sum("n").cast("long").alias("n"), F.first("all_a").alias("mean_a"), F.first("all_b").alias("mean_b"),
            F.sum(F.col("square_a") + F.col("n") * off_a * off_a).alias("square_a"),
            F.sum(F.col("square_b") + F.col("n") * off_b * off_b).alias("square_b"),
            F.sum(F.col("product") + F.col("n") * off_a * off_b).alias("product"),
        )
        .withColumns({x: names[F.col(x)] for x in "ab"})
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``a``, ``b``, ``n``, ``r``: the correlation of every two columns; null where one of them is constant."""
    m = cross_moments(df, columns).where(F.col("a") != F.col("b"))
    return m.select("a", "b", "n", F.try_divide(F.col("product"), F.sqrt(F.col("square_a") * F.col("square_b"))).alias("r"))


def covariance(df: DataFrame, columns: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Means and population covariance on the driver: one number for each pair of columns."""
    at = {c: k for k, c in enumerate(columns)}
    means, matrix = np.zeros(len(at)), np.zeros((len(at), len(at)))
    for row in cross_moments(df, columns).collect():
        a, b = at[row["a"]], at[row["b"]]
        matrix[a, b] = matrix[b, a] = row["product"] / row["n"]
        if a == b:
            means[a] = row["mean_a"]
    return means, matrix
