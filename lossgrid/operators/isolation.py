"""Isolation forest: trees grow from small fixed-size samples in tasks, scoring is a vectorised Arrow pass."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil, log, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lossgrid.operators.explain import OUTLIER_FEATURES
from lossgrid.operators.sampling import loan_hash
from lossgrid.operators.scale import quantile_columns
from lossgrid.sources.scratch import materialised

SAMPLE = 256
TREE_SCHEMA = "tree int, size int, feature array<int>, split array<double>, left array<int>, depth array<double>"


def path_constant(n: float) -> float:
    """Mean path length of an unsuccessful search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (log(n - 1.0) + 0.5772156649015329) - 2.0 * (n - 1.0) / n


def _grow(points: np.ndarray, seed: int) -> tuple[list, list, list, list]:
    """Random splits until isolation or the depth limit; children of node i sit at left[i], left[i] + 1."""
    rng = np.random.default_rng(seed)
    limit = ceil(log2(max(2, len(points))))
    feature, split, left, depth = [-1], [0.0], [-1], [0.0]
    queue = [(0, points, 0)]
    while queue:
        node, here, level = queue.pop()
        spread = np.ptp(here, axis=0) if len(here) else np.zeros(points.shape[1])
        usable = np.flatnonzero(spread > 0)
        if level >= limit or len(here) <= 1 or not len(usable):
            depth[node] = level + path_constant(len(here))
            continue
        f = int(rng.choice(usable))
        low, high = here[:, f].min(), here[:, f].max()
        cut = float(rng.uniform(low, high))
        feature[node], split[node], left[node] = f, cut, len(feature)
        below = here[:, f] < cut
        for part in (here[below], here[~below]):
            feature.append(-1), split.append(0.0), left.append(-1), depth.append(0.0)
            queue.append((len(feature) - 1, part, level + 1))
    return feature, split, left, depth


def fit(df: DataFrame, columns: Sequence[str], trees: int = 100, seed: int = 42, sample: int = SAMPLE) -> list:
    """Trees from ``trees * sample`` rows drawn by hash from all rows (a bounded top-k), grown one group per task."""
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns]
    pool = (
        df.select(loan_hash().alias("_h"), *filled)
        .orderBy("_h").limit(trees * sample)
        .withColumn("tree", (F.col("_h") % trees).cast("int"))
        .drop("_h")
    )
    names = list(columns)

    def grow(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["tree"].iloc[0])
        points = group[names].to_numpy(float)
        feature, split, left, depth = _grow(points, seed + number)
        return pd.DataFrame(
            {"tree": [number], "size": [len(points)], "feature": [feature], "split": [split], "left": [left], "depth": [depth]}
        )

    # at most `trees` rows of a few hundred nodes each
    return pool.groupBy("tree").applyInPandas(grow, TREE_SCHEMA).collect()


def with_isolation_score(df: DataFrame, forest: list, columns: Sequence[str]) -> DataFrame:
    """Adds ``anomaly_score`` (lower is stranger), evaluated batch-wise over all trees."""
    model = [
        tuple(np.asarray(x) for x in (r["feature"], r["split"], r["left"], r["depth"])) for r in forest
    ]
    typical = path_constant(float(np.mean([r["size"] for r in forest])))
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(features: pd.DataFrame) -> pd.Series:
        x = features.to_numpy(float)
        total = np.zeros(len(x))
        for feature, split, left, depth in shared.value:
            node = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = left[node] >= 0
                if not inner.any():
                    break
                rows = np.flatnonzero(inner)
                at = node[rows]
                node[rows] = left[at] + (x[rows, feature[at]] >= split[at])
            total += depth[node]
        return pd.Series(-np.power(2.0, -(total / len(shared.value)) / max(typical, 1e-9)))

    filled = F.struct(*[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    return df.withColumn("anomaly_score", score(filled))


def isolation_scores(results: DataFrame, columns: Sequence[str] = OUTLIER_FEATURES, trees: int = 100) -> DataFrame:
    """``loan_id``, the columns and ``anomaly_score`` of every active loan, written once for the passes that follow."""
    active = results.where(F.col("current_balance") > 0).select("loan_id", *columns)
    return materialised(with_isolation_score(active, fit(active, columns, trees), columns), "isolation")


def strangest(scored: DataFrame, contamination: float = 0.05) -> DataFrame:
    """The share of the scored rows with the lowest scores."""
    cut = quantile_columns(scored, {"q": ("anomaly_score", contamination)}).scalar()
    return scored.where(F.col("anomaly_score") < cut)


def isolation_outliers(
    results: DataFrame, columns: Sequence[str] = OUTLIER_FEATURES, contamination: float = 0.05, trees: int = 100
) -> DataFrame:
    """Loans whose score falls in the strangest share of the portfolio."""
    return strangest(isolation_scores(results, columns, trees), contamination)
