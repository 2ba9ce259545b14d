"""Shapley values of fitted tree ensembles, by walking the trees' paths.

A coalition's value is a tree's expectation when only its features are known: at a split on another feature both
branches count, by their shares of the training rows.  Every leaf then adds to a feature of its path a sum over
coalitions that depends only on which of the path's conditions a row meets, and on the shares.  That sum comes from products
of linear factors, one per feature, for all rows of a batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import factorial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lossgrid.sources.scratch import fresh_path


@dataclass(frozen=True)
class Leaf:
    """What a leaf adds to the outputs, and for each feature of its path the interval (low, high] and the share that
    takes this way at the splits on it."""

    value: np.ndarray
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray


@dataclass(frozen=True)
class Forest:
    leaves: list[Leaf]
    base: np.ndarray

    def values(self, x: np.ndarray) -> np.ndarray:
        """Rows by features by outputs."""
        out = np.zeros((len(x), x.shape[1], len(self.base)))
        for leaf in self.leaves:
            if not len(leaf.features):
                continue
            here = x[:, leaf.features]
            met = (here > leaf.low) & (here <= leaf.high)
            codes = met @ (1 << np.arange(met.shape[1], dtype=np.int64))
            _, at, back = np.unique(codes, return_index=True, return_inverse=True)
            weights = _weights(met[at].astype(float), leaf.share)[back]
            for k, f in enumerate(leaf.features):
                out[:, f] += weights[:, k, None] * leaf.value
        return out


def _weights(met: np.ndarray, share: np.ndarray) -> np.ndarray:
    """For each row and feature the sum over coalitions of the others, times what knowing the feature changes."""
    rows, m = met.shape
    before = [np.ones((rows, 1))]  # products of (share + met * t) over the features before
    for k in range(m - 1):
        before.append(_times(before[-1], share[k], met[:, k]))
    after, out = np.ones((rows, 1)), np.empty_like(met)
    sizes = np.array([factorial(s) * factorial(m - 1 - s) / factorial(m) for s in range(m)])
    for k in range(m - 1, -1, -1):
        a, b = before[k], after
        by_size = sizes[np.arange(a.shape[1])[:, None] + np.arange(b.shape[1])]
        out[:, k] = ((a @ by_size) * b).sum(axis=1) * (met[:, k] - share[k])
        after = _times(after, share[k], met[:, k])
    return out


def _times(poly: np.ndarray, share: float, met: np.ndarray) -> np.ndarray:
    out = np.zeros((len(poly), poly.shape[1] + 1))
    out[:, :-1] = poly * share
    out[:, 1:] += poly * met[:, None]
    return out


def forest_of(spark: SparkSession, model) -> Forest:
    """Leaves of a fitted random forest or boosted regressor; outputs are class probabilities or the prediction.

    The model's nodes come to the driver, as many as its size parameters allow.
    """
    path = fresh_path(spark, "forest")
    model.write().overwrite().save(path)
    trees: dict[int, dict[int, Row]] = {}
    for row in spark.read.parquet(f"{path}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]
    classes = getattr(model, "numClasses", 0)
    boosted = type(model).__name__.startswith("GBT")
    scale = model.treeWeights if boosted else [1.0 / len(trees)] * len(trees)
    leaves, base = [], np.zeros(classes or 1)
    for number, nodes in trees.items():
        found, expected = _walk(nodes, bool(classes), scale[number])
        leaves += found
        base += expected
    return Forest(leaves, base)


def _walk(nodes: dict[int, Row], classes: bool, scale: float) -> tuple[list[Leaf], np.ndarray]:
    def rows_at(node: Row) -> float:
        return sum(node["impurityStats"]) if classes else node["impurityStats"][0]

    leaves, base, todo = [], 0.0, [(nodes[0], {}, 1.0)]
    while todo:
        node, path, reach = todo.pop()
        if node["leftChild"] < 0:
            value = np.array(node["impurityStats"]) / rows_at(node) if classes else np.array([node["prediction"]])
            value = value * scale
            base = base + value * reach
            of = sorted(path)
            parts = (np.array([path[f][k] for f in of], dtype=float) for k in range(3))
            leaves.append(Leaf(value, np.array(of, dtype=np.int64), *parts))
            continue
        split = node["split"]
        if split["numCategories"] != -1:
            raise ValueError("only splits by a threshold have attributions")
        f, cut = split["featureIndex"], split["leftCategoriesOrThreshold"][0]
        low, high, share = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((node["leftChild"], (low, min(high, cut))), (node["rightChild"], (max(low, cut), high))):
            taken = rows_at(nodes[child]) / rows_at(node)
            todo.append((nodes[child], path | {f: (*bounds, share * taken)}, reach * taken))
    return leaves, base


def attributions(df: DataFrame, key: str, features: Sequence[str], forest: Forest) -> DataFrame:
    """``key``, ``phi`` (feature by output), ``expected`` (base plus all of ``phi``, the model's own output)."""

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            phi = forest.values(batch[list(features)].to_numpy(dtype=float))
            whole = phi.sum(axis=1) + forest.base
            yield pd.DataFrame({key: batch[key], "phi": phi.tolist(), "expected": whole.tolist()})

    kind = df.schema[key].dataType.simpleString()
    filled = [F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in features]
    return df.select(key, *filled).mapInPandas(explain, f"{key} {kind}, phi array<array<double>>, expected array<double>")


def importance(attributed: DataFrame, features: Sequence[str], top: int = 20) -> DataFrame:
    """``feature``, ``importance``: mean absolute value over rows and outputs, the ``top`` highest."""
    sizes = F.transform("phi", lambda f: F.aggregate(f, F.lit(0.0), lambda s, v: s + F.abs(v)) / F.size(f))
    each = attributed.select(F.posexplode(sizes).alias("k", "size")).groupBy("k").agg(F.avg("size").alias("importance"))
    names = F.array(*[F.lit(f) for f in features])
    return each.select(names[F.col("k")].alias("feature"), "importance").orderBy(F.desc("importance"), "feature").limit(top)
