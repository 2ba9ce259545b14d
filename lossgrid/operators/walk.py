"""Scores of fitted random forests: the sums that Spark's own model takes, for many rows at a time.

Spark's model follows a row through objects, tree after tree.  Here a batch of rows meets every test of the forest (a
feature and a threshold, of which all trees share a few hundred) once, and then all its rows go down a tree together, level
by level, by these answers.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lossgrid.sources.scratch import fresh_path

#: Rows that go down the trees together: the answers of a few hundred tests for them stay in a core's cache.
ROWS = 4096


@dataclass(frozen=True)
class Walk:
    """Nodes of all trees.  Test 0 is never met: leaves have it, and are their own left child."""

    feature: np.ndarray  # of each test
    cut: np.ndarray
    test: np.ndarray  # of each node
    left: np.ndarray  # the right child follows the left
    shares: np.ndarray  # of the classes, by node
    roots: np.ndarray  # of each tree
    depths: np.ndarray

    @classmethod
    def of(cls, spark: SparkSession, model: RandomForestClassificationModel) -> Walk:
        """The model's nodes come to the driver, as many as its size parameters allow.

        They are read from ``saved_at``, if the model has that: the folder it was loaded from."""
        path = getattr(model, "saved_at", None) or fresh_path(spark, "walk")
        if not hasattr(model, "saved_at"):
            model.write().save(path)
        node, split = F.col("nodeData"), F.col("nodeData.split")
        cut = F.get(split["leftCategoriesOrThreshold"], 0).alias("cut")
        found = spark.read.parquet(f"{path}/data").select(
            "treeID", node["id"].alias("id"), node["leftChild"].alias("left"), node["rightChild"].alias("right"),
            split["featureIndex"].alias("feature"), split["numCategories"].alias("categories"), cut, node["impurityStats"].alias("held"),
        )
        nodes = found.toArrow().sort_by([("treeID", "ascending"), ("id", "ascending")]).combine_chunks()
        held = nodes["held"].combine_chunks().flatten().to_numpy().reshape(nodes.num_rows, -1)
        tree, number, left, right, feature, categories = (
            nodes[c].to_numpy().astype(np.int64) for c in ("treeID", "id", "left", "right", "feature", "categories")
        )
        if (categories[left >= 0] != -1).any():
            raise ValueError("only splits by a threshold are walked")
        return cls._laid(tree, number, left, right, feature, nodes["cut"].to_numpy(), held)

    @classmethod
    def _laid(cls, tree, number, left, right, feature, cut, held) -> Walk:
        """Nodes sorted by tree and number, with their children's numbers; brought tree by tree, level by level."""
        first = np.flatnonzero(number == 0)
        start = np.repeat(first, np.diff(np.append(first, len(tree))))
        level, met, here, depth = np.zeros(len(tree), np.int64), [], first, 0
        while len(here):
            met.append(here)
            level[here] = depth
            inner = here[left[here] >= 0]
            here = np.stack([start[inner] + left[inner], start[inner] + right[inner]], axis=1).ravel()
            depth += 1
        order = np.concatenate(met)
        order = order[np.argsort(tree[order], kind="stable")]  # siblings stay side by side
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        inner = left >= 0
        child = np.where(inner, place[np.where(inner, start + left, 0)], place)[order]
        tests, which = np.unique(np.stack([feature[inner].astype(float), cut[inner]]), axis=1, return_inverse=True)
        test = np.zeros(len(tree), np.int64)
        test[inner] = which.reshape(-1) + 1
        total = held.sum(axis=1, keepdims=True)
        shares = np.divide(held, total, out=np.zeros_like(held), where=total != 0)[order]
        depths = np.maximum.reduceat(level, first)
        return cls(tests[0].astype(np.int64), tests[1], test[order], child, np.ascontiguousarray(shares.T), place[first], depths)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Classes by rows, from features by rows."""
        out = np.zeros((len(self.shares), x.shape[1]))
        for a in range(0, x.shape[1], ROWS):
            part, votes = x[:, a : a + ROWS], out[:, a : a + ROWS]
            n = part.shape[1]
            right = np.zeros((len(self.cut) + 1, n), bool)
            for k, (f, c) in enumerate(zip(self.feature, self.cut), 1):
                np.greater(part[f], c, out=right[k])
            flat, shift, rows = right.reshape(-1), self.test * n, np.arange(n)
            for root, depth in zip(self.roots, self.depths):
                node = np.full(n, root)
                for _ in range(depth):
                    at = shift.take(node)
                    at += rows
                    node = self.left.take(node)
                    node += flat.take(at)
                for vote, share in zip(votes, self.shares):
                    vote += share.take(node)
        return out / out.sum(axis=0)


def with_class_scores(
    df: DataFrame, features: Sequence[str], model: RandomForestClassificationModel, prediction: str, probabilities: Sequence[str]
) -> DataFrame:
    """``df`` with the predicted class and the classes' probabilities; a feature without a value is an error, as in an assembler."""
    sent = df.sparkSession.sparkContext.broadcast(Walk.of(df.sparkSession, model))

    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        walk: Walk = sent.value
        for batch in batches:
            x = np.stack([c.to_numpy(dtype=float) for c in ([batch] if isinstance(batch, pd.Series) else batch)])
            if np.isnan(x).any():
                raise ValueError("a row to be scored has a feature without a value")
            found = walk.probabilities(x)
            yield pd.DataFrame({prediction: found.argmax(axis=0).astype(float)} | dict(zip(probabilities, found)))

    names = [prediction, *probabilities]
    scored = F.pandas_udf(score, ", ".join(f"`{n}` double" for n in names))
    found = df.withColumn("_scores", scored(*[F.col(f).cast("double") for f in features]))
    return found.select(*df.columns, *[F.col("_scores")[n].alias(n) for n in names])
