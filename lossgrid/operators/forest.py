"""Random forests of classes on all rows: bootstrap, square root of the features at each node, Gini splits.

All trees grow level by level.  The rows are binned once and kept as blocks of bytes.  For each level every task counts its
own blocks by node, feature, bin and class, tree after tree, the counts are added per group of nodes, and the best split of
each node is found where they meet.  A row's place in a tree is walked anew and its bootstrap weight drawn anew from the
block's seed, so nothing is kept for pairs of rows and trees.
"""

from __future__ import annotations

import json
import math
import time
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import Broadcast, TaskContext
from pyspark.ml import Estimator
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lossgrid.sources.scratch import fresh_path, materialised

#: Bins of a feature's values, as many as Spark's trees have; quantiles they are made from, and the size of their sketch.
BINS, GRID, SKETCH = 32, 1024, 1024

#: Rows of a block, and nodes whose counts travel together, of one tree or of several.
BLOCK_ROWS, NODES = 32_768, 256

#: Levels whose nodes are compared with all rows of a block; below them each row follows its own node.
WHOLE_LEVELS = 5

#: Bootstrap weights (how often a row is drawn) by a number of 16 bits: Poisson with mean 1.
_DRAWS = np.searchsorted(
    np.cumsum([math.exp(-1) / math.factorial(k) for k in range(9)]), (np.arange(1 << 16) + 0.5) / (1 << 16)
).astype(np.uint8)

#: The smallest numbers with a weight of 1, 2, ...
_STEPS = [int(x) for x in np.searchsorted(_DRAWS, np.arange(1, int(_DRAWS[-1]) + 1))]


def _drawn(seed: tuple[int, ...], n: int) -> np.ndarray:
    """Bootstrap weights of a block's rows in a tree."""
    numbers = np.random.default_rng(seed).integers(0, 1 << 16, n, np.uint16)
    weight = np.zeros(n, np.uint8)
    for step in _STEPS:
        weight += numbers >= step
    return weight


def bin_edges(df: DataFrame, features: Sequence[str]) -> list[np.ndarray]:
    """Upper ends of every feature's bins but the last: all its values if they are few, otherwise quantiles."""
    ranks = F.array(*[F.lit(k / GRID) for k in range(GRID + 1)])
    sketches = df.agg(*[F.kll_sketch_agg_double(f, F.lit(SKETCH)).alias(f) for f in features])
    edges = []
    for found in sketches.select(*[F.kll_sketch_get_quantile_double(f, ranks) for f in features]).first():
        values = np.unique(found)
        edges.append(values if len(values) < BINS else np.unique([found[k * GRID // BINS] for k in range(1, BINS)]))
    return edges


def binned_blocks(df: DataFrame, features: Sequence[str], label: str, edges: list[np.ndarray], classes: int) -> DataFrame:
    """``block`` (its number), ``codes``: feature by feature a row's bin and class as one number; in the shared folder."""
    kind = _code_type(classes)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number, waiting, n = TaskContext.get().partitionId() << 32, [], 0

        def block() -> pd.DataFrame:
            return pd.DataFrame({"block": [number], "codes": [np.concatenate(waiting, axis=1).tobytes()]})

        for batch in batches:
            bins = np.stack([np.searchsorted(e, batch[f].to_numpy()) for f, e in zip(features, edges)])
            waiting.append((bins * classes + batch[label].to_numpy(dtype=np.int64)).astype(kind))
            n += len(batch)
            if n >= BLOCK_ROWS:
                yield block()
                number, waiting, n = number + 1, [], 0
        if n:
            yield block()

    return materialised(df.select(*features, label).mapInPandas(pack, "block long, codes binary"), "blocks")


def _code_type(classes: int) -> type:
    return np.uint8 if BINS * classes <= 256 else np.uint16 if BINS * classes <= 1 << 16 else np.int64


@dataclass
class Trees:
    """Nodes of all trees, tree by place: the root is at 1, the children of ``k`` at ``2 k`` and ``2 k + 1``.

    ``feature`` is -1 where no split is, ``cut`` the last bin that goes left, ``open`` says which nodes wait for a split.
    """

    feature: np.ndarray
    cut: np.ndarray
    open: np.ndarray
    gain: np.ndarray
    held: np.ndarray

    @classmethod
    def seeds(cls, trees: int, depth: int, classes: int) -> Trees:
        shape = (trees, 2 << depth)
        made = cls(
            np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape, bool), np.full(shape, -1.0), np.zeros((*shape, classes))
        )
        made.open[:, 1] = True
        return made


@dataclass(frozen=True)
class Growth:
    """What a level's counts depend on besides the rows."""

    features: int
    classes: int
    leaf: int
    seed: int

    def chosen(self, tree: int, level: int, nodes: np.ndarray, trees: int) -> np.ndarray:
        """The features a split is looked for in, a row for each of a level's ``nodes``; a single tree looks at all."""
        some = math.ceil(math.sqrt(self.features)) if trees > 1 else self.features
        order = np.random.default_rng((self.seed, tree, level)).random((1 << level, self.features)).argsort(axis=1)
        return order[nodes, :some]

    def counts(self, tree: int, level: int, trees: Trees, blocks: list[tuple[int, np.ndarray]]) -> np.ndarray:
        """By chosen feature, open node of the level, and bin and class."""
        nodes = np.flatnonzero(trees.open[tree, 1 << level : 2 << level])
        chosen = self.chosen(tree, level, nodes, len(trees.open)).astype(np.intp)
        feature, cut = trees.feature[tree, : 2 << level], trees.cut[tree, : 1 << level]
        last = ((cut + 1) * self.classes - 1).astype(_code_type(self.classes))  # the last code that goes left
        slot = np.full(2 << level, -1, np.intp)
        slot[nodes + (1 << level)] = np.arange(len(nodes))
        goes_on = (feature >= 0) | (slot >= 0)  # nodes that were split, and those to split now
        width = BINS * self.classes
        out = np.zeros((chosen.shape[1], len(nodes) * width))
        top = min(level, WHOLE_LEVELS)
        all_go_on = goes_on[1 << top : 2 << top].all()
        for number, codes in blocks:
            n, flat = codes.shape[1], codes.reshape(-1)
            place = np.ones(n, np.uint8)
            for k in range(1, 1 << top):  # the first nodes are met by many rows: compared with whole columns
                if k & (k - 1) == 0:
                    before, place = place, place << 1
                if feature[k] >= 0:
                    place |= (before == k) & (codes[feature[k]] > last[k])
            weight = _drawn((self.seed, tree, number), n)
            if not all_go_on:
                weight *= goes_on.take(place)  # rows in leaves went to places without nodes
            row = np.flatnonzero(weight != 0)
            node, shift = place.take(row).astype(np.intp), feature.astype(np.intp) * n
            for below in range(top, level):
                if below > top and (below - top) % 2 == 0:
                    row, node = _kept(goes_on.take(node), row, node)
                at = shift.take(node)
                at += row
                right = flat.take(at) > last.take(node)
                node += node
                node += right
            at = slot.take(node)
            if level > top:
                row, at = _kept(at >= 0, row, at)
            weight, base = weight.take(row).astype(float), at * width
            for k, of in enumerate(np.ascontiguousarray(chosen.T * n)):
                met = of.take(at)
                met += row
                out[k] += np.bincount(base + flat.take(met), weight, out.shape[1])
        return out.reshape(len(out), len(nodes), width).astype(np.int64)

    def sought(self, level: int, trees: Trees, some: Iterable[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Open nodes of a level, tree after tree: their trees, their places and their chosen features."""
        each = [(k, np.flatnonzero(trees.open[k, 1 << level : 2 << level])) for k in some]
        chosen = [self.chosen(k, level, nodes, len(trees.open)) for k, nodes in each]
        of = np.repeat([k for k, _ in each], [len(nodes) for _, nodes in each])
        return of, np.concatenate([nodes for _, nodes in each]) + (1 << level), np.concatenate(chosen)

    def best(self, held: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        """For each node its feature (-1: no split), cut, gain, and the classes' counts of all its rows and of the left ones."""
        held = held.reshape(len(held), -1, BINS, self.classes).astype(float)
        whole = held[0].sum(axis=1)
        left = held.cumsum(axis=2)[:, :, :-1]
        right = whole[:, None] - left
        n_left, n_right, n = left.sum(axis=3), right.sum(axis=3), whole.sum(axis=1)
        pure = (left**2).sum(axis=3) / np.maximum(n_left, 1) + (right**2).sum(axis=3) / np.maximum(n_right, 1)
        pure[(n_left < self.leaf) | (n_right < self.leaf)] = -1.0
        pure = pure.transpose(1, 0, 2).reshape(len(n), -1)
        top, each = pure.argmax(axis=1), np.arange(len(n))
        gain = (pure[each, top] - (whole**2).sum(axis=1) / np.maximum(n, 1)) / np.maximum(n, 1)
        k, cut = top // (BINS - 1), top % (BINS - 1)
        splits = gain > 1e-12
        return np.where(splits, chosen[each, k], -1), cut, np.where(splits, gain, -1.0), whole, left[k, each, cut]


def grow(blocks: DataFrame, growth: Growth, trees: int, depth: int) -> Trees:
    """All trees to ``depth``; the driver holds the nodes and none of the rows."""
    grown = Trees.seeds(trees, depth, growth.classes)
    for level in range(depth):
        if not grown.open.any():
            break
        upto, none = 2 << level, np.empty(0)
        sent = blocks.sparkSession.sparkContext.broadcast(
            Trees(grown.feature[:, :upto], grown.cut[:, :upto], grown.open[:, :upto], none, none)
        )
        for found in _level(blocks, growth, level, sent).collect():
            _record(grown, found, growth, last=level + 1 == depth)
        grown.open[:, :upto] = False
        sent.unpersist()
    return grown


def _kept(on: np.ndarray, *of: np.ndarray) -> tuple[np.ndarray, ...]:
    if on.all():
        return of
    at = np.flatnonzero(on)
    return tuple(x.take(at) for x in of)


def _level(blocks: DataFrame, growth: Growth, level: int, sent: Broadcast) -> DataFrame:
    """The best splits of a level's open nodes, a row for each group of nodes: of several trees as long as they have few."""
    kind, size = _code_type(growth.classes), NODES
    sizes = sent.value.open[:, 1 << level :].sum(axis=1)
    bunch = max(1, size // int(sizes.max()))
    groups = -(-len(sizes) // bunch) if bunch > 1 else int((-(-sizes // size)).sum())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = [
            (int(number), np.frombuffer(codes, kind).reshape(growth.features, -1))
            for batch in batches
            for number, codes in zip(batch["block"], batch["codes"])
        ]  # the rows of one file split, a byte for each feature
        now: Trees = sent.value
        for first in range(0, len(now.open) if held else 0, bunch):
            found = [growth.counts(k, level, now, held) for k in range(first, min(first + bunch, len(now.open))) if now.open[k].any()]
            if found:
                found = np.concatenate(found, axis=1)
                found = found.astype(np.min_scalar_type(int(found.max())))
                parts = range(0, found.shape[1], size)
                yield pd.DataFrame({"tree": first, "part": list(parts), "held": [found[:, p : p + size].tobytes() for p in parts]})

    def split(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, part = map(int, key)
        now: Trees = sent.value
        tree, node, chosen = (
            x[part : part + size] for x in growth.sought(level, now, range(first, min(first + bunch, len(now.open))))
        )
        held = np.zeros(chosen.size * BINS * growth.classes, np.int64)
        for one in rows["held"]:
            held += np.frombuffer(one, f"u{len(one) // len(held)}")  # as wide as the task's highest count
        found = tree, node, *growth.best(held.reshape(chosen.shape[1], len(node), -1), chosen)
        return pd.DataFrame({c: [x.astype(t).tobytes()] for (c, t), x in zip(_SPLIT.items(), found)})

    counted = blocks.mapInPandas(count, "tree int, part int, held binary")
    dealt = counted.repartition(min(groups, blocks.sparkSession.sparkContext.defaultParallelism), "tree", "part")
    return dealt.groupBy("tree", "part").applyInPandas(split, ", ".join(f"{c} binary" for c in _SPLIT))


#: What is found for a group of nodes, as arrays of these kinds.
_SPLIT = {"tree": np.int64, "node": np.int64, "feature": np.int16, "cut": np.int16, "gain": float, "whole": float, "lefts": float}


def _record(grown: Trees, found: Row, growth: Growth, last: bool) -> None:
    tree, node, feature, cut, gain, whole, left = (np.frombuffer(found[c], t) for c, t in _SPLIT.items())
    whole, left = (x.reshape(-1, growth.classes) for x in (whole, left))
    grown.feature[tree, node], grown.cut[tree, node], grown.gain[tree, node], grown.held[tree, node] = feature, cut, gain, whole
    on = feature >= 0
    for child, held in ((2 * node[on], left[on]), (2 * node[on] + 1, (whole - left)[on])):
        grown.held[tree[on], child] = held
        n = held.sum(axis=1)
        grown.open[tree[on], child] = (not last) & (n >= 2 * growth.leaf) & (held.max(axis=1) < n)


def as_model(spark: SparkSession, grown: Trees, edges: list[np.ndarray], growth: Growth, params: dict) -> RandomForestClassificationModel:
    """The trees as Spark's own model, by way of its saved form."""
    path, trees = fresh_path(spark, "forest"), len(grown.feature)
    sent = spark.sparkContext.broadcast(grown)
    stats = [f"s{k}" for k in range(growth.classes)]

    def nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for tree in batch["id"]:
                yield _nodes(sent.value, int(tree), edges, stats)

    flat = spark.range(0, trees, 1, min(trees, spark.sparkContext.defaultParallelism)).mapInPandas(
        nodes,
        "tree int, id int, prediction double, impurity double, gain double, n long, left int, right int, feature int, cut double, "
        + ", ".join(f"{s} double" for s in stats),
    )
    of_tree = {k: v for k, v in params.items() if k != "numTrees"}
    sizes = {"numFeatures": growth.features, "numClasses": growth.classes}
    kinds = ("classification.RandomForestClassificationModel", "classification.DecisionTreeClassificationModel")
    model = load_trees(RandomForestClassificationModel, flat, stats, kinds, params, of_tree, [1.0] * trees, sizes, path)
    sent.unpersist()
    model.saved_at = path  # spares those who read its nodes a second copy
    return model


def load_trees(
    model: type, flat: DataFrame, stats: Sequence[str], kinds: tuple[str, str], params: dict, of_tree: dict, weights: Sequence[float],
    sizes: dict, path: str | None = None,
):
    """Spark's ``model`` from a row for each node, written the way Spark saves it; ``kinds`` are its class and its trees'."""
    spark = flat.sparkSession
    path = path or fresh_path(spark, "trees")
    splits = F.col("feature") >= 0
    none = F.array().cast("array<double>")
    split = F.struct(
        F.col("feature").alias("featureIndex"), F.when(splits, F.array("cut")).otherwise(none).alias("leftCategoriesOrThreshold"),
        F.lit(-1).alias("numCategories"),
    )
    node = F.struct(
        "id", "prediction", "impurity", F.array(*stats).alias("impurityStats"), F.col("n").alias("rawCount"), "gain",
        F.col("left").alias("leftChild"), F.col("right").alias("rightChild"), split.alias("split"),
    )
    flat.select(F.col("tree").alias("treeID"), node.alias("nodeData")).write.parquet(f"{path}/data")

    def described(kind: str, uid: str, params: dict, **more) -> str:
        of = {"class": f"org.apache.spark.ml.{kind}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version}
        return json.dumps(of | {"uid": uid, "paramMap": params, "defaultParamMap": {}} | more)

    each = [(k, described(kinds[1], f"tree_{k}", of_tree, **sizes), weight) for k, weight in enumerate(weights)]
    spark.createDataFrame(each, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    whole = described(kinds[0], path.rsplit("/", 1)[-1], params, **sizes, numTrees=len(weights))
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(f"{path}/metadata")
    return model.load(path)


def _nodes(grown: Trees, tree: int, edges: list[np.ndarray], stats: list[str]) -> pd.DataFrame:
    """A tree's nodes, numbered from 0 in the order of their places."""
    feature = grown.feature[tree]
    there = np.zeros(len(feature), bool)
    there[1] = True
    inner = np.flatnonzero(feature >= 0)
    there[2 * inner] = there[2 * inner + 1] = True
    place, number = np.flatnonzero(there), np.cumsum(there) - 1
    held, f = grown.held[tree, place], feature[place]
    n, splits = held.sum(axis=1), f >= 0
    child = np.where(splits, 2 * place, 0)
    cut = [edges[k][c] if k >= 0 else 0.0 for k, c in zip(f, grown.cut[tree, place])]
    out = {
        "tree": tree, "id": number[place], "prediction": held.argmax(axis=1).astype(float),
        "impurity": 1.0 - (held**2).sum(axis=1) / np.maximum(n, 1) ** 2, "gain": grown.gain[tree, place], "n": n.astype(np.int64),
        "left": np.where(splits, number[child], -1), "right": np.where(splits, number[child + 1], -1), "feature": f, "cut": cut,
    }
    return pd.DataFrame(out | {s: held[:, k] for k, s in enumerate(stats)})


class ForestClassifier(Estimator):
    """A stage of a pipeline like Spark's forest, with the model it fits; ``features`` are the columns assembled before it."""

    def __init__(self, features: Sequence[str], trees: int, depth: int, leaf: int, seed: int = 42, label: str = "label"):
        super().__init__()
        self.features, self.trees, self.depth, self.leaf, self.seed, self.label = tuple(features), trees, depth, leaf, seed, label

    def _fit(self, dataset: DataFrame) -> RandomForestClassificationModel:
        rows = dataset.select(self.label, *self.features)
        classes = int(rows.agg(F.max(self.label)).first()[0]) + 1
        growth = Growth(len(self.features), classes, self.leaf, self.seed)
        edges = bin_edges(rows, self.features)
        blocks = binned_blocks(rows, self.features, self.label, edges, classes)
        grown = grow(blocks, growth, self.trees, self.depth)
        params = {
            "numTrees": self.trees, "maxDepth": self.depth, "minInstancesPerNode": self.leaf, "maxBins": BINS, "impurity": "gini",
            "seed": self.seed, "labelCol": self.label,
        }
        return as_model(dataset.sparkSession, grown, edges, growth, params)
