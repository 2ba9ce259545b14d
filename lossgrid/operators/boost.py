"""Gradient-boosted trees on all rows, several models in one job.

The rows are binned once and dealt over the tasks of a barrier stage, which keep them as bytes beside what each model says
about them.  Level by level every task counts its own rows by node, feature and bin, the tasks tell each other their counts,
and all find the same splits from the sums.  Residuals are rounded to whole numbers of an eight-millionth of the largest one
or less, so that sums are exact and the trees do not depend on where the rows lie.  Losses, weights and limits are those of
Spark's own boosted trees.
"""

from __future__ import annotations

import base64
import os
import pickle
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote, urlsplit

import numpy as np
import pandas as pd
from pyspark import BarrierTaskContext
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession

from lossgrid.operators.forest import BINS, bin_edges, load_trees
from lossgrid.sources.scratch import fresh_path, materialised

#: Part of the rows that no model learns from.
TEST = -1

#: Rows of a block that travels to a task, and tasks at most: each tells its counts to all others.
BLOCK_ROWS, TASKS = 16_384, 64

#: Rows counted together, bins of features that are counted as one, and the largest residual as a whole number.
CHUNK, JOINT, TOP = 120_000, 1024, 1 << 24


@dataclass(frozen=True)
class Target:
    """What a model learns, from all parts but ``held`` and the test part: the label, or whether it is the class ``of``."""

    held: int = TEST
    of: float | None = None

    def learns(self, part: int) -> bool:
        return part not in (TEST, self.held)


@dataclass(frozen=True)
class Sizes:
    rounds: int
    depth: int
    leaf: int
    step: float
    logistic: bool

    @classmethod
    def of(cls, how: GBTClassifier | GBTRegressor) -> Sizes:
        return cls(how.getMaxIter(), how.getMaxDepth(), how.getMinInstancesPerNode(), how.getStepSize(), isinstance(how, GBTClassifier))

    def truth(self, target: Target, label: np.ndarray) -> np.ndarray:
        return np.where(label == target.of, 1.0, -1.0) if self.logistic else label

    def residual(self, truth: np.ndarray, score: np.ndarray) -> np.ndarray:
        """What the next tree learns: the loss's slope, of squared errors or of the logistic loss on 1 and -1."""
        return 4.0 * truth / (1.0 + np.exp(2.0 * truth * score)) if self.logistic else 2.0 * (truth - score)


@dataclass
class Trees:
    """Nodes of a model's trees by place: the root is at 1, the children of ``k`` at ``2 k`` and ``2 k + 1``.

    ``feature`` is -1 where no split is, ``cut`` the last bin that goes left; ``n`` rows with the sums of their residuals and
    squares.
    """

    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    n: np.ndarray
    total: np.ndarray
    squares: np.ndarray

    @classmethod
    def seeds(cls, sizes: Sizes) -> Trees:
        shape = (sizes.rounds, 2 << sizes.depth)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.full(shape, -1.0), *(np.zeros(shape) for _ in range(3)))


class Rows:
    """Some of a task's rows, all of one part: a byte for each feature, and features counted as one."""

    def __init__(self, part: int, codes: np.ndarray, label: np.ndarray, groups: list[list[int]], bins: Sequence[int]):
        self.part, self.label, self.codes = part, label, np.ascontiguousarray(codes)
        self.joint = []
        for group in groups:
            one = np.zeros(len(label), np.uint16)
            for f in group:
                one = one * np.uint16(bins[f]) + self.codes[f]
            self.joint.append(one)


def _groups(bins: Sequence[int]) -> list[list[int]]:
    """Neighbouring features whose bins together are few enough to be counted as one."""
    groups: list[list[int]] = []
    size = JOINT + 1
    for f, n in enumerate(bins):
        if size * n > JOINT:
            groups.append([])
            size = 1
        groups[-1].append(f)
        size *= n
    return groups


@dataclass
class _Seen:
    """What a model keeps for rows: score, place in the tree that grows, and the residual if it learns from them."""

    rows: Rows
    learns: bool
    score: np.ndarray
    place: np.ndarray
    residual: np.ndarray | None = None


@dataclass
class _Model:
    """A model that grows in a task; all tasks hold the same trees."""

    target: Target
    sizes: Sizes
    bins: Sequence[int]
    seen: list[_Seen]
    trees: Trees
    most: float = 0.0
    scale: float = 1.0
    counted: list[int] = field(default_factory=list)
    held: dict[int, np.ndarray] = field(default_factory=dict)

    @classmethod
    def of(cls, target: Target, sizes: Sizes, bins: Sequence[int], chunks: list[Rows]) -> _Model:
        kind = np.min_scalar_type((2 << sizes.depth) - 1)
        met = [r for r in chunks if target.learns(r.part) or r.part == target.held]
        seen = [_Seen(r, target.learns(r.part), np.zeros(len(r.label)), np.zeros(len(r.label), kind)) for r in met]
        made = cls(target, sizes, bins, seen, Trees.seeds(sizes))
        made.most = max((np.abs(sizes.truth(target, s.rows.label)).max() for s in made.learned()), default=0.0)
        return made

    def learned(self) -> list[_Seen]:
        return [s for s in self.seen if s.learns]

    def start(self, first: bool, most: float) -> None:
        """All rows to the root; residuals as whole numbers, by a power of two."""
        self.scale = 2.0 ** np.floor(np.log2(TOP / most)) if most > 0 else 1.0
        for s in self.seen:
            s.place[:] = 1
            if s.learns:
                truth = self.sizes.truth(self.target, s.rows.label)
                s.residual = np.rint((truth if first else self.sizes.residual(truth, s.score)) * self.scale).astype(np.int32)
        self.counted, self.held = [1], {}

    def count(self, groups: list[list[int]]) -> np.ndarray:
        """Rows and sums of residuals by counted node, feature and bin."""
        m, out = len(self.counted), np.zeros((2, len(self.counted), len(self.bins), BINS))
        if not m:
            return out
        sizes = [int(np.prod([self.bins[f] for f in group])) for group in groups]
        held = [np.zeros((2, m * size)) for size in sizes]
        slot = np.full(2 << self.sizes.depth, -1, np.intp)
        slot[self.counted] = np.arange(m)
        for s in self.learned():
            row, at, weight = None, None, s.residual
            if self.counted != [1]:
                at = slot.take(s.place)
                row = np.flatnonzero(at >= 0)
                at, weight = at.take(row), weight.take(row)
            weight = weight.astype(float)
            for both, size, joint in zip(held, sizes, s.rows.joint):
                if row is None:
                    cell = joint.astype(np.intp)
                else:
                    cell = at * size
                    cell += joint.take(row)
                both[0] += np.bincount(cell, minlength=m * size)
                both[1] += np.bincount(cell, weight, m * size)
        for group, both in zip(groups, held):
            both = both.reshape(2, m, *[self.bins[f] for f in group])
            for k, f in enumerate(group):
                out[:, :, f, : self.bins[f]] = both.sum(axis=tuple(a for a in range(2, both.ndim) if a != k + 2))
        return out

    def split(self, tree: int, level: int, found: np.ndarray) -> None:
        """The best splits of a level's open nodes, and the nodes to count next: of two children the one with fewer rows."""
        t, leaf = self.trees, self.sizes.leaf
        for k, node in enumerate(self.counted):
            self.held[node] = found[:, k]
            if node > 1:
                self.held[node ^ 1] = self.held[node >> 1] - found[:, k]
        if level == 0:
            t.n[tree, 1], t.total[tree, 1] = found[:, 0, 0].sum(axis=1)
        nodes = [k for k in self.held if k >> level == 1 and t.n[tree, k] >= 2 * leaf]
        self.counted = []
        if not nodes:
            return
        held = np.stack([self.held[k] for k in nodes], axis=1)
        n, total = t.n[tree, nodes], t.total[tree, nodes]
        n_left, left = held.cumsum(axis=3)[..., :-1]
        n_right, right = n[:, None, None] - n_left, total[:, None, None] - left
        better = left**2 / np.maximum(n_left, 1) + right**2 / np.maximum(n_right, 1)
        better[(n_left < leaf) | (n_right < leaf)] = -1.0
        better = better.reshape(len(nodes), -1)
        top, each = better.argmax(axis=1), np.arange(len(nodes))
        whole = total**2 / n
        gain = better[each, top] - whole
        feature, cut = np.divmod(top, BINS - 1)
        for i in np.flatnonzero(gain > 1e-12 * whole):
            k, f, c = nodes[i], feature[i], cut[i]
            t.feature[tree, k], t.cut[tree, k], t.gain[tree, k] = f, c, gain[i] / n[i] / self.scale**2
            t.n[tree, 2 * k], t.n[tree, 2 * k + 1] = n_left[i, f, c], n_right[i, f, c]
            t.total[tree, 2 * k], t.total[tree, 2 * k + 1] = left[i, f, c], right[i, f, c]
            smaller = 2 * k + int(n_right[i, f, c] < n_left[i, f, c])
            if level + 1 < self.sizes.depth and max(n_left[i, f, c], n_right[i, f, c]) >= 2 * leaf:
                self.counted.append(smaller)

    def descend(self, tree: int, level: int) -> None:
        """Rows to their children; those in leaves go left all the way."""
        first = 1 << level
        nodes = [k for k in range(first, 2 * first) if self.trees.feature[tree, k] >= 0]
        splits = [(k, int(self.trees.feature[tree, k]), int(self.trees.cut[tree, k])) for k in nodes]
        for s in self.seen:
            before = s.place
            s.place = before << 1
            for k, f, cut in splits:
                s.place |= (before == k) & (s.rows.codes[f] > cut)

    def finish(self, tree: int) -> np.ndarray:
        """Adds the tree to the scores; the largest residual to come and the squares by leaf."""
        t, sizes = self.trees, self.sizes
        ends = np.zeros(2 << sizes.depth)
        for k in range(1, 2 << sizes.depth):
            if t.n[tree, k] > 0 and t.feature[tree, k] < 0:
                ends[self._end(k)] = t.total[tree, k] / t.n[tree, k] / self.scale
        weight = 1.0 if tree == 0 else sizes.step
        most, squares = 0.0, np.zeros(len(ends))
        for s in self.seen:
            s.score += (weight * ends).take(s.place)
            if s.learns:
                squares += np.bincount(s.place, s.residual.astype(float) ** 2, len(ends))
                most = max(most, 4.0 if sizes.logistic else np.abs(sizes.residual(s.rows.label, s.score)).max())
        return np.concatenate([[most], squares])

    def close(self, tree: int, squares: np.ndarray) -> None:
        """Sums of a tree's nodes in the unit of its residuals."""
        t = self.trees
        for k in reversed(np.flatnonzero(t.n[tree]).tolist()):
            below = t.feature[tree, k] >= 0
            t.squares[tree, k] = t.squares[tree, 2 * k : 2 * k + 2].sum() if below else squares[self._end(k)] / self.scale**2
        t.total[tree] /= self.scale

    def _end(self, leaf: int) -> int:
        """Where a leaf's rows are after the last level."""
        return leaf << self.sizes.depth + 1 - leaf.bit_length()


def learn(chunks: list[Rows], targets: Sequence[Target], sizes: Sizes, bins: Sequence[int], gather: Callable[[bytes], list[bytes]]) -> list[_Model]:
    """All models on the rows of all tasks; ``gather`` brings every task what each of them says."""
    groups = _groups(bins)
    models = [_Model.of(t, sizes, bins, chunks) for t in targets]
    most = np.max(_told(np.array([m.most for m in models]), gather), axis=0)
    for tree in range(sizes.rounds):
        for model, top in zip(models, most):
            model.start(tree == 0, top)
        for level in range(sizes.depth):
            if any(m.counted for m in models):
                found = _summed([m.count(groups) for m in models], gather)
                for model, one in zip(models, found):
                    if model.counted:
                        model.split(tree, level, one)
            for model in models:
                model.descend(tree, level)
        if tree == 0 and not all(m.trees.n[0, 1] for m in models):
            raise ValueError("a model has no rows to learn from")
        told = _told(np.stack([m.finish(tree) for m in models]), gather)
        most = np.max([one[:, 0] for one in told], axis=0)
        for model, squares in zip(models, np.sum(told, axis=0)[:, 1:]):
            model.close(tree, squares)
    return models


def _told(own: np.ndarray, gather: Callable[[bytes], list[bytes]]) -> list[np.ndarray]:
    return [np.frombuffer(one).reshape(own.shape) for one in gather(own.tobytes())]


def _summed(own: list[np.ndarray], gather: Callable[[bytes], list[bytes]]) -> list[np.ndarray]:
    """Counts of all tasks: whole numbers, so that their order does not matter."""
    n, total = (np.concatenate([x[k].reshape(-1) for x in own]) for k in (0, 1))
    told = gather(n.astype(np.uint32).tobytes() + total.tobytes())
    n, total = np.zeros(len(n)), np.zeros(len(n))
    for one in told:
        n += np.frombuffer(one, np.uint32, len(n))
        total += np.frombuffer(one, float, len(n), 4 * len(n))
    ends = np.cumsum([x[0].size for x in own])[:-1]
    return [np.stack([a, b]).reshape(x.shape) for a, b, x in zip(np.split(n, ends), np.split(total, ends), own)]


@dataclass(frozen=True)
class Boosted:
    """Trees of each model, and ``scored``: for the rows of a part its label and the scores ``s0``, ``s1``, ... of the models
    that the part was held out from, in their order."""

    trees: list[Trees]
    scored: DataFrame
    edges: list[np.ndarray]


def fit(rows: DataFrame, features: Sequence[str], targets: Sequence[Target], how: GBTClassifier | GBTRegressor) -> Boosted:
    """Models with the sizes of ``how`` on all ``rows``: features, ``label`` and ``part``."""
    spark, sizes = rows.sparkSession, Sizes.of(how)
    edges = bin_edges(rows.where(rows["part"] != TEST), features)
    bins = [len(e) + 1 for e in edges]
    columns = max(sum(t.held == held for t in targets) for held in {t.held for t in targets})
    names = [f"s{k}" for k in range(columns)]
    folder = _posix(fresh_path(spark, "counts"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting, n = [], 0

        def block() -> pd.DataFrame:
            whole = pd.concat(waiting)
            x = whole[list(features)].to_numpy(dtype=float)
            label = whole["label"].to_numpy(dtype=float)
            if np.isnan(x).any() or np.isnan(label).any():
                raise ValueError("a row to learn from or to be scored has a feature or a label without a value")
            codes = np.stack([np.searchsorted(e, c).astype(np.uint8) for e, c in zip(edges, x.T)])
            part = whole["part"].to_numpy(dtype=np.int16)
            return pd.DataFrame({"codes": [codes.tobytes()], "label": [label.tobytes()], "part": [part.tobytes()]})

        for batch in batches:
            waiting.append(batch)
            n += len(batch)
            if n >= BLOCK_ROWS:
                yield block()
                waiting, n = [], 0
        if n:
            yield block()

    def grow(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        task = BarrierTaskContext.get()
        models = learn(_chunks(batches, bins), targets, sizes, bins, _gathering(task, folder))
        for held in sorted({t.held for t in targets}):
            of = [[s for s in m.seen if s.rows.part == held] for m in models if m.target.held == held]
            for same in zip(*of):
                scores = dict.fromkeys(names) | {c: s.score for c, s in zip(names, same)}
                yield pd.DataFrame({"part": held, "label": same[0].rows.label, **scores, "trees": None})
        if task.partitionId() == 0:
            yield pd.DataFrame({"part": [TEST], "label": [0.0], **dict.fromkeys(names, 0.0), "trees": [pickle.dumps([m.trees for m in models])]})

    packed = rows.select(*features, "label", "part").mapInPandas(pack, "codes binary, label binary, part binary")
    schema = ", ".join(["part int", "label double", *[f"{c} double" for c in names], "trees binary"])
    found = materialised(packed.repartition(_tasks(spark)).mapInPandas(grow, schema, barrier=True), "boosted")
    trees = pickle.loads(found.where("trees IS NOT NULL").first()["trees"])
    return Boosted(trees, found.where("trees IS NULL").drop("trees"), edges)


def _posix(path: str) -> str | None:
    """The path as the file system of a machine has it, if it is one of that kind."""
    found = urlsplit(path)
    return unquote(found.path) if found.scheme in ("", "file") else None


def _gathering(task: BarrierTaskContext, folder: str | None) -> Callable[[bytes], list[bytes]]:
    """Brings every task what each of them says.  Spark's own way takes a second each time; files in the shared folder, if it
    has paths that tasks can open, take a few milliseconds."""
    if folder is None:
        return lambda own: [base64.b64decode(one) for one in task.allGather(base64.b64encode(own).decode())]
    os.makedirs(folder, exist_ok=True)
    attempt, rank = task.allGather(uuid.uuid4().hex)[0], task.partitionId()
    tasks, step = len(task.getTaskInfos()), 0

    def name(k: int, of: int) -> str:
        return f"{folder}/{attempt}-{of}-{k}"

    def read(path: str) -> bytes:
        while True:  # all tasks run; if one fails, Spark ends the others
            try:
                with open(path, "rb") as file:
                    return file.read()
            except FileNotFoundError:
                time.sleep(0.001)

    def gather(own: bytes) -> list[bytes]:
        nonlocal step
        with open(name(rank, step) + ".part", "wb") as file:
            file.write(own)
        os.rename(file.name, name(rank, step))
        found = [own if k == rank else read(name(k, step)) for k in range(tasks)]
        if step:
            os.unlink(name(rank, step - 1))  # whoever writes a step has read the one before
        step += 1
        return found

    return gather


def _tasks(spark: SparkSession) -> int:
    """As many tasks as run at a time."""
    sc = spark.sparkContext._jsc.sc()
    return max(1, min(TASKS, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile())))


def _chunks(batches: Iterator[pd.DataFrame], bins: Sequence[int]) -> list[Rows]:
    """A task's rows, part by part."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    for batch in batches:
        for codes, label, part in zip(batch["codes"], batch["label"], batch["part"]):
            codes, label, part = np.frombuffer(codes, np.uint8).reshape(len(bins), -1), np.frombuffer(label), np.frombuffer(part, np.int16)
            for p in np.unique(part):
                at = np.flatnonzero(part == p)
                held.setdefault(int(p), []).append((codes.take(at, axis=1), label.take(at)))
    groups, chunks = _groups(bins), []
    for p in sorted(held):
        found = held.pop(p)
        codes, label = np.concatenate([c for c, _ in found], axis=1), np.concatenate([y for _, y in found])
        del found
        for a in range(0, len(label), CHUNK):
            chunks.append(Rows(p, codes[:, a : a + CHUNK], label[a : a + CHUNK], groups, bins))
    return chunks


def regression_model(spark: SparkSession, trees: Trees, edges: list[np.ndarray], how: GBTRegressor) -> GBTRegressionModel:
    """The trees as Spark's own model."""
    stats = ["s0", "s1", "s2"]  # rows, sum, sum of squares
    nodes = pd.concat([_nodes(trees, k, edges, stats) for k in range(len(trees.feature))])
    kinds = ("regression.GBTRegressionModel", "regression.DecisionTreeRegressionModel")
    params = {
        "maxIter": how.getMaxIter(), "maxDepth": how.getMaxDepth(), "stepSize": how.getStepSize(), "maxBins": BINS,
        "minInstancesPerNode": how.getMinInstancesPerNode(), "lossType": "squared", "impurity": "variance",
    }
    weights = [1.0] + [how.getStepSize()] * (len(trees.feature) - 1)
    of_tree = {k: v for k, v in params.items() if k not in ("maxIter", "stepSize", "lossType")}
    return load_trees(GBTRegressionModel, spark.createDataFrame(nodes, _NODES), stats, kinds, params, of_tree, weights, {"numFeatures": len(edges)})


_NODES = (
    "tree int, id int, prediction double, impurity double, gain double, n long, left int, right int, feature int, cut double, "
    "s0 double, s1 double, s2 double"
)


def _nodes(trees: Trees, tree: int, edges: list[np.ndarray], stats: list[str]) -> pd.DataFrame:
    """A tree's nodes, numbered from 0 in the order of their places."""
    feature = trees.feature[tree]
    place = np.flatnonzero(trees.n[tree] > 0)
    number = np.zeros(len(feature) + 1, np.int64)
    number[place] = np.arange(len(place))
    n, total, squares, f = trees.n[tree, place], trees.total[tree, place], trees.squares[tree, place], feature[place]
    child = np.where(f >= 0, 2 * place, 0)
    cut = [edges[k][c] if k >= 0 else 0.0 for k, c in zip(f, trees.cut[tree, place])]
    out = {
        "tree": tree, "id": number[place], "prediction": total / n, "impurity": np.maximum(squares / n - (total / n) ** 2, 0.0),
        "gain": trees.gain[tree, place], "n": n.astype(np.int64), "left": np.where(f >= 0, number[child], -1),
        "right": np.where(f >= 0, number[child + 1], -1), "feature": f.astype(np.int64), "cut": cut,
    }
    return pd.DataFrame(out | dict(zip(stats, (n, total, squares))))
