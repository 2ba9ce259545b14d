"""Hyper-parameter search: a tree-structured Parzen sampler, stratified folds and early stop of poor trials.

The search works on a bounded sample of labelled rows, so a forest of a trial is one task's work and many trials run side
by side; the model with the parameters found is then fitted by Spark ML on all rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from statistics import NormalDist, median

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lossgrid.operators.sampling import loan_hash, stratified_sample

#: Labelled rows that a search uses at most, of each stage as many as its share.
LABELLED_ROWS = 2_000

#: Trials drawn evenly before the sampler looks at past ones, and trials that run at a time.
STARTUP, AT_A_TIME = 10, 8

#: A trial is stopped early once so many others are complete.
BEFORE_STOPPING = 5


@dataclass(frozen=True)
class Whole:
    """Whole numbers from ``low`` to ``high`` in steps."""

    low: int
    high: int
    step: int = 1

    def nearest(self, x: float) -> int:
        k = round((min(max(x, self.low), self.high) - self.low) / self.step)
        return self.low + k * self.step


@dataclass
class Trial:
    params: dict[str, int]
    scores: list[float] = field(default_factory=list)
    stopped: bool = False

    @property
    def mean(self) -> float:
        return sum(self.scores) / len(self.scores)


class Density:
    """Mixture of normals around past values, and a wide one over the whole range, cut off at its ends."""

    def __init__(self, of: Whole, values: Sequence[int]):
        self.low, self.high = of.low - of.step / 2, of.high + of.step / 2
        width = self.high - self.low
        centres = sorted(values)
        ends = [self.low, *centres, self.high]
        least = width / min(100, len(centres) + 2)
        self.parts = [NormalDist((self.low + self.high) / 2, width)]
        for before, centre, after in zip(ends, centres, ends[2:]):
            self.parts.append(NormalDist(centre, min(width, max(least, centre - before, after - centre))))

    def _kept(self, part: NormalDist) -> float:
        return part.cdf(self.high) - part.cdf(self.low)

    def draw(self, rng: np.random.Generator) -> float:
        part = self.parts[rng.integers(len(self.parts))]
        return part.inv_cdf(part.cdf(self.low) + rng.uniform(1e-9, 1 - 1e-9) * self._kept(part))

    def log(self, x: float) -> float:
        return math.log(sum(p.pdf(x) / self._kept(p) for p in self.parts) / len(self.parts))


class ParzenSampler:
    """Draws where good trials are dense and poor ones are not, each parameter on its own."""

    def __init__(self, space: Mapping[str, Whole], seed: int, startup: int = STARTUP, candidates: int = 24):
        self.space, self.startup, self.candidates = dict(space), startup, candidates
        self.rng = np.random.default_rng(seed)

    def suggest(self, past: Sequence[Trial]) -> dict[str, int]:
        if len(past) < self.startup:
            return {n: s.nearest(self.rng.uniform(s.low - s.step / 2, s.high + s.step / 2)) for n, s in self.space.items()}
        # stopped trials come after complete ones, those that got further first
        ranked = sorted(past, key=lambda t: (t.stopped, -len(t.scores), -t.mean))
        cut = min(25, math.ceil(0.1 * len(ranked)))
        out = {}
        for name, space in self.space.items():
            good, poor = (Density(space, [t.params[name] for t in part]) for part in (ranked[:cut], ranked[cut:]))
            drawn = [good.draw(self.rng) for _ in range(self.candidates)]
            out[name] = space.nearest(max(drawn, key=lambda x: good.log(x) - poor.log(x)))
        return out


def labelled_sample(table: DataFrame, rows: int = LABELLED_ROWS, folds: int = 5) -> DataFrame:
    """At most ``rows`` training rows, each stage by its share, with ``fold``: every fold has the stages' shares too."""
    train = table.where("is_train")
    sizes = {r["stage"]: r["n"] for r in train.groupBy("stage").agg(F.count("*").alias("n")).collect()}
    whole = sum(sizes.values())
    if whole > rows:
        sizes = {s: rows * n // whole for s, n in sizes.items()}
    sample = stratified_sample(train, "stage", sizes) if sizes else train
    place = F.row_number().over(Window.partitionBy("stage").orderBy(loan_hash(), "loan_id"))
    return sample.withColumn("fold", (place % folds).cast("int"))


def mean_auc(actual: np.ndarray, scores: np.ndarray) -> float:
    """Mean of the classes' one-vs-rest AUC, ties counted half; classes that are missing or alone are left out."""
    found = []
    for k in range(scores.shape[1]):
        is_k = actual == k
        n, rest = int(is_k.sum()), int((~is_k).sum())
        if n and rest:
            _, place, count = np.unique(scores[:, k], return_inverse=True, return_counts=True)
            rank = (np.cumsum(count) - (count - 1) / 2)[place]
            found.append((rank[is_k].sum() - n * (n + 1) / 2) / (n * rest))
    return float(np.mean(found)) if found else math.nan


@dataclass(frozen=True)
class Sample:
    """The labelled rows as arrays: features, class numbers and folds; at most the bound of ``labelled_sample``."""

    x: np.ndarray
    y: np.ndarray
    fold: np.ndarray

    @classmethod
    def of(cls, sample: DataFrame, features: Sequence[str]) -> Sample:
        rows = sample.select(*features, "label", "fold").toPandas()
        return cls(rows[list(features)].to_numpy(dtype=float), rows["label"].to_numpy(dtype=np.int64), rows["fold"].to_numpy())


#: Bins of a feature's values, as many as Spark's trees have.
BINS = 32


def forest_scores(
    x: np.ndarray, y: np.ndarray, unseen: np.ndarray, classes: int, trees: int, depth: int, leaf: int, seed: int
) -> np.ndarray:
    """Class probabilities of ``unseen`` by a random forest grown on the rows: bootstrap, square root of the features at
    each node, Gini splits that leave ``leaf`` rows on both sides.  All nodes of a level are split at once."""
    rng = np.random.default_rng(seed)
    edges = [np.unique(np.quantile(c, np.arange(1, BINS) / BINS)) for c in x.T]
    of, to = (np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, v.T)], axis=1) for v in (x, unseen))
    some = math.ceil(math.sqrt(x.shape[1]))
    out = np.zeros((len(unseen), classes))
    for _ in range(trees):
        weight = rng.poisson(1.0, len(y)).astype(float)
        rows = np.flatnonzero(weight)
        node, weight, label = np.zeros(len(rows), np.int64), weight[rows], y[rows]
        asked, place, nodes = np.arange(len(unseen)), np.zeros(len(unseen), np.int64), 1
        for level in range(depth + 1):
            if not len(rows):
                out[asked] += 1.0 / classes
                break
            counts = np.bincount(node * classes + label, weight, nodes * classes).reshape(nodes, classes)
            whole = counts.sum(axis=1)
            if level == depth:
                out[asked] += counts[place] / whole[place, None]
                break
            chosen = rng.random((nodes, x.shape[1])).argsort(axis=1)[:, :some]
            bins = of[rows[:, None], chosen[node]]
            at = ((node[:, None] * some + np.arange(some)) * BINS + bins) * classes + label[:, None]
            held = np.bincount(at.ravel(), np.repeat(weight, some), nodes * some * BINS * classes)
            left = held.reshape(nodes, some, BINS, classes).cumsum(axis=2)[:, :, :-1]
            right = counts[:, None, None] - left
            n_left, n_right = left.sum(axis=3), right.sum(axis=3)
            pure = (left**2).sum(axis=3) / np.maximum(n_left, 1) + (right**2).sum(axis=3) / np.maximum(n_right, 1)
            pure[(n_left < leaf) | (n_right < leaf)] = -1.0
            best = pure.reshape(nodes, -1).argmax(axis=1)
            gain = pure.reshape(nodes, -1)[np.arange(nodes), best] - (counts**2).sum(axis=1) / whole
            splits = gain > 1e-9
            feature, cut = chosen[np.arange(nodes), best // (BINS - 1)], best % (BINS - 1)
            done = ~splits[place]
            out[asked[done]] += counts[place[done]] / whole[place[done], None]
            child = np.cumsum(splits) - 1  # a node's pair of children in the next level
            on = splits[node]
            rows, node, weight, label = rows[on], node[on], weight[on], label[on]
            node = 2 * child[node] + (of[rows, feature[node]] > cut[node])
            asked, place = asked[~done], place[~done]
            place = 2 * child[place] + (to[asked, feature[place]] > cut[place])
            nodes = 2 * int(splits.sum())
            if not len(asked):
                break
    return out / trees


def _scores(spark: SparkSession, sample: Sample, params: Sequence[Mapping[str, int]], fold: int, seed: int) -> list[float]:
    """AUC on one fold of a forest for each of ``params``: a task each."""
    classes = int(sample.y.max()) + 1

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = sample.fold == fold
        for batch in batches:
            found = []
            for row in batch.itertuples():
                p = forest_scores(
                    sample.x[~held], sample.y[~held], sample.x[held], classes, row.trees, row.depth, row.leaf, seed + row.trial
                )
                found.append((row.trial, mean_auc(sample.y[held], p)))
            yield pd.DataFrame(found, columns=["trial", "auc"])

    rows = [(k, p["trees"], p["depth"], p["leaf"]) for k, p in enumerate(params)]
    asked = spark.createDataFrame(rows, "trial int, trees int, depth int, leaf int")
    scored = asked.repartitionByRange(len(rows), "trial").mapInPandas(run, "trial int, auc double")
    return [r["auc"] for r in sorted(scored.collect())]


def search(
    spark: SparkSession, sample: Sample, space: Mapping[str, Whole], draws: int = 50, folds: int = 5, seed: int = 42, at_a_time: int = AT_A_TIME
) -> list[Trial]:
    """All trials in order.  A fold is run for some trials at a time; whoever is below the median of the complete
    trials after as many folds is stopped."""
    sampler, past = ParzenSampler(space, seed), []
    while len(past) < draws:
        unguided = sampler.startup - len(past)
        size = min(at_a_time, draws - len(past), unguided if unguided > 0 else draws)
        running = batch = [Trial(sampler.suggest(past)) for _ in range(size)]
        done = [t for t in past if not t.stopped]
        for fold in range(folds):
            if not running:
                break
            for trial, score in zip(running, _scores(spark, sample, [t.params for t in running], fold, seed)):
                trial.scores.append(score)
            if len(done) >= BEFORE_STOPPING and fold + 1 < folds:
                bar = median(sum(t.scores[: fold + 1]) / (fold + 1) for t in done)
                for trial in running:
                    trial.stopped = trial.mean < bar
                running = [t for t in running if not t.stopped]
        past += batch
    return past
