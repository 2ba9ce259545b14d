"""Shapley values of fitted trees against all coalitions."""

from itertools import combinations
from math import factorial

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import functions as F

from lossgrid.operators import attributions as A

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 4)).round(2)
    label = ((x[:, 0] > 0).astype(int) + ((x[:, 1] * x[:, 2] > 0.2) & (x[:, 0] < 1))).astype(float)
    frame = spark.createDataFrame([(k, *map(float, r), float(y)) for k, (r, y) in enumerate(zip(x, label))], "id long, a double, b double, c double, d double, label double")
    return x, VectorAssembler(inputCols=FEATURES, outputCol="features").transform(frame).cache()


def expectation(nodes, x, known, node=0):
    """A tree's expectation when only the known features are."""
    here = nodes[node]
    if here["leftChild"] < 0:
        stats = np.array(here["impurityStats"])
        return stats / stats.sum()
    f, cut = here["split"]["featureIndex"], here["split"]["leftCategoriesOrThreshold"][0]
    sides = (here["leftChild"], here["rightChild"])
    if f in known:
        return expectation(nodes, x, known, sides[int(x[f] > cut)])
    size = [sum(nodes[s]["impurityStats"]) for s in sides]
    return sum(n / sum(size) * expectation(nodes, x, known, s) for n, s in zip(size, sides))


def by_coalitions(nodes, x):
    m = len(FEATURES)
    out = np.zeros((m, 3))
    for f in range(m):
        rest = [g for g in range(m) if g != f]
        for size in range(m):
            weight = factorial(size) * factorial(m - size - 1) / factorial(m)
            for known in combinations(rest, size):
                out[f] += weight * (expectation(nodes, x, {*known, f}) - expectation(nodes, x, set(known)))
    return out


def test_forest_against_coalitions(spark, data, tmp_path):
    x, frame = data
    model = RandomForestClassifier(numTrees=4, maxDepth=4, seed=3).fit(frame)
    model.save(str(tmp_path / "m"))
    trees = {}
    for r in spark.read.parquet(str(tmp_path / "m" / "data")).collect():
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    got = A.forest_of(spark, model).values(x[:25])
    for k in range(25):
        want = sum(by_coalitions(nodes, x[k]) for nodes in trees.values()) / 4
        np.testing.assert_allclose(got[k], want, atol=1e-9)


def test_values_add_up(spark, data):
    x, frame = data
    model = RandomForestClassifier(numTrees=20, maxDepth=6, seed=3).fit(frame)
    found = A.attributions(frame, "id", FEATURES, A.forest_of(spark, model))
    both = found.join(model.transform(frame).select("id", vector_to_array("probability").alias("p")), "id")
    assert both.agg(F.max(F.greatest(*[F.abs(F.col("expected")[k] - F.col("p")[k]) for k in range(3)]))).first()[0] < 1e-9
    ranked = [r["feature"] for r in A.importance(found, FEATURES).collect()]
    assert ranked[0] == "a" and sorted(ranked) == FEATURES
    assert A.importance(found, FEATURES, top=2).count() == 2


def test_boosted_values_add_up(spark, data):
    _, frame = data
    model = GBTRegressor(maxIter=6, maxDepth=3, seed=1).fit(frame)
    found = A.attributions(frame, "id", FEATURES, A.forest_of(spark, model))
    both = found.join(model.transform(frame).select("id", "prediction"), "id")
    assert both.agg(F.max(F.abs(F.col("expected")[0] - F.col("prediction")))).first()[0] < 1e-9
