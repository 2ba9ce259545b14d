"""The level-by-level forest against row-by-row counts, all splits, and Spark's own forest."""

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from lossgrid.operators import forest as G
from lossgrid.operators import models as M

X = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.normal(size=3000), rng.integers(0, 5, 3000), rng.exponential(size=3000), rng.normal(size=3000)])
    y = (x[:, 0] > 0.3).astype(int) + ((x[:, 1] > 2) & (x[:, 2] < 1))
    y = np.where(rng.random(3000) < 0.1, rng.integers(0, 3, 3000), y)
    flat = [(*map(float, r), float(k)) for r, k in zip(x, y)]
    return spark.createDataFrame(flat, "a double, b double, c double, d double, label double").repartition(3).localCheckpoint()


def blocks_of(df, classes=3):
    edges = G.bin_edges(df, X)
    return edges, G.binned_blocks(df, X, "label", edges, classes)


def test_few_values_have_a_bin_each_and_nothing_is_left_out(spark, rows, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_ROWS", 500)
    edges, blocks = blocks_of(rows)
    assert list(edges[1]) == [0, 1, 2, 3, 4] and all(len(e) < G.BINS for e in edges)
    found = np.concatenate([np.frombuffer(r["codes"], np.uint8).reshape(4, -1) for r in blocks.collect()], axis=1)
    want = rows.toPandas()
    codes = np.stack([np.searchsorted(e, want[f]) * 3 + want["label"].astype(int) for f, e in zip(X, edges)])
    assert sorted(map(tuple, found.T)) == sorted(map(tuple, codes.T))
    assert blocks.select("block").distinct().count() == blocks.count()


@pytest.mark.parametrize("level", [0, 2, 6, 8])
def test_counts_against_single_rows(level):
    """Rows of leaves are left out, at levels that are walked by columns and at those walked by rows."""
    rng = np.random.default_rng(level)
    growth, trees = G.Growth(4, 3, 1, 7), G.Trees.seeds(2, 9, 3)
    for k in range(1, 1 << level):
        if k == 1 or (trees.feature[1, k // 2] >= 0 and rng.random() < 0.85):
            trees.feature[1, k], trees.cut[1, k] = rng.integers(0, 4), rng.integers(8, 24)
    trees.open[:] = False
    for k in range(1 << level, 2 << level):
        trees.open[1, k] = level == 0 or trees.feature[1, k // 2] >= 0
    blocks = [(b, (rng.integers(0, 32, (4, 400)) * 3 + rng.integers(0, 3, 400)).astype(np.uint8)) for b in (3, 9)]
    nodes = np.flatnonzero(trees.open[1, 1 << level : 2 << level])
    chosen = growth.chosen(1, level, nodes, 2)
    want = np.zeros((2, len(nodes), 96), np.int64)
    for number, codes in blocks:
        drawn = np.random.default_rng((7, 1, number)).integers(0, 1 << 16, 400, np.uint16)
        for i in range(400):
            k = 1
            while k < 1 << level and trees.feature[1, k] >= 0:
                k = 2 * k + int(codes[trees.feature[1, k], i] // 3 > trees.cut[1, k])
            if k >= 1 << level:
                at = list(nodes).index(k - (1 << level))
                for j in range(2):
                    want[j, at, codes[chosen[at, j], i]] += int(G._DRAWS[drawn[i]])
    assert (growth.counts(1, level, trees, blocks) == want).all()


def test_best_split_against_all_splits():
    rng = np.random.default_rng(2)
    growth, chosen = G.Growth(6, 3, 10, 1), np.array([[0, 3, 5], [1, 2, 4], [5, 0, 2]])
    y = rng.integers(0, 3, (3, 60))
    held = np.zeros((3, 3, 32, 3), np.int64)
    for j in range(3):
        for node in range(3):
            bins = np.minimum(rng.integers(0, 20, 60) + 4 * y[node] * (j == 1), 31)
            np.add.at(held, (j, node, bins, y[node]), 1)

    def gini(c):
        return 1 - ((c / c.sum()) ** 2).sum()

    feature, cut, gain, whole, left = growth.best(held.reshape(3, 3, -1), chosen)
    for node in range(3):
        all_splits = {}
        for j in range(3):
            for c in range(31):
                a, b = held[j, node, : c + 1].sum(axis=0), held[j, node, c + 1 :].sum(axis=0)
                if min(a.sum(), b.sum()) >= 10:
                    all_splits[j, c] = gini(a + b) - (a.sum() * gini(a) + b.sum() * gini(b)) / 60
        assert gain[node] == pytest.approx(max(all_splits.values()))
        j = list(chosen[node]).index(feature[node])
        assert all_splits[j, cut[node]] == pytest.approx(gain[node])
        assert (left[node] == held[j, node, : cut[node] + 1].sum(axis=0)).all() and whole[node].sum() == 60


def test_the_same_trees_however_the_blocks_lie(spark, rows, monkeypatch):
    monkeypatch.setattr(G, "BLOCK_ROWS", 250)
    monkeypatch.setattr(G, "NODES", 3)
    _, blocks = blocks_of(rows)
    growth = G.Growth(4, 3, 5, 42)
    one, many = (G.grow(blocks.repartition(n), growth, 4, 7) for n in (1, 5))
    for name in ("feature", "cut", "gain", "held"):
        assert (getattr(one, name) == getattr(many, name)).all()


def test_forest_is_as_good_as_sparks_and_keeps_its_bounds(spark, rows, tmp_path):
    train, test = rows.where("hash(a) % 4 != 0"), rows.where("hash(a) % 4 = 0")
    model = M.stage_classifier(X, trees=30, depth=6, leaf=10).fit(train)
    right = F.avg((F.col("prediction") == F.col("label")).cast("double"))
    spark_model = RandomForestClassifier(numTrees=30, maxDepth=6, minInstancesPerNode=10, seed=42).fit(M._assembler(X).transform(train))
    mine, other = (m.transform(t).agg(right).first()[0] for m, t in ((model, test), (spark_model, M._assembler(X).transform(test))))
    assert mine > other - 0.02 and mine > 0.85
    forest = model.stages[-1]
    assert forest.getNumTrees == 30 and max(t.depth for t in forest.trees) <= 6 and forest.numClasses == 3 and forest.numFeatures == 4
    assert sum(forest.featureImportances) == pytest.approx(1.0) and forest.featureImportances[3] < 0.1
    forest.write().save(str(tmp_path / "m"))
    nodes = {(r["treeID"], r["nodeData"]["id"]): r["nodeData"] for r in spark.read.parquet(str(tmp_path / "m/data")).collect()}
    n = train.count()
    for (tree, number), node in nodes.items():
        held = np.array(node["impurityStats"])
        assert held.sum() == node["rawCount"] >= 10 and node["prediction"] == held.argmax()
        if number == 0:
            assert abs(held.sum() - n) < 6 * n**0.5  # drawn with replacement
        if node["leftChild"] >= 0:
            assert (held == sum(np.array(nodes[tree, node[c]]["impurityStats"]) for c in ("leftChild", "rightChild"))).all()
    again = RandomForestClassificationModel.load(str(tmp_path / "m"))
    said = [m.transform(M._assembler(X).transform(test)).select("probability").collect() for m in (forest, again)]
    assert said[0] == said[1]


def test_no_copy_of_the_rows_grows_with_the_trees(spark, rows):
    """Spark's own forest keeps a number for each pair of a row and a tree."""
    sc, seen = spark.sparkContext, []
    record = G._level
    G._level = lambda *a: (seen.append(sc._jsc.getPersistentRDDs().size()), record(*a))[1]
    try:
        before = sc._jsc.getPersistentRDDs().size()
        M.stage_classifier(X, trees=3, depth=3, leaf=10).fit(rows)
    finally:
        G._level = record
    assert seen == [before] * 3


def test_few_nodes_of_many_trees_travel_together(spark, rows, monkeypatch):
    """A level's groups follow its open nodes, not its trees, and no count takes more bytes than it needs."""
    _, blocks = blocks_of(rows)
    growth, level, sizes = G.Growth(4, 3, 5, 42), G._level, []
    monkeypatch.setattr(G, "_level", lambda *a: (sizes.append((int(a[3].value.open.sum()), level(*a).count())), level(*a))[1])
    G.grow(blocks, growth, 40, 5)
    assert sizes[0] == (40, 1) and len(sizes) == 5
    assert all(groups <= 2 * nodes / G.NODES + 1 for nodes, groups in sizes)
