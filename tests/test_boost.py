"""Boosted trees against Spark's own, folds on all rows, and one job for all rounds."""

import uuid

import numpy as np
import pytest
from pyspark.errors import PythonException
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import functions as F

from lossgrid.operators import boost as B
from lossgrid.operators import models as M

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    """Few values of each feature, so that Spark's bins are the same."""
    rng = np.random.default_rng(5)
    x = rng.integers(0, [20, 7, 30], (4000, 3)).astype(float)
    label = np.sin(x[:, 0] / 4) + (x[:, 1] > 3) * x[:, 2] / 20 + rng.normal(size=4000) / 10
    part = rng.integers(-1, 3, 4000)
    flat = [(f"L{k}", *map(float, r), float(y), int(p)) for k, (r, y, p) in enumerate(zip(x, label, part))]
    return spark.createDataFrame(flat, "loan_id string, a double, b double, c double, label double, part int").repartition(5).localCheckpoint()


def test_regression_is_sparks(spark, rows):
    how = GBTRegressor(maxIter=12, maxDepth=4, stepSize=0.1, minInstancesPerNode=10)
    found = B.fit(rows, X, [B.Target(), B.Target(held=1)], how)
    assembled = M._assembler(X).transform(rows)
    for held, learned, trees in ((-1, "part >= 0", found.trees[0]), (1, "part in (0, 2)", found.trees[1])):
        theirs = how.fit(assembled.where(learned))
        want = sorted((r["label"], r["prediction"]) for r in theirs.transform(assembled.where(F.col("part") == held)).collect())
        got = sorted((r["label"], r["s0"]) for r in found.scored.where(F.col("part") == held).collect())
        assert np.allclose(got, want, atol=1e-5)
        mine = B.regression_model(spark, trees, found.edges, how)
        said = sorted((r["label"], r["prediction"]) for r in mine.transform(assembled.where(F.col("part") == held)).collect())
        assert np.allclose(said, got, atol=1e-12)
        assert mine.getNumTrees == 12 and mine.treeWeights == theirs.treeWeights and mine.totalNumNodes == theirs.totalNumNodes
        assert np.allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=1e-4)


def test_classes_are_sparks(rows):
    how = GBTClassifier(labelCol="is", maxIter=8, maxDepth=3, stepSize=0.1, minInstancesPerNode=10)
    kinds = rows.withColumn("label", (F.col("label") > 0).cast("double") + (F.col("label") > 1).cast("double"))
    found = B.fit(kinds, X, [B.Target(of=float(k)) for k in range(3)], how).scored
    assert found.count() == rows.where("part = -1").count()
    got = sorted(tuple(r[c] for c in ("label", "s0", "s1", "s2")) for r in found.collect())
    for k in range(3):
        one = M._assembler(X).transform(kinds.withColumn("is", (F.col("label") == k).cast("double")))
        said = how.fit(one.where("part >= 0")).transform(one.where("part = -1")).withColumn("raw", vector_to_array("rawPrediction")[1])
        want = sorted((r["label"], r["raw"]) for r in said.collect())
        assert np.allclose(sorted((g[0], g[1 + k]) for g in got), want, atol=1e-4)


def _same(one, other):
    return all((getattr(a, c) == getattr(b, c)).all() for a, b in zip(one, other) for c in ("feature", "cut", "gain", "n", "total"))


def test_the_same_trees_wherever_the_rows_lie(rows, monkeypatch):
    how, targets = GBTRegressor(maxIter=5, maxDepth=4, minInstancesPerNode=10), [B.Target(), B.Target(held=0)]
    want = B.fit(rows, X, targets, how)
    monkeypatch.setattr(B, "bin_edges", lambda *a: want.edges)
    monkeypatch.setattr(B, "TASKS", 1)
    one = B.fit(rows.coalesce(1), X, targets, how)
    monkeypatch.setattr(B, "TASKS", 3)
    monkeypatch.setattr(B, "BLOCK_ROWS", 100)
    assert _same(want.trees, one.trees) and _same(want.trees, B.fit(rows, X, targets, how).trees)


def test_tasks_can_talk_without_shared_files(rows, monkeypatch):
    how = GBTRegressor(maxIter=2, maxDepth=2, minInstancesPerNode=10)
    want = B.fit(rows, X, [B.Target()], how).trees
    monkeypatch.setattr(B, "_posix", lambda path: None)
    assert _same(want, B.fit(rows, X, [B.Target()], how).trees)
    assert [B.urlsplit(p).scheme for p in ("/a/b", "file:/a", "hdfs://n/a")] == ["", "file", "hdfs"]


def test_chunks_are_exact_however_full():
    """Sums over chunks with the largest residuals."""
    n, bins = B.CHUNK, [2, 3]
    codes = np.stack([np.arange(n) % 2, np.arange(n) % 3]).astype(np.uint8)
    label = np.where(codes[0] == 1, 1.0, -1.0)
    chunks = [B.Rows(0, codes, label, B._groups(bins), bins)] * 3
    model = B.learn(chunks, [B.Target()], B.Sizes(1, 1, 1, 0.1, False), bins, lambda one: [one])[0]
    assert model.trees.n[0].tolist() == [0, 3 * n, 3 * n / 2, 3 * n / 2] and model.trees.total[0].tolist() == [0, 0, -3 * n / 2, 3 * n / 2]


def test_a_row_without_a_value_is_an_error(rows):
    with pytest.raises(PythonException, match="without a value"):
        B.fit(rows.withColumn("label", F.when(F.col("a") == 3, F.lit(float("nan"))).otherwise(1.0)), X, [B.Target()], GBTRegressor(maxIter=1))


def test_folds_hold_every_training_row(spark):
    """A model that knows nothing of a loan says the mean of the labels outside its fold: the error of all rows is known."""
    n, folds = 6000, 3
    table = spark.range(n).select(
        F.concat(F.lit("L"), F.col("id")).alias("loan_id"), F.lit("STAGE_1").alias("stage"), F.lit(1.0).alias("x"),
        F.when(F.col("id") % 977 == 5, 0.9).otherwise(0.1).alias("label"), (F.col("id") % 4 > 0).alias("is_train"),
    )
    found = table.select("label", "is_train", F.pmod(F.xxhash64("loan_id"), F.lit(folds)).alias("fold")).toPandas()
    train = found[found["is_train"]]
    want = []
    for k in range(folds):
        said = train["label"][train["fold"] != k].mean()
        want.append((train["label"][train["fold"] == k] - said).abs().mean())
    m = M.train_pd(table, ["x"], rounds=3, depth=2, folds=folds).metrics
    assert m["cv_mae_mean"] == pytest.approx(np.mean(want), abs=1e-6) and m["cv_mae_std"] == pytest.approx(np.std(want), abs=1e-6)
    rest = found[~found["is_train"]]
    assert m["mae"] == pytest.approx((rest["label"] - train["label"].mean()).abs().mean(), abs=1e-6)


def test_pd_model_is_sparks_kind_and_keeps(spark, rows, tmp_path):
    table = rows.select("*", F.lit("STAGE_1").alias("stage"), (F.col("part") >= 0).alias("is_train"))
    fit = M.train_pd(table, X, rounds=4, depth=3, folds=2)
    fit.model.write().save(str(tmp_path / "m"))
    again = M.PipelineModel.load(str(tmp_path / "m"))
    assert isinstance(again.stages[-1], GBTRegressionModel) and sum(fit.importance.values()) == pytest.approx(1.0)
    said = [sorted(r["prediction"] for r in m.transform(rows).select("prediction").collect()) for m in (fit.model, again)]
    assert said[0] == said[1]
    assert fit.model.stages[-1].trees[0].depth <= 3


def test_rounds_of_the_stages_models_are_one_job(spark):
    """All rounds and models in one pass over Spark's scheduler: more rounds make no more jobs."""
    table = spark.range(600).select(
        F.col("id").alias("loan_id"), (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
        F.concat(F.lit("STAGE_"), (F.col("id") % 3 + 1).cast("string")).alias("stage"),
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 5 > 0).alias("is_train"),
    )
    sc, jobs = spark.sparkContext, []

    def next_job() -> int:
        sc.setJobGroup(name := uuid.uuid4().hex, "")
        spark.range(1).collect()
        sc.setLocalProperty("spark.jobGroup.id", None)
        return max(sc.statusTracker().getJobIdsForGroup(name))

    for rounds in (2, 6):
        first = next_job()
        assert M.train_boosted(table, ["x", "y"], rounds=rounds, depth=3) == {"accuracy": 1.0, "roc_auc": 1.0}
        jobs.append(next_job() - first)
    assert jobs[0] == jobs[1] > 1
