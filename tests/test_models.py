"""Sizes of the registered models, and the two families of the selection."""

import inspect
from threading import Barrier

import pytest
from pyspark.sql import functions as F

from lossgrid.operators import models as M
from lossgrid.plans import q_models
from lossgrid.plans.registry import load_all

Q = load_all()


class Sizes(Exception):
    pass


def _sizes(monkeypatch, tables, key, name):
    of = inspect.signature(getattr(M, name))

    def seen(*args, **more):
        bound = of.bind(*args, **more)
        bound.apply_defaults()
        raise Sizes(bound.arguments)

    monkeypatch.setattr(M, name, seen)
    monkeypatch.setattr(q_models, "_FITS", {})
    with pytest.raises(Sizes) as got:
        Q[key].build(tables)
    return got.value.args[0]


@pytest.mark.parametrize(
    "key, name, want",
    [
        ("train_stage_classifier", "train_stage", {"trees": 100, "depth": 10, "folds": 5}),
        ("train_stage_8feat", "train_stage", {"trees": 200, "depth": 12, "folds": 5}),
        ("model_store", "train_stage", {"trees": 100, "depth": 10, "folds": 5}),
        ("score_portfolio", "train_stage", {"trees": 100, "depth": 10}),
        ("scan_batched_score", "train_stage", {"trees": 100, "depth": 10}),
        ("select_model", "train_stage", {"trees": 100, "depth": 10}),
        ("train_pd_regressor", "train_pd", {"rounds": 100, "depth": 5}),
        ("tune_model", "tune", {"draws": 50, "folds": 5, "max_trees": 300}),
    ],
)
def test_registered_sizes(monkeypatch, tables, key, name, want):
    got = _sizes(monkeypatch, tables, key, name)
    assert {k: got[k] for k in want} == want


def test_selection_compares_two_families(monkeypatch, tables):
    monkeypatch.setattr(q_models, "_FITS", {})
    monkeypatch.setattr(M, "train_stage", lambda *a, **k: M.Fit(None, {"accuracy": 0.7, "roc_auc": 0.1}, {}))
    monkeypatch.setattr(M, "train_boosted", lambda *a, **k: {"accuracy": 0.2, "roc_auc": 0.9}, raising=False)
    got = {r["strategy"]: (r["selected"], r["simple"], r["advanced"]) for r in Q["select_model"].build(tables).collect()}
    assert got["auto"] == ("advanced", 0.7, 0.9) and got["simple_only"] == ("simple", 0.7, 0.9)


def test_boosted_family_learns_the_stages(spark):
    rows = spark.range(600).select(
        F.col("id").alias("loan_id"), (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
        F.concat(F.lit("STAGE_"), (F.col("id") % 3 + 1).cast("string")).alias("stage"),
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 5 > 0).alias("is_train"),
    )
    assert M.train_boosted(rows, ["x", "y"], rounds=3, depth=2) == {"accuracy": 1.0, "roc_auc": 1.0}


def test_training_rows_are_dealt_over_the_cores(spark, tables):
    cores = spark.sparkContext.defaultParallelism
    assert tables.staged.rdd.getNumPartitions() < cores  # one small file
    table = M.training_table(tables.staged)
    assert table.rdd.getNumPartitions() >= min(cores, 8) and table.count() == tables.staged.count()
    held = table.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in held) < table.count() / 2


def test_no_forest_is_fitted_beside_the_folds(spark, monkeypatch):
    rows = spark.range(600).select(
        F.concat(F.lit("L"), F.col("id")).alias("loan_id"), (F.col("id") % 3).cast("double").alias("x"), (F.col("id") % 7).cast("double").alias("y"),
        F.concat(F.lit("STAGE_"), (F.col("id") % 3 + 1).cast("string")).alias("stage"),
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 5 > 0).alias("is_train"),
    )
    fit, sizes = M.Pipeline.fit, []
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, df, params=None: sizes.append(df.count()) or fit(self, df, params))
    found = M.train_stage(rows, ["x", "y"], trees=5, depth=3, folds=3)
    whole, *folds = sorted(sizes, reverse=True)
    assert whole == 480 and len(folds) == 3 and sum(whole - n for n in folds) == 480  # every row is held out once
    assert found.metrics == {"accuracy": 1.0, "roc_auc": 1.0, "cv_mean": 1.0, "cv_std": 0.0}


def test_boosted_models_are_fitted_side_by_side(spark, monkeypatch):
    rows = spark.range(300).select(
        F.col("id").alias("loan_id"), (F.col("id") % 3).cast("double").alias("x"),
        F.concat(F.lit("STAGE_"), (F.col("id") % 3 + 1).cast("string")).alias("stage"),
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 5 > 0).alias("is_train"),
    )
    together, fit = Barrier(3, timeout=60), M.GBTClassifier.fit
    monkeypatch.setattr(M.GBTClassifier, "fit", lambda self, df, params=None: (together.wait(), fit(self, df, params))[1])
    assert M.train_boosted(rows, ["x"], rounds=2, depth=2) == {"accuracy": 1.0, "roc_auc": 1.0}


def test_pd_metrics_and_folds(spark, monkeypatch):
    rows = spark.range(400).select(
        F.concat(F.lit("L"), F.col("id")).alias("loan_id"), F.lit("STAGE_1").alias("stage"), (F.col("id") % 5).cast("double").alias("x"),
        ((F.col("id") % 5) / 10).alias("label"), (F.col("id") % 4 > 0).alias("is_train"),
    )
    together, fit = Barrier(3, timeout=60), M.Pipeline.fit  # the model and two folds
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, df, params=None: (together.wait(), fit(self, df, params))[1])
    m = M.train_pd(rows, ["x"], rounds=5, depth=3, folds=2).metrics
    assert set(m) == {"mae", "mse", "rmse", "r2", "cv_mae_mean", "cv_mae_std"}
    assert m["mae"] < 0.01 and m["r2"] > 0.99 and m["cv_mae_mean"] < 0.01 and m["rmse"] ** 2 == pytest.approx(m["mse"])


def test_the_stage_model_is_fitted_beside_its_folds(spark, monkeypatch):
    rows = spark.range(300).select(
        F.concat(F.lit("L"), F.col("id")).alias("loan_id"), (F.col("id") % 3).cast("double").alias("x"),
        F.concat(F.lit("STAGE_"), (F.col("id") % 3 + 1).cast("string")).alias("stage"),
        (F.col("id") % 3).cast("double").alias("label"), (F.col("id") % 5 > 0).alias("is_train"),
    )
    together, fit = Barrier(3, timeout=60), M.Pipeline.fit  # the model and two folds
    monkeypatch.setattr(M.Pipeline, "fit", lambda self, df, params=None: (together.wait(), fit(self, df, params))[1])
    found = M.train_stage(rows, ["x"], trees=2, depth=2, folds=2)
    assert found.metrics == {"accuracy": 1.0, "roc_auc": 1.0, "cv_mean": 1.0, "cv_std": 0.0}
