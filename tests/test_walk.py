"""Scores of a walked forest against Spark's own, row by row."""

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.sql import functions as F

from lossgrid.operators import models as M
from lossgrid.operators import walk as W

X = ["a", "b", "c"]


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.normal(size=9000), rng.integers(0, 4, 9000), rng.exponential(size=9000)])
    y = (x[:, 0] > 0.3).astype(int) + ((x[:, 1] > 1) & (x[:, 2] < 1))
    y = np.where(rng.random(9000) < 0.1, rng.integers(0, 3, 9000), y)
    flat = [(f"L{k:06}", *map(float, r), float(c)) for k, (r, c) in enumerate(zip(x, y))]
    found = spark.createDataFrame(flat, "loan_id string, a double, b double, c double, label double")
    return found.withColumn("stage", F.concat(F.lit("STAGE_"), (F.col("label") + 1).cast("int"))).coalesce(1).localCheckpoint()


@pytest.fixture(scope="module", params=["grown here", "Spark's"])
def model(request, rows):
    if request.param == "grown here":
        return M.stage_classifier(X, trees=12, depth=7, leaf=3).fit(rows)
    forest = RandomForestClassifier(numTrees=12, maxDepth=7, minInstancesPerNode=3, seed=1)
    return Pipeline(stages=[M._assembler(X), forest]).fit(rows)


def test_the_very_scores_of_sparks_model(rows, model):
    names = ["loan_id", "predicted_stage", "prob_stage_1", "prob_stage_2", "prob_stage_3"]
    cuts = {n.split("<= ")[1].split(")")[0] for n in model.stages[-1].toDebugString.split("If (feature 0 ")[1:]}
    edge = rows.limit(len(cuts)).toPandas().assign(a=sorted(map(float, cuts)))  # values that are thresholds themselves
    seen = rows.unionByName(rows.sparkSession.createDataFrame(edge).withColumn("loan_id", F.concat(F.lit("E"), "loan_id")))
    want = M.with_stage_scores(model.transform(seen)).select(names).collect()
    assert sorted(M.stage_scores(seen, model).select(names).collect()) == sorted(want) and len(want) > 2 * W.ROWS


def test_scoring_never_asks_sparks_model_row_by_row(rows, model, monkeypatch, capsys):
    def refused(*_):
        raise AssertionError("rows went through the model's objects")

    monkeypatch.setattr(RandomForestClassificationModel, "transform", refused)
    scored = M.score_portfolio(rows, model)
    scored.explain()
    assert capsys.readouterr().out.count("ArrowEvalPython [") == 1  # all columns of a row come from one walk
    assert scored.count() == rows.count()


def test_a_tree_that_is_a_single_leaf(spark, rows):
    flat = rows.withColumns({f: F.lit(1.0) for f in X})
    model = M.stage_classifier(X, trees=2, depth=3).fit(flat)
    got = M.score_portfolio(flat, model).select("prob_stage_1", "prob_stage_2", "prob_stage_3").distinct().collect()
    want = M.with_stage_scores(model.transform(flat)).select("prob_stage_1", "prob_stage_2", "prob_stage_3").distinct().collect()
    assert got == want and len(got) == 1


def test_a_feature_without_a_value_is_an_error(rows, model):
    for value in (F.lit(None).cast("double"), F.lit(float("nan"))):
        with pytest.raises(Exception, match="without a value"):
            M.score_portfolio(rows.withColumn("b", value), model).collect()
