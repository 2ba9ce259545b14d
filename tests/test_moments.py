"""Pairwise moments, correlations and distances against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import explain as E
from lossgrid.operators import moments as M


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(900, 4)) @ rng.normal(size=(4, 4)) + np.array([0, 5, 1e9, -3])
    gone = rng.random(x.shape) < 0.2
    data = [[None if g else float(v) for v, g in zip(r, m)] for r, m in zip(x, gone)]
    data += [[None] * 4, [1.0, float("nan"), None, 2.0]]
    return x, gone, spark.createDataFrame([(*r, 7.0) for r in data], "a double, b double, c double, d double, e double").repartition(5)


def test_moments_of_pairs(rows):
    x, gone, frame = rows
    x, gone = np.vstack([x, [1.0, 0, 0, 2.0]]), np.vstack([gone, [False, True, True, False]])
    got = {(r["a"], r["b"]): r for r in M.cross_moments(frame, list("abcde")).collect()}
    assert len(got) == 15
    for i, p in enumerate("abcd"):
        for j, q in enumerate("abcd"):
            if j >= i:
                there = ~gone[:, i] & ~gone[:, j]
                u, v = x[there, i], x[there, j]
                r = got[p, q]
                assert r["n"] == there.sum()
                assert r["mean_a"] == pytest.approx(u.mean()) and r["mean_b"] == pytest.approx(v.mean())
                assert r["product"] == pytest.approx(((u - u.mean()) * (v - v.mean())).sum(), rel=1e-6, abs=1e-6)
                assert r["square_a"] == pytest.approx(((u - u.mean()) ** 2).sum(), rel=1e-6)


def test_correlations(rows):
    x, gone, frame = rows
    got = {(r["a"], r["b"]): r["r"] for r in M.correlations(frame.limit(900), list("abcde")).collect()}
    assert got["a", "e"] is None  # a constant
    whole = frame.select("a", "b").dropna().toPandas().to_numpy()
    assert M.correlations(frame, ["a", "b"]).first()["r"] == pytest.approx(np.corrcoef(whole.T)[0, 1])


def test_no_rows(spark):
    assert M.cross_moments(spark.createDataFrame([], "a double, b double"), ["a", "b"]).count() == 0


def test_distance_on_nine_columns(tables):
    frame = tables.results.where(F.col("current_balance") > 0)
    got = {r["loan_id"]: r["distance"] for r in E.with_mahalanobis(tables.results).select("loan_id", "distance").collect()}
    x = frame.select("loan_id", *E.OUTLIER_FEATURES).toPandas().fillna(0.0).set_index("loan_id").astype(float)
    away = x.to_numpy() - x.to_numpy().mean(axis=0)
    want = np.sqrt(np.einsum("ij,jk,ik->i", away, np.linalg.inv(np.cov(x.to_numpy().T, bias=True)), away))
    assert len(got) == len(x)
    np.testing.assert_allclose([got[i] for i in x.index], want, rtol=1e-6)


def test_columns_that_follow_from_others_add_nothing(tables):
    more = tables.results.withColumn("twice", F.col("loan_amount") * 2 + 1).withColumn("same", F.lit(4.0))
    plain = E.with_mahalanobis(more, ["loan_amount", "dti_ratio"]).select("loan_id", F.round("distance", 6).alias("distance"))
    wide = E.with_mahalanobis(more, ["loan_amount", "twice", "same", "dti_ratio"]).select("loan_id", F.round("distance", 6).alias("distance"))
    assert plain.exceptAll(wide).count() == 0
