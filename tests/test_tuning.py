"""Parzen sampler, folds and stopping of the parameter search."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lossgrid.operators import models as M
from lossgrid.operators import tuning as T

SPACE = {"trees": T.Whole(5, 300, 5), "depth": T.Whole(3, 8), "leaf": T.Whole(1, 20)}


def run(monkeypatch, score, draws=50):
    monkeypatch.setattr(T, "_scores", lambda spark, sample, params, fold, seed: [score(p, fold) for p in params])
    return T.search(None, None, SPACE, draws=draws)


def test_sampler_goes_where_trials_are_good(monkeypatch):
    """A peak that blind draws hit rarely."""
    peak = lambda p, fold: 1.0 - abs(p["trees"] - 240) / 300 - abs(p["depth"] - 7) / 20 - abs(p["leaf"] - 3) / 60 + fold * 1e-4
    trials = run(monkeypatch, peak)
    assert len(trials) == 50
    late = [t.params["trees"] for t in trials[30:]]
    early = [t.params["trees"] for t in trials[:10]]
    assert np.median(np.abs(np.array(late) - 240)) < 0.6 * np.median(np.abs(np.array(early) - 240))
    assert max(t.mean for t in trials) >= max(t.mean for t in trials[:10])
    for t in trials:
        assert all(s.low <= t.params[n] <= s.high and (t.params[n] - s.low) % s.step == 0 for n, s in SPACE.items())


def test_poor_trials_stop(monkeypatch):
    trials = run(monkeypatch, lambda p, fold: p["depth"] / 10)
    stopped = [t for t in trials if t.stopped]
    assert stopped and all(1 <= len(t.scores) < 5 for t in stopped)
    assert all(len(t.scores) == 5 for t in trials if not t.stopped)
    best = max((t for t in trials if not t.stopped), key=lambda t: t.mean)
    assert best.params["depth"] == max(t.params["depth"] for t in trials)


def test_same_seed_same_trials(monkeypatch):
    score = lambda p, fold: p["leaf"] / 20 + p["trees"] / 1000
    one, two = run(monkeypatch, score), run(monkeypatch, score)
    assert [t.params for t in one] == [t.params for t in two]


def test_auc_against_pairs():
    rng = np.random.default_rng(2)
    actual, scores = rng.integers(0, 3, 80).astype(float), rng.integers(0, 6, (80, 3)) / 5
    want = []
    for k in range(3):
        own, rest = scores[actual == k, k], scores[actual != k, k]
        want.append(np.mean([(a > b) + (a == b) / 2 for a in own for b in rest]))
    assert T.mean_auc(actual, scores) == pytest.approx(np.mean(want))
    assert np.isnan(T.mean_auc(np.zeros(5), np.ones((5, 1))))


def test_sample_keeps_the_stages_shares(tables):
    table = M.training_table(tables.staged)
    sample = T.labelled_sample(table, 300)
    whole = {r["stage"]: r["n"] for r in table.where("is_train").groupBy("stage").agg(F.count("*").alias("n")).collect()}
    n = sum(whole.values())
    got = {r["stage"]: r["n"] for r in sample.groupBy("stage").agg(F.count("*").alias("n")).collect()}
    assert got == {s: 300 * m // n for s, m in whole.items()}
    folds = sample.groupBy("stage").pivot("fold").count().collect()
    assert all(max(r[1:]) - min(r[1:]) <= 1 for r in folds)
    assert sample.where("not is_train").count() == 0


def test_small_search_with_forests(tables):
    rows = M.tune(M.training_table(tables.staged), draws=4, folds=2, max_trees=10, labelled_rows=200).collect()
    assert len(rows) == 4 and sum(r["best"] for r in rows) >= 1
    assert all(0.5 < r["auc"] <= 1.0 and r["folds"] == 2 for r in rows)


def test_forest_learns_and_obeys_its_limits():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 5))
    y = (x[:, 0] > 0.3).astype(int) + ((x[:, 1] > 0) & (x[:, 0] > 0.3)).astype(int)
    p = T.forest_scores(x[:600], y[:600], x[600:], 3, trees=40, depth=6, leaf=3, seed=1)
    assert np.allclose(p.sum(axis=1), 1.0)
    assert (p.argmax(axis=1) == y[600:]).mean() > 0.93
    stump = T.forest_scores(x[:600], y[:600], x[600:], 3, trees=1, depth=1, leaf=3, seed=1)
    assert len(np.unique(stump.round(9), axis=0)) <= 2
    root = T.forest_scores(x[:600], y[:600], x[600:], 3, trees=5, depth=6, leaf=400, seed=1)
    assert len(np.unique(root.round(9), axis=0)) == 1
    again = T.forest_scores(x[:600], y[:600], x[600:], 3, trees=40, depth=6, leaf=3, seed=1)
    assert (p == again).all()
