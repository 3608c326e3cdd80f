"""The ordinal model against its likelihood, written out row by row."""

import math

import numpy as np

from tidemark.llm import ordinal


def likelihood(rows, grades, weights, thresholds, l2):
    """Mean log-likelihood less the ridge, one row and one grade at a time."""
    total = 0.0
    for row, grade in zip(rows, grades):
        score = sum(weights[f] for f in row)
        above = [1.0, *[1 / (1 + math.exp(t - score)) for t in thresholds], 0.0]
        total += math.log(above[grade] - above[grade + 1])
    return total / len(rows) - l2 / 20 * sum(w * w for w in weights.values())


def sample(seed, n=240, kinds=12):
    rng = np.random.default_rng(seed)
    rows = [np.sort(rng.choice(kinds, int(rng.integers(1, 6)), replace=False)) for _ in range(n)]
    drift = rng.normal(0, 1, kinds)
    score = np.array([drift[r].sum() for r in rows]) + rng.logistic(0, 1, n)
    return rows, np.digitize(score, [-0.7, 0.6])


def test_no_parameter_of_the_fit_can_be_bettered():
    l2 = 0.05
    for seed in (3, 4):
        rows, grades = sample(seed)
        model = ordinal.fit(rows, grades, 3, rounds=4000, l2=l2, rate=0.01)
        weights = {f: float(model.weights[f]) for f in range(12)}
        thresholds = model.thresholds.tolist()
        assert thresholds == sorted(thresholds)
        step = 1e-4
        for f in weights:
            high, low = (likelihood(rows, grades, {**weights, f: weights[f] + d}, thresholds, l2) for d in (step, -step))
            assert abs(high - low) / (2 * step) < 2e-3
        for j in range(2):
            moved = [[t + (d if i == j else 0) for i, t in enumerate(thresholds)] for d in (step, -step)]
            high, low = (likelihood(rows, grades, weights, t, l2) for t in moved)
            assert abs(high - low) / (2 * step) < 2e-3


def test_tails_are_those_of_the_written_out_model():
    rows, grades = sample(5)
    model = ordinal.fit(rows, grades, 3)
    scores = np.array([sum(float(model.weights[f]) for f in r) for r in rows])
    want = [[1 / (1 + math.exp(t - s)) for t in model.thresholds] for s in scores]
    assert np.allclose(model.tails(scores), want)
    assert (np.diff(model.tails(scores), axis=1) <= 0).all()


def test_rare_features_and_no_rows():
    rows, grades = sample(6)
    rows[0] = np.append(rows[0], 999)
    assert ordinal.fit(rows, grades, 3).weights[999] == 0 or ordinal.MIN_DOCS <= 1
    empty = ordinal.fit([], np.zeros(0, np.int64), 4)
    assert not empty.weights.any() and len(empty.thresholds) == 3
