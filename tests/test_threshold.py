"""A5-A7 threshold / cost (FIXTURES F2) and A4 AUC against brute force."""

import itertools

import numpy as np
import pandas as pd
import pytest

from vigil.operators import evaluate


def frame(spark, y, s):
    return spark.createDataFrame(pd.DataFrame({"isFraud": list(y), "score": [float(v) for v in s]}))


@pytest.mark.parametrize(
    "y,s,ratio,expected",
    [
        ([1, 1, 0, 0], [0.9, 0.9, 0.1, 0.1], 10, 0.9),
        ([1, 0], [0.07, 0.08], 10, 0.07),
        ([1, 1, 0], [0.9, 0.2, 0.5], 10, 0.2),
        ([1, 1, 0], [0.9, 0.2, 0.5], 0.5, 0.9),
        ([1, 1, 0, 0], [0.5, 0.5, 0.05, 0.05], 10, 0.5),
        ([1, 1, 0, 0], [0.9, 0.2, 0.8, 0.1], 10, 0.2),
        ([0] * 5, [0.9, 0.8, 0.7, 0.6, 0.5], 10, 0.9),
        ([1] * 5, [0.1, 0.2, 0.3, 0.4, 0.5], 10, 0.1),
    ],
)
def test_operating_threshold_known_answers(spark, y, s, ratio, expected):
    assert evaluate.operating_threshold(frame(spark, y, s), cost_ratio=ratio) == pytest.approx(expected)


def test_threshold_guards(spark):
    with pytest.raises(ValueError, match="cost_ratio"):
        evaluate.operating_threshold(frame(spark, [1], [0.5]), cost_ratio=0)
    empty = frame(spark, [1], [0.5]).limit(0)
    with pytest.raises(ValueError, match="no scores"):
        evaluate.operating_threshold(empty)


def test_expected_cost_matches_definition(spark):
    y, s = [1, 1, 0, 0, 1], [0.9, 0.2, 0.8, 0.1, 0.5]
    cost = evaluate.expected_cost(frame(spark, y, s), 0.5, cost_ratio=10)
    missed = sum(1 for a, b in zip(y, s) if a == 1 and b < 0.5)
    blocked = sum(1 for a, b in zip(y, s) if a == 0 and b >= 0.5)
    assert cost == missed * 10 + blocked


def test_cost_curve_is_brute_force(spark):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.uniform(0, 1, 300), 2)  # ties
    curve = {r["threshold"]: r["cost"] for r in evaluate.cost_curve(frame(spark, y, s), cost_ratio=10).collect()}
    for t in np.unique(s):
        exp = 10 * ((y == 1) & (s < t)).sum() + ((y != 1) & (s >= t)).sum()
        assert curve[float(t)] == exp


def test_auc_equals_pairwise_definition(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.uniform(0, 1, 400) + 0.3 * y, 1)  # heavy ties
    pos, neg = s[y == 1], s[y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert evaluate.auc(frame(spark, y, s)) == pytest.approx(brute, abs=1e-12)


def test_auc_by_group(spark):
    pdf = pd.DataFrame({"g": ["a"] * 4 + ["b"] * 4, "isFraud": [1, 0, 1, 0] * 2, "score": [0.9, 0.1, 0.8, 0.2, 0.1, 0.9, 0.2, 0.8]})
    got = {r["g"]: r["auc"] for r in evaluate.auc_frame(spark.createDataFrame(pdf), by=["g"]).collect()}
    assert got == {"a": 1.0, "b": 0.0}
