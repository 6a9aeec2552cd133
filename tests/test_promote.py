"""A15/A16 DeLong gate (FIXTURES F9) and a brute-force variance check."""

import numpy as np
import pandas as pd
import pytest

from vigil.operators import promote


def frame(spark, y, a, b):
    return spark.createDataFrame(
        pd.DataFrame({"isFraud": np.asarray(y, int), "champion": np.asarray(a, float), "challenger": np.asarray(b, float)})
    )


def brute_delong(y, a, b):
    y = np.asarray(y)
    out = []
    for s in (np.asarray(a, float), np.asarray(b, float)):
        p, n = s[y == 1], s[y == 0]
        k = (p[:, None] > n[None, :]) + 0.5 * (p[:, None] == n[None, :])
        out.append((k.mean(), k.mean(axis=1), k.mean(axis=0)))
    (aa, ppa, pna), (ab, ppb, pnb) = out
    n1, m = len(ppa), len(pna)
    var = np.var(ppb - ppa, ddof=1) / n1 + np.var(pnb - pna, ddof=1) / m
    return aa, ab, np.sqrt(max(var, 0))


def test_matches_brute_force(spark):
    rng = np.random.default_rng(9)
    n = 400
    y = rng.integers(0, 2, n)
    a = np.round(rng.uniform(0, 1, n) + 0.2 * y, 2)
    b = np.round(rng.uniform(0, 1, n) + 0.5 * y, 2)
    row = promote.delong_frame(frame(spark, y, a, b)).first()
    aa, ab, se = brute_delong(y, a, b)
    assert row["auc_champion"] == pytest.approx(aa, abs=1e-12)
    assert row["auc_challenger"] == pytest.approx(ab, abs=1e-12)
    assert row["se"] == pytest.approx(se, rel=1e-9)


def test_significant_improvement_promotes(spark):
    rng = np.random.default_rng(0)
    y = np.array([0, 1] * 100)
    champ = rng.uniform(0, 1, 200)
    chall = np.where(y == 1, 0.9, 0.1)
    d = promote.decide_promotion(frame(spark, y, champ, chall))
    assert d.promote and d.p_value < 0.05 and d.auc_challenger > d.auc_champion
    assert not promote.decide_promotion(frame(spark, y, champ, chall), alpha=1e-200).promote


def test_insignificant_difference_does_not_promote(spark):
    rng = np.random.default_rng(1)
    y = np.array([0, 1] * 150)
    base = np.where(y == 1, 1.0, 0.0) + rng.normal(0, 1.0, 300)
    d = promote.decide_promotion(frame(spark, y, base + rng.normal(0, 0.01, 300), base + rng.normal(0, 0.01, 300)))
    assert not d.promote and d.p_value > 0.05


def test_worse_and_identical(spark):
    y = np.array([0, 1] * 100)
    champ = np.where(y == 1, 0.9, 0.1)
    worse = np.where(y == 1, 0.2, 0.8)
    d = promote.decide_promotion(frame(spark, y, champ, worse))
    assert not d.promote and d.p_value > 0.5
    s = np.random.default_rng(3).uniform(0, 1, 200)
    d = promote.decide_promotion(frame(spark, y, s, s))
    assert not d.promote and d.p_value == 1.0 and d.auc_champion == d.auc_challenger


def test_guards(spark):
    with pytest.raises(ValueError, match="alpha"):
        promote.delong_frame(frame(spark, [0, 1], [0.1, 0.2], [0.1, 0.2]), alpha=1.0)
    with pytest.raises(Exception, match="positive"):
        promote.decide_promotion(frame(spark, [0] * 10, np.arange(10), np.arange(10)))
    with pytest.raises(Exception, match="fewer than two"):
        promote.decide_promotion(frame(spark, [0, 0, 1], [0.1, 0.2, 0.3], [0.1, 0.2, 0.3]))
