"""Property checks: AUC and the operating threshold against brute force."""

import itertools

import numpy as np
import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st

from vigil.operators import evaluate

rows = st.lists(
    st.tuples(st.integers(0, 1), st.sampled_from([0.0, 0.1, 0.2, 0.25, 0.5, 0.75, 0.9, 1.0])),
    min_size=2,
    max_size=30,
)


def brute_threshold(y, s, ratio):
    best = None
    for t in sorted(set(s)):
        cost = ratio * sum(1 for a, b in zip(y, s) if a == 1 and b < t) + sum(1 for a, b in zip(y, s) if a != 1 and b >= t)
        if best is None or cost < best[0]:
            best = (cost, t)
    return best[1]


@settings(max_examples=12, deadline=None)
@given(rows, st.sampled_from([0.5, 1.0, 10.0]))
def test_threshold_matches_brute_force(spark, data, ratio):
    y, s = zip(*data)
    df = spark.createDataFrame(pd.DataFrame({"isFraud": y, "score": s}))
    assert evaluate.operating_threshold(df, cost_ratio=ratio) == brute_threshold(y, s, ratio)


@settings(max_examples=12, deadline=None)
@given(rows)
def test_auc_matches_brute_force(spark, data):
    y, s = map(np.array, zip(*data))
    df = spark.createDataFrame(pd.DataFrame({"isFraud": y, "score": s}))
    pos, neg = s[y == 1], s[y == 0]
    if len(pos) == 0 or len(neg) == 0:
        assert evaluate.auc_frame(df).first()["auc"] is None
        return
    brute = sum((p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert abs(evaluate.auc(df) - brute) < 1e-12


@settings(max_examples=10, deadline=None)
@given(
    st.lists(st.sampled_from([0.0, 1.0, 2.0, 2.5, 3.0, 7.0]), min_size=2, max_size=25),
    st.lists(st.sampled_from([0.0, 1.5, 2.0, 3.0, 9.0]), min_size=2, max_size=25),
)
def test_ks_statistic_matches_ecdf(spark, a, b):
    from vigil.operators import drift

    ref = spark.createDataFrame(pd.DataFrame({"x": a}))
    cur = spark.createDataFrame(pd.DataFrame({"x": b}))
    grid = np.array(sorted(set(a) | set(b)))
    fa = np.searchsorted(np.sort(a), grid, "right") / len(a)
    fb = np.searchsorted(np.sort(b), grid, "right") / len(b)
    assert drift.ks_metrics(ref, cur, ["x"]).first()["statistic"] == float(np.max(np.abs(fa - fb)))


@settings(max_examples=8, deadline=None)
@given(st.integers(3, 60), st.sampled_from([(0.7, 0.15), (0.5, 0.3), (0.33, 0.33), (0.6, 0.25)]))
def test_split_sizes_follow_round_half_even(spark, n, fracs):
    from vigil.operators import split

    f1, f2 = fracs
    df = spark.createDataFrame(pd.DataFrame({"TransactionID": range(n), "TransactionDT": [i // 2 for i in range(n)]}))
    sizes = tuple(p.count() for p in split.temporal_split(df, train_frac=f1, test_frac=f2))
    i1, i2 = round(n * f1), round(n * (f1 + f2))
    assert sizes == (i1, i2 - i1, n - i2)
