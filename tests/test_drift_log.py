"""Incremental drift: summaries of batches against the drift job over the rows."""

import random

import pytest
from pyspark.sql import functions as F

from vigil.operators import drift, drift_log

SCHEMA = "x double, y long, c string, score double"


def rows(seed, n, shift=0.0):
    rng = random.Random(seed)
    return [
        (rng.choice([None, float("nan"), 0.0, -0.0, rng.gauss(shift, 1)]), rng.randint(0, 3), rng.choice(["a", "b", None]), rng.random() ** (1 + shift))
        for _ in range(n)
    ]


def told(metrics):
    return sorted((r.feature, r.kind, r.n_ref, r.n_cur, r.statistic, r.dof, r.p_value) for r in metrics.collect())


def close(a, b):
    assert len(a) == len(b)
    for x, y in zip(a, b, strict=True):
        assert x[:4] == y[:4] and x[5] == y[5]
        assert x[4] == pytest.approx(y[4], abs=1e-12) and x[6] == pytest.approx(y[6], rel=1e-6, abs=1e-12)


@pytest.fixture()
def log(spark, scratch):
    made = drift_log.DriftLog(spark, f"{scratch}/log", ["x", "y"], ["c"])
    made.reference = spark.createDataFrame(rows(1, 900), SCHEMA)
    made.set_reference(made.reference)
    return made


def test_window_equals_the_job_over_its_rows(spark, log):
    batches = [rows(10 + i, 150, 0.1 * i) for i in range(5)]
    for i, b in enumerate(batches):
        assert log.append(spark.createDataFrame(b, SCHEMA), i, compact_every=3)
        assert not log.append(spark.createDataFrame(b, SCHEMA), i)
    for first, last in ((None, None), (2, 3), (4, None)):
        inside = sum(batches[first or 0 : None if last is None else last + 1], [])
        want = drift.compute_drift(log.reference, spark.createDataFrame(inside, SCHEMA), feature_columns=["x", "y", "c"])
        close(told(log.metrics(first, last)), told(want))


def test_few_bins_are_looked_up(spark, log):
    """Where the halves differ, the ECDFs are far apart in few bins."""
    log.append(spark.createDataFrame(rows(3, 2000, 1.0), SCHEMA), 0)
    stats, looked_up, _ = log.statistics()
    assert 0 < sum(f == 0 for f, _ in looked_up) < 60
    stats.collect()


def test_replaced_rows_are_taken_out(spark, log):
    old, new = rows(5, 80), rows(6, 80, 0.5)
    log.append(spark.createDataFrame(old, SCHEMA), 0)
    log.append(spark.createDataFrame(new, SCHEMA), 1, replaced=spark.createDataFrame(old, SCHEMA))
    want = drift.compute_drift(log.reference, spark.createDataFrame(new, SCHEMA), feature_columns=["x", "y", "c"])
    close(told(log.metrics()), told(want))


def test_empty_windows_and_one_reference(spark, log):
    with pytest.raises(ValueError, match="has a reference"):
        log.set_reference(log.reference)
    empty = {r.feature: (r.statistic, r.p_value) for r in log.metrics().collect()}
    assert empty["x"] == (0.0, 1.0) and empty["score"] == (0.0, 1.0)
    log.append(spark.createDataFrame([], SCHEMA), 0)
    log.append(spark.createDataFrame([(1.0, None, "new", 0.5)], SCHEMA), 1)
    got = {r.feature: r for r in log.metrics().collect()}
    assert got["y"].n_cur == 0 and got["x"].n_cur == 1 and got["x"].statistic == 0.0
    assert got["c"].p_value == 0.0  # a category the reference hasn't


def test_a_crash_between_the_summaries(spark, log):
    """The fine summary was committed, the coarse one not: the batch comes again and counts once."""
    b = spark.createDataFrame(rows(7, 60), SCHEMA)
    real, log.coarse.commit = log.coarse.commit, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    with pytest.raises(RuntimeError, match="lost"):
        log.append(b, 0)
    log.coarse.commit = real
    assert log.append(b, 0)
    close(told(log.metrics()), told(drift.compute_drift(log.reference, b, feature_columns=["x", "y", "c"])))


def test_bins_are_counts_of_edges_below(spark):
    edges = sorted({random.Random(2).randint(0, 900) / 2 for _ in range(255)})
    values = [-1.0, 0.0, 1e9, float("inf"), *edges[:20], *[e + 0.25 for e in edges]]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", drift_log.bin_of(F.lit(edges), F.col("v")).alias("b"))
    assert all(r.b == sum(e < r.v for e in edges) for r in got.collect())
    assert spark.range(1).select(drift_log.bin_of(F.array().cast("array<double>"), F.lit(1.0))).first()[0] == 0
