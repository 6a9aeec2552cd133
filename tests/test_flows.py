"""M12 monitoring pass and M13 retraining pass end to end."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from vigil.operators import contract, store, trigger
from vigil.plans import monitoring, training

FEATS = ("TransactionDT", "amount", "cat_a", "cat_b")
CATS = ("cat_a", "cat_b")


def flow_frame(spark, n=300, seed=0):
    rng = np.random.default_rng(seed)
    amount = rng.uniform(0, 1000, n)
    pdf = pd.DataFrame(
        {
            "TransactionID": np.arange(n),
            "TransactionDT": np.arange(n) * 100,
            "isFraud": (((amount > 200) & (amount < 800)) ^ (rng.uniform(0, 1, n) < 0.15)).astype(int),
            "amount": amount,
            "cat_a": rng.choice(["W", "H", "C"], n),
            "cat_b": rng.choice(["a", "b"], n),
        }
    )
    return spark.createDataFrame(pdf)


def stub_boundary():
    c = contract.Contract(FEATS, CATS, 0.5)
    return contract.ScoringBoundary(lambda df: F.col("amount") / 1000.0, c, require_complete=False)


def test_monitoring_pass_accumulates_chunks(spark, scratch):
    tx = flow_frame(spark)
    path = f"{scratch}/store"
    out = monitoring.monitoring_pass(tx, stub_boundary(), path, chunk_rows=20)
    assert out.n_scored == 20 and out.n_current == 20
    ids = sorted(r[0] for r in store.read_store(spark, path).select("TransactionID").collect())
    assert ids == list(range(255, 275))
    out2 = monitoring.monitoring_pass(tx, stub_boundary(), path, chunk_rows=20)
    assert out2.n_scored == 20 and out2.n_current == 40
    # time is a feature and the window is newer than the train slice: drift by construction
    assert out2.decision["alarm"] is True
    names = {r["feature"] for r in out2.metrics.collect()}
    assert names == set(FEATS) | {"score"}


def test_monitoring_pass_empty_window_reports_no_drift(spark, scratch):
    tx = flow_frame(spark)
    out = monitoring.monitoring_pass(tx, stub_boundary(), f"{scratch}/store", chunk_rows=20, window_days=0.0, now=10**9)
    assert out.n_current == 0 and out.decision["alarm"] is False


def test_retraining_pass(spark, scratch):
    tx = flow_frame(spark, 600)
    seed = training.seed_champion(tx, FEATS, CATS, params={"maxIter": 5, "maxDepth": 2})
    path, state = f"{scratch}/store", f"{scratch}/state"
    stream_ids = [r[0] for r in tx.orderBy("TransactionDT").select("TransactionID").collect()][510:540]
    scored = spark.createDataFrame([(i, 0.1, "allow") for i in stream_ids], "TransactionID long, score double, decision string")
    store.append_scores(scored, path)
    out = training.retraining_pass(
        tx, seed.model, seed.contract, path, state, volume_threshold=10, reveal_lag=0, params={"maxIter": 5, "maxDepth": 2},
        served_path=f"{scratch}/served",
    )
    assert out.trigger.retrain and out.corpus_size == 420 + 30 and out.shared_test_size == 90
    assert out.decision is not None and 0 <= out.decision.p_value <= 1
    assert trigger.last_store_row_count(trigger.read_state(spark, state)) == 30
    again = training.retraining_pass(tx, seed.model, seed.contract, path, state, volume_threshold=10)
    assert not again.trigger.retrain and again.decision is None
