"""P10/U1/A2 corpus (F8), M5 inputs, A17/A18 trigger and retrain state."""

from datetime import timedelta

import pandas as pd
import pytest

from vigil.operators import corpus, trigger


def frames(spark):
    cols = ["TransactionID", "TransactionDT", "amount", "isFraud"]
    history = spark.createDataFrame(pd.DataFrame([[100, 1000, 1.0, 0], [101, 2000, 2.0, 1], [102, 3000, 3.0, 0]], columns=cols))
    stream = spark.createDataFrame(
        pd.DataFrame([[200, 10000, 4.0, 0], [201, 10100, 5.0, 0], [202, 10200, 6.0, 1], [203, 10300, 7.0, 0]], columns=cols)
    )
    return history, stream


def ids(df):
    return sorted(r[0] for r in df.select("TransactionID").collect())


def test_reveal_lag(spark):
    h, s = frames(spark)
    assert ids(corpus.build_retraining_corpus(h, s, reveal_lag=200, now=10300)) == [100, 101, 102, 200, 201]
    # inclusive cut-off, default now = newest row
    assert ids(corpus.build_retraining_corpus(h, s, reveal_lag=timedelta(seconds=100))) == [100, 101, 102, 200, 201, 202]
    assert ids(corpus.build_retraining_corpus(h, s, reveal_lag=0)) == [100, 101, 102, 200, 201, 202, 203]
    assert ids(corpus.build_retraining_corpus(h, s.limit(0), reveal_lag=0)) == [100, 101, 102]


def test_corpus_guards(spark):
    h, s = frames(spark)
    with pytest.raises(ValueError, match="below 0"):
        corpus.build_retraining_corpus(h, s, reveal_lag=-1)
    with pytest.raises(ValueError, match="history"):
        corpus.build_retraining_corpus(h.drop("isFraud"), s)


def test_prepare_retraining_inputs(spark):
    rows = [(i, i * 100, float(i), i % 2) for i in range(300)]
    t = spark.createDataFrame(rows, "TransactionID long, TransactionDT long, amount double, isFraud int")
    st = spark.createDataFrame([(i, 0.1, "allow", 0, 0) for i in range(255, 285)], "TransactionID long, score double, decision string, seq long, batch_id long")
    c, test, stream = corpus.prepare_retraining_inputs(t, st, reveal_lag=0)
    assert (c.count(), test.count(), stream.count()) == (240, 45, 45)
    c2, _, _ = corpus.prepare_retraining_inputs(t, st, reveal_lag=5000)
    assert c2.count() == 210 + len([i for i in range(255, 285) if i * 100 <= 28400 - 5000])


def test_trigger_rule(spark):
    t = trigger.retrain_decision(spark, 5000)
    assert t.retrain and t.volume_triggered
    assert not trigger.retrain_decision(spark, 4999).retrain
    assert trigger.retrain_decision(spark, 0, drift_alarm=True).retrain
    with pytest.raises(ValueError, match="below 0"):
        trigger.retrain_decision(spark, -1)
    with pytest.raises(ValueError, match="above 0"):
        trigger.retrain_decision(spark, 1, volume_threshold=0)


def test_volume_since_checkpoint(spark, scratch):
    state_path = f"{scratch}/state"
    st = spark.createDataFrame([(i, 0.1, "allow", 0, 0) for i in range(5)], "TransactionID long, score double, decision string, seq long, batch_id long")
    assert trigger.accumulated_volume(st, trigger.read_state(spark, state_path)) == 5
    trigger.write_state(spark, state_path, store_row_count=3)
    assert trigger.accumulated_volume(st, trigger.read_state(spark, state_path)) == 2
    trigger.write_state(spark, state_path, store_row_count=9)
    assert trigger.accumulated_volume(st, trigger.read_state(spark, state_path)) == 0
