"""ST1/ST2 streaming scoring into the store, idempotent replay, ST4 label join."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from vigil.operators import contract, store
from vigil.streaming import labels, scoring

CONTRACT = contract.Contract(("amount", "cat_a"), ("cat_a",), 0.5)


def boundary():
    return contract.ScoringBoundary(lambda df: F.col("amount") / 100.0, CONTRACT, require_complete=True)


def stream_rows(spark, n=40):
    pdf = pd.DataFrame(
        {
            "TransactionID": range(n),
            "TransactionDT": [i * 10 for i in range(n)],
            "amount": [None if i == 7 else float(i) for i in range(n)],
            "cat_a": ["W"] * n,
        }
    )
    return spark.createDataFrame(pdf, "TransactionID long, TransactionDT long, amount double, cat_a string")


def test_stream_scores_every_file_once(spark, scratch):
    rows = stream_rows(spark)
    rows.repartitionByRange(4, "TransactionDT").write.parquet(f"{scratch}/src")
    q = dict(store_path=f"{scratch}/store", quarantine_path=f"{scratch}/quarantine")
    scoring.run_scoring_stream(spark, f"{scratch}/src", rows.schema, boundary(), q["store_path"], f"{scratch}/ckpt", **q_opts(q))
    st = store.read_store(spark, q["store_path"])
    assert st.count() == 39  # row 7 is quarantined (null amount)
    assert st.select("batch_id").distinct().count() == 4  # one file per micro-batch
    rej = spark.read.parquet(q["quarantine_path"]).collect()
    assert [r["reasons"] for r in rej] == ["null: amount"]
    # a restart with the same checkpoint finds nothing new
    scoring.run_scoring_stream(spark, f"{scratch}/src", rows.schema, boundary(), q["store_path"], f"{scratch}/ckpt", **q_opts(q))
    assert store.read_store(spark, q["store_path"]).count() == 39


def q_opts(q):
    return {"quarantine_path": q["quarantine_path"]}


def test_replayed_batch_is_skipped(spark, scratch):
    sink = scoring.scoring_batch_sink(boundary(), f"{scratch}/store", writer="one")
    batch = stream_rows(spark, 5)
    sink(batch, 0)
    sink(batch, 0)  # the same micro-batch again (restart before commit)
    assert store.read_store(spark, f"{scratch}/store").count() == 5  # not 10


def test_volume_trigger_in_sink(spark, scratch):
    sink = scoring.scoring_batch_sink(
        boundary(), f"{scratch}/store", state_path=f"{scratch}/state", volume_threshold=3, triggers_path=f"{scratch}/trig", writer="one"
    )
    sink(stream_rows(spark, 5), 0)
    assert spark.read.parquet(f"{scratch}/trig").first()["volume"] == 5


def test_label_join_within_lag(spark, scratch):
    # two file streams: scored events and late label events
    ev = spark.createDataFrame([(1, 1000, 0.2), (2, 1000, 0.7)], "TransactionID long, t long, score double")
    lab = spark.createDataFrame([(1, 1500, 1), (2, 9000, 0)], "TransactionID long, lt long, isFraud int")
    labels.with_event_time(ev, "t", "event_ts").write.parquet(f"{scratch}/ev")
    labels.with_event_time(lab, "lt", "label_ts").write.parquet(f"{scratch}/lab")
    evs = spark.readStream.schema(spark.read.parquet(f"{scratch}/ev").schema).parquet(f"{scratch}/ev")
    labs = spark.readStream.schema(spark.read.parquet(f"{scratch}/lab").schema).parquet(f"{scratch}/lab")
    joined = labels.revealed_labels(evs, labs, lag_seconds=3600)
    q = joined.writeStream.format("parquet").option("path", f"{scratch}/out").option(
        "checkpointLocation", f"{scratch}/ck"
    ).trigger(availableNow=True).start()
    q.awaitTermination()
    got = [(r["TransactionID"], r["isFraud"]) for r in spark.read.parquet(f"{scratch}/out").collect()]
    assert got == [(1, 1)]  # label 2 arrived after the lag


def test_streams_and_batch_appends_share_a_store(spark, scratch):
    """A batch append, a stream, another query's stream and a replay: no row is lost or doubled."""
    path = f"{scratch}/store"
    batch = spark.createDataFrame([(1000, 0.5, "block")], "TransactionID long, score double, decision string")
    assert store.append_scores(batch, path) == 1
    rows = stream_rows(spark, 6)
    for part in (0, 1):
        rows.filter(F.col("TransactionID") % 2 == part).coalesce(1).write.parquet(f"{scratch}/src{part}")
        scoring.run_scoring_stream(spark, f"{scratch}/src{part}", rows.schema, boundary(), path, f"{scratch}/ckpt{part}")
    assert store.append_scores(batch, path) == 1
    sink = scoring.scoring_batch_sink(boundary(), path, writer="direct")
    for _ in range(2):
        sink(rows, 0)
    ids = [r.TransactionID for r in store.read_store(spark, path).collect()]
    assert sorted(ids) == sorted([1000, 1000, *range(6), *range(6)])
    assert {r.TransactionID: r.n for r in store.read_store(spark, path).groupBy("TransactionID").agg(F.count_distinct("batch_id").alias("n")).collect()}[1] == 2


def test_an_uncommitted_batch_is_replaced(spark, scratch):
    path = f"{scratch}/store"
    store.stage_scores(boundary().score(stream_rows(spark, 2), keep=["TransactionID", "TransactionDT"], validate_rows=False), path)
    scoring.scoring_batch_sink(boundary(), path, writer="one")(stream_rows(spark, 5), 3)
    assert store.read_store(spark, path).count() == 5


def test_sinks_outside_queries_need_names(spark, scratch):
    path = f"{scratch}/store"
    with pytest.raises(ValueError, match="writer name"):
        scoring.scoring_batch_sink(boundary(), path)(stream_rows(spark, 2), 0)
    for name in ("a", "b"):
        scoring.scoring_batch_sink(boundary(), path, writer=name)(stream_rows(spark, 2), 0)
    assert store.read_store(spark, path).count() == 4


def test_trigger_comes_after_a_crash_between_commit_and_check(spark, scratch):
    path = f"{scratch}/store"
    scoring.scoring_batch_sink(boundary(), path, writer="one")(stream_rows(spark, 5), 0)
    checked = scoring.scoring_batch_sink(
        boundary(), path, state_path=f"{scratch}/state", volume_threshold=3, triggers_path=f"{scratch}/trig", writer="one"
    )
    checked(stream_rows(spark, 5), 0)
    assert spark.read.parquet(f"{scratch}/trig").first()["volume"] == 5
    assert store.row_count(spark, path) == 5
