"""Reveal timers and replays over several micro-batches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vigil.streaming import labels, replays, reveal

RECORD = "id long, seq long, score double, label int, event_ts timestamp, at timestamp"


def when(minute):
    return None if minute is None else dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minute)


def scored(i, minute, score=0.5, seq=0, at=None):
    return (i, seq, score, None, when(minute), when(minute if at is None else at))


def label(i, at, value=1, seq=0):
    return (i, seq, None, value, None, when(at))


def run(spark, scratch, batches, build, schema):
    """Each list of rows is one file and one micro-batch."""
    source, target = f"{scratch}/in", f"{scratch}/out"
    for b in batches:
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    with reveal.rocksdb_state(spark), labels.state_partitions(spark, 2):
        out = build(stream)
        query = out.writeStream.format("parquet").option("path", target).option("checkpointLocation", f"{scratch}/ck").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(out.schema).parquet(target)


def outcomes(spark, scratch, batches, lag=60, patience=120):
    got = run(spark, scratch, batches, lambda s: reveal.reveal(s, lag_seconds=lag * 60, patience_seconds=patience * 60), RECORD)
    return sorted((r.id, r.outcome, r.label, r.score) for r in got.collect())


def test_labels_come_out_after_the_lag(spark, scratch):
    batches = [
        [scored(1, 0), label(1, 1), scored(2, 0), scored(3, 10), label(3, 11, 0), (None, 0, 0.1, None, when(0), when(0))],
        [scored(9, 60)],  # the lag of 1 and 2 has passed to the minute, that of 3 hasn't
    ]
    assert outcomes(spark, scratch, batches) == [(1, "revealed", 1, 0.5)]


def test_late_labels_and_rows_without(spark, scratch):
    batches = [
        [scored(1, 0), scored(2, 0), scored(3, 0), label(7, 1)],
        [scored(9, 90)],
        [label(2, 91, 0)],  # after the lag: leaves at once
        [scored(10, 200)],  # past the patience of 1 and 3, not of 9
        [label(9, 201)],
    ]
    assert outcomes(spark, scratch, batches) == [(1, "unlabelled", None, 0.5), (2, "revealed", 0, 0.5), (3, "unlabelled", None, 0.5), (9, "revealed", 1, 0.5)]


def test_label_before_its_row_and_repeats(spark, scratch):
    batches = [
        [label(1, 0, 0), label(1, 1, 1, seq=4), label(1, 1, 0, seq=3)],
        [scored(1, 5, 0.2, seq=1), scored(1, 5, 0.9, seq=2), scored(1, 5, 0.3, seq=1)],
        [scored(1, 5, 0.9, seq=2, at=6)],
        [scored(8, 300)],
    ]
    assert outcomes(spark, scratch, batches) == [(1, "revealed", 1, 0.9)]


def test_a_jump_past_lag_and_patience(spark, scratch):
    batches = [[scored(1, 0), scored(2, 0), label(2, 0)], [scored(9, 10_000)]]
    assert outcomes(spark, scratch, batches) == [(1, "unlabelled", None, 0.5), (2, "revealed", 1, 0.5)]


def test_spans_are_checked(spark):
    with pytest.raises(ValueError, match="spans of time"):
        reveal.reveal(spark.createDataFrame([], RECORD), lag_seconds=-1, patience_seconds=0)


def test_replays_inside_the_delay_are_dropped(spark, scratch):
    row = lambda i, v, m: (i, v, when(m))
    batches = [
        [row(1, "a", 0), row(1, "a", 0), row(2, "b", 0), row(3, None, 0), row(3, None, 0), row(None, "n", 0)],
        [row(1, "a", 20), row(2, "other", 20), row(3, None, 20), row(None, "n", 20)],
        [row(50, "z", 600)],
        [row(51, "z", 605)],  # the watermark of the batch before ends the state here
        [row(1, "a", 610)],  # long after: the state has forgotten it
    ]
    got = run(spark, scratch, batches, lambda s: replays.without_replays(s, id_col="id", time_col="at", payload=["v"], delay="1 hour"), "id long, v string, at timestamp")
    counts = sorted((r.id or 0, r.v or "", r.n) for r in got.groupBy("id", "v").agg(F.count(F.lit(1)).alias("n")).collect())
    assert counts == [(0, "n", 1), (1, "a", 2), (2, "b", 1), (2, "other", 1), (3, "", 1), (50, "z", 1), (51, "z", 1)]
