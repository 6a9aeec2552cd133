"""ST4: late labels — a label is usable once the reveal lag has passed.

Batch form: :func:`vigil.operators.corpus.build_retraining_corpus`. Streaming
form: scored events and label events are two streams; a label joins its
scored event when it arrives no later than ``lag`` after the event
(``label_ts BETWEEN event_ts AND event_ts + lag``). Watermarks on both sides
bound the join state: an event waits at most ``lag`` plus the allowed
lateness for its label, then its state is dropped.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


@contextmanager
def state_partitions(spark: SparkSession, n: int) -> Iterator[None]:
    """Start stateful queries with ``n`` state partitions.

    A streaming query fixes its state partition count at first start (it is
    stored in the checkpoint), from ``spark.sql.shuffle.partitions``; size it
    to the expected state, then restore the session value.
    """
    key = "spark.sql.shuffle.partitions"
    previous = spark.conf.get(key)
    spark.conf.set(key, str(int(n)))
    try:
        yield
    finally:
        spark.conf.set(key, previous)


def with_event_time(df: DataFrame, seconds_col: str, out_col: str) -> DataFrame:
    """A timestamp column from an epoch-seconds column (for watermarks)."""
    return df.withColumn(out_col, F.timestamp_seconds(F.col(seconds_col)))


def revealed_labels(
    scored: DataFrame,
    labels: DataFrame,
    *,
    lag_seconds: int,
    lateness: str = "1 hour",
    id_col: str = "TransactionID",
    event_ts: str = "event_ts",
    label_ts: str = "label_ts",
    label_col: str = "isFraud",
) -> DataFrame:
    """Stream-stream inner join of scores and their labels within the lag."""
    s = scored.withWatermark(event_ts, lateness).alias("s")
    lab = labels.withWatermark(label_ts, lateness).alias("l")
    cond = (
        (F.col(f"s.{id_col}") == F.col(f"l.{id_col}"))
        & (F.col(f"l.{label_ts}") >= F.col(f"s.{event_ts}"))
        & (F.col(f"l.{label_ts}") <= F.col(f"s.{event_ts}") + F.expr(f"INTERVAL {int(lag_seconds)} SECONDS"))
    )
    return s.join(lab, cond, "inner").select(
        F.col(f"s.{id_col}").alias(id_col),
        F.col(f"s.{event_ts}").alias(event_ts),
        F.col("s.score").alias("score"),
        F.col(f"l.{label_col}").alias(label_col),
        F.col(f"l.{label_ts}").alias(label_ts),
    )
