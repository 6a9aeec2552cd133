"""ST4: reveal timers. A label comes out once the reveal lag has passed, not before.

Scored rows and labels are one stream of records ``(id, seq, score, label,
event_ts, at)``; ``at`` is when the record came and carries the watermark. Per id
the state holds the row, its label if known, and one event-time timer:

* when the watermark reaches ``event_ts + lag``, a row with its label leaves as
  ``revealed``; one without waits on;
* a label that comes after that lets its row leave at once;
* when the watermark reaches ``event_ts + lag + patience``, a row that still has
  no label leaves as ``unlabelled`` (the side output), and its state goes.

Rows whose time hasn't come are in the state only. So the revealed rows up to
any watermark are those of the batch corpus (P10) with ``now`` at it.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from vigil.session import ship_package

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "seq long, score double, event_ms long, label int, label_seq long, timer_ms long, due boolean"
REVEALED, UNLABELLED = "revealed", "unlabelled"


class RevealTimers(StatefulProcessor):
    """One timer per waiting row; see the module."""

    def __init__(self, lag_ms: int, patience_ms: int) -> None:
        self.lag_ms, self.patience_ms = lag_ms, patience_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("row", STATE)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        seq, score, event_ms, label, label_seq, timer_ms, due = self.state.get() or (None, None, None, None, None, None, False)
        for r in rows:
            # of several records of a kind the one with the largest seq counts
            if r["event_ms"] is not None and (seq is None or r["seq"] >= seq):
                seq, score, event_ms = r["seq"], r["score"], r["event_ms"]
            if r["label"] is not None and (label_seq is None or r["seq"] >= label_seq):
                label, label_seq = r["label"], r["seq"]
        if event_ms is not None and label is not None and due:
            self._forget(timer_ms)
            yield Row(id=key[0], outcome=REVEALED, score=score, label=label, event_ms=event_ms)
            return
        want = timer_ms if due or event_ms is None else event_ms + self.lag_ms
        if want != timer_ms:
            if timer_ms is not None:
                self.handle.deleteTimer(timer_ms)
            self.handle.registerTimer(want)
        self.state.update((seq, score, event_ms, label, label_seq, want, due))

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        seq, score, event_ms, label, label_seq, timer_ms, due = self.state.get()
        if label is not None or due:
            self.state.clear()
            yield Row(id=key[0], outcome=UNLABELLED if label is None else REVEALED, score=score, label=label, event_ms=event_ms)
        else:
            last = event_ms + self.lag_ms + self.patience_ms
            if last <= timerValues.getCurrentWatermarkInMs():
                self.state.clear()
                yield Row(id=key[0], outcome=UNLABELLED, score=score, label=None, event_ms=event_ms)
            else:
                self.handle.registerTimer(last)
                self.state.update((seq, score, event_ms, label, label_seq, last, True))

    def _forget(self, timer_ms: int | None) -> None:
        if timer_ms is not None:
            self.handle.deleteTimer(timer_ms)
        self.state.clear()

    def close(self) -> None:
        pass


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Start queries whose state is in RocksDB, which timers need; the setting is put back."""
    previous = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, previous)


def reveal(records: DataFrame, *, lag_seconds: float, patience_seconds: float, lateness: str = "0 seconds") -> DataFrame:
    """Stream of ``id, outcome, score, label, event_ts`` from ``records``.

    ``records``: ``id long, seq long, score double, label int, event_ts timestamp,
    at timestamp``; a scored row has ``event_ts``, a label record ``label``.
    Repeated records of an id don't reveal it twice before its state goes. A
    label whose row never came waits in the state. Start the query inside
    ``rocksdb_state``. Records without an id are dropped.
    """
    if lag_seconds < 0 or patience_seconds < 0:
        raise ValueError("lag and patience are spans of time, 0 at least")
    ship_package(records.sparkSession)
    processor = RevealTimers(int(lag_seconds * 1000), int(patience_seconds * 1000))
    keyed = (
        records.filter("id is not null")
        .withWatermark("at", lateness)
        .select("id", F.coalesce("seq", F.lit(0)).cast("long").alias("seq"), "score", "label", F.unix_millis("event_ts").alias("event_ms"), "at")
    )
    out = keyed.groupBy("id").transformWithState(
        processor, "id long, outcome string, score double, label int, event_ms long", "append", "EventTime"
    )
    return out.select("id", "outcome", "score", "label", F.timestamp_millis("event_ms").alias("event_ts"))


__all__ = ["REVEALED", "UNLABELLED", "RevealTimers", "reveal", "rocksdb_state"]
