"""ST3: exact replays dropped in the stream, with bounded state.

A record that comes again with the same id and payload within the delay is a
replay and is dropped; the state forgets a record once the watermark has passed
its time by the delay. A replay that comes later, or one with another payload,
goes through: the store keeps both, and the newest wins at read (W2).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def payload_digest(df: DataFrame, columns: Sequence[str]):
    """SHA-256 of the columns as JSON; NULL and an absent value are the same."""
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256)


def without_replays(records: DataFrame, *, id_col: str, time_col: str, payload: Sequence[str], delay: str) -> DataFrame:
    """``records`` without those whose id and payload came before within ``delay``.

    The state holds an id and a digest per record, for ``delay``.
    """
    marked = records.withColumn("_digest", payload_digest(records, payload)).withWatermark(time_col, delay)
    return marked.dropDuplicatesWithinWatermark([id_col, "_digest"]).drop("_digest")


__all__ = ["payload_digest", "without_replays"]
