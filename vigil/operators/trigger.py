"""Retrain trigger and accumulated volume since the last retrain.

The retrain state is a small append-only table (one row per completed
retrain: ``store_row_count``, ``at``, ``challenger_version``) kept next to the
store; the newest row is the checkpoint. Volume counts store *rows* since the
checkpoint, duplicates included.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import path_exists

DEFAULT_VOLUME_THRESHOLD = 5_000

STATE_SCHEMA = T.StructType(
    [
        T.StructField("store_row_count", T.LongType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("challenger_version", T.LongType()),
    ]
)


def read_state(spark: SparkSession, state_path: str) -> DataFrame:
    if not path_exists(spark, state_path):
        return spark.createDataFrame([], STATE_SCHEMA)
    return spark.read.schema(STATE_SCHEMA).parquet(state_path)


def write_state(
    spark: SparkSession, state_path: str, *, store_row_count: int, challenger_version: int | None = None
) -> None:
    """Append a checkpoint row (written last, so a failed pass is retried)."""
    row = [(int(store_row_count), datetime.now(timezone.utc).replace(tzinfo=None), challenger_version)]
    spark.createDataFrame(row, STATE_SCHEMA).coalesce(1).write.mode("append").parquet(state_path)


def last_store_row_count(state: DataFrame) -> int:
    """Row count at the newest checkpoint (0 without a state)."""
    row = state.agg(F.max_by("store_row_count", "at").alias("c")).collect()[0]
    return int(row["c"] or 0)


def accumulated_volume(store: DataFrame, state: DataFrame) -> int:
    """``max(count(store) - last_count, 0)``."""
    return max(store.count() - last_store_row_count(state), 0)


def trigger_columns(
    volume: Column, *, volume_threshold: int = DEFAULT_VOLUME_THRESHOLD, drift_alarm: Column | bool = False
) -> list[Column]:
    """A17 as expressions: ``volume >= threshold OR drift_alarm``."""
    if volume_threshold <= 0:
        raise ValueError(f"volume_threshold has to be above 0, got {volume_threshold}")
    alarm = drift_alarm if isinstance(drift_alarm, Column) else F.lit(bool(drift_alarm))
    vol_hit = volume >= F.lit(int(volume_threshold))
    return [
        volume.cast("long").alias("volume_since_last"),
        F.lit(int(volume_threshold)).cast("long").alias("volume_threshold"),
        vol_hit.alias("volume_triggered"),
        alarm.alias("drift_triggered"),
        (vol_hit | alarm).alias("retrain"),
    ]


def retrain_decision(
    spark: SparkSession, volume: int, *, volume_threshold: int = DEFAULT_VOLUME_THRESHOLD, drift_alarm: bool = False
) -> Row:
    """The trigger expressions evaluated for one volume, as a row of their names."""
    if volume < 0:
        raise ValueError(f"a volume can't be below 0, got {volume}")
    columns = trigger_columns(F.lit(int(volume)), volume_threshold=volume_threshold, drift_alarm=drift_alarm)
    return spark.range(1).select(*columns).first()
