"""M2 / 2.12: scoring with models that Spark ML doesn't know, in Arrow batches.

A model is an artifact: bytes, known by their SHA-256, with a function that
loads them and one that predicts a batch. The bytes are broadcast once, up to a
stated size; each Python worker loads a given artifact once, whatever the
number of its batches, and holds a few at most, so a new version replaces an
old one without a restart.
"""

from __future__ import annotations

import hashlib
from collections import OrderedDict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import ship_package

#: Largest artifact that is broadcast; models held by a worker; rows predicted at a time.
ARTIFACT_BYTES, HELD, BATCH_ROWS = 512 << 20, 2, 8192

_held: OrderedDict[str, Any] = OrderedDict()


def _model(digest: str, payload, load: Callable[[bytes], Any]) -> Any:
    """The worker's model of this digest, loaded at its first batch."""
    if digest not in _held:
        _held[digest] = load(payload.value)
        while len(_held) > HELD:
            _held.popitem(last=False)
    _held.move_to_end(digest)
    return _held[digest]


@dataclass(frozen=True)
class ForeignScorer:
    """A scorer for ``ScoringBoundary``: the frame plus ``score``.

    ``predict(model, batch)`` gets the feature columns of a batch and gives one
    number per row. ``features`` are passed as they are, nulls included.
    """

    artifact: bytes = field(repr=False)
    load: Callable[[bytes], Any]
    predict: Callable[[Any, pa.RecordBatch], Sequence[float]]
    features: tuple[str, ...]
    batch_rows: int = BATCH_ROWS

    @property
    def digest(self) -> str:
        return hashlib.sha256(self.artifact).hexdigest()

    def __call__(self, df: DataFrame) -> DataFrame:
        if len(self.artifact) > ARTIFACT_BYTES:
            raise ValueError(f"an artifact of {len(self.artifact)} bytes is too large to broadcast ({ARTIFACT_BYTES})")
        spark = df.sparkSession
        ship_package(spark)
        payload = spark.sparkContext.broadcast(self.artifact)
        digest, load, predict, rows, features = self.digest, self.load, self.predict, self.batch_rows, list(self.features)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    part = batch.slice(at, rows)
                    found = predict(_model(digest, payload, load), part.select([f"f{i}" for i in range(len(features))]).rename_columns(features))
                    scores = pa.array(found, pa.float64())
                    if len(scores) != part.num_rows:
                        raise ValueError(f"the model gave {len(scores)} scores for {part.num_rows} rows")
                    yield pa.RecordBatch.from_arrays([part.column(0), scores], names=["_row", "score"])

        whole = F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row")
        source = df.select(whole, *[F.col(f"`{c}`").alias(f"f{i}") for i, c in enumerate(features)])
        scored = source.mapInArrow(run, T.StructType([source.schema["_row"], T.StructField("score", T.DoubleType())]))
        return scored.select(*[F.col("_row").getField(c).alias(c) for c in df.columns], "score")


__all__ = ["ARTIFACT_BYTES", "ForeignScorer"]
