"""The CSV score job: raw CSV -> contract -> scored CSV and score store."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import contract, store
from vigil.session import written
from vigil.sources import io


@dataclass(frozen=True)
class JobCounts:
    scored: int
    rejected: int


def score_csv(
    spark: SparkSession,
    source: str,
    target: str,
    boundary: contract.ScoringBoundary,
    store_path: str,
    *,
    id_col: str = store.ID,
    rejects: str | None = None,
) -> JobCounts:
    """Score the CSV at ``source`` into ``target`` and append the scores to the store.

    The header has to hold the id and the contract's columns, in any order.
    Rows that break the contract, or whose id is missing or no whole number, go
    to ``rejects`` with their reasons; the others are cast, scored and written
    as ``(id, score, decision)``. The CSV is parsed once.
    """
    columns = [id_col, *boundary.contract.feature_columns]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    raw = io.read_csv(spark, source, schema)
    tagged = written(contract.tag_rows(raw, boundary.contract, require_complete=boundary.require_complete, id_col=id_col), "job-rows")
    accepted = contract.typed(tagged.filter("accepted").drop("accepted", "reasons"), boundary.contract)
    accepted = accepted.withColumn(id_col, F.expr(f"try_cast(`{id_col}` AS BIGINT)"))
    scored = written(boundary.score(accepted, keep=[id_col], validate_rows=False).select(id_col, "score", "decision"), "job-scores")
    io.write_csv(scored, target)
    rejected = tagged.filter("not accepted").drop("accepted")
    if rejects is not None:
        io.write_csv(rejected, rejects)
    return JobCounts(store.append_scores(scored.withColumnRenamed(id_col, store.ID), store_path), rejected.count())
