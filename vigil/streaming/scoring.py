"""ST1, ST3, ST5: incremental scoring on Structured Streaming.

A file source feeds the production slice (``maxFilesPerTrigger`` sets the
chunk size); each micro-batch is quarantined (V10), scored (stateless) and
appended to the score store in the store's own append order. The query
checkpoint replaces the batch-mode anti-join (J3): a file is processed once.
The sink is idempotent: the store's commit log knows each query's newest
micro-batch, so one that was committed is not written again, and the rows of
one that wasn't are in no snapshot. A batch reads one log entry, not the store.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vigil.operators import contract as contract_ops
from vigil.operators import store, trigger
from vigil.operators.manifest import Manifest


def scoring_batch_sink(
    boundary: contract_ops.ScoringBoundary,
    store_path: str,
    *,
    id_col: str = "TransactionID",
    quarantine_path: str | None = None,
    state_path: str | None = None,
    volume_threshold: int = trigger.DEFAULT_VOLUME_THRESHOLD,
    triggers_path: str | None = None,
    writer: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function: quarantine, score, append, volume check.

    Micro-batch numbers start at 0 for every query, so commits are kept by
    query; a sink that is called outside a streaming query needs a ``writer``
    name of its own.
    """
    features = list(boundary.contract.feature_columns)

    def score_batch(batch: DataFrame, batch_id: int, name: str) -> None:
        batch = batch.persist()
        try:
            rows = batch.select(id_col, *features)
            accepted, rejected = contract_ops.quarantine(
                rows, boundary.contract, require_complete=boundary.require_complete
            )
            if quarantine_path is not None:
                rejected.write.mode("overwrite").parquet(f"{quarantine_path}/query={name}/batch_id={batch_id}")
            scored = boundary.score(accepted, keep=[id_col], validate_rows=False)
            store.append_scores(scored, store_path, writer=name, micro_batch=batch_id)
        finally:
            batch.unpersist()

    def sink(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        name = writer or spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        if not name:
            raise ValueError("outside a streaming query the sink has to be given a writer name")
        if not Manifest(spark, store_path).committed(name, batch_id):
            score_batch(batch, batch_id, name)
        if state_path is not None and triggers_path is not None:
            # ST5: volume since the last retrain checkpoint, after this batch
            volume = store.row_count(spark, store_path) - trigger.last_store_row_count(trigger.read_state(spark, state_path))
            if volume >= volume_threshold:
                spark.createDataFrame([(int(volume),)], "volume long").write.mode("overwrite").parquet(
                    f"{triggers_path}/query={name}/batch_id={batch_id}"
                )

    return sink


def start_scoring_stream(
    spark: SparkSession,
    source_dir: str,
    schema: T.StructType,
    boundary: contract_ops.ScoringBoundary,
    store_path: str,
    checkpoint_dir: str,
    *,
    id_col: str = "TransactionID",
    max_files_per_trigger: int = 1,
    available_now: bool = True,
    processing_time: str | None = None,
    **sink_options,
) -> StreamingQuery:
    """ST1: start the scoring stream (``availableNow`` or a processing-time trigger)."""
    source = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(source_dir)
    )
    writer = source.writeStream.foreachBatch(
        scoring_batch_sink(boundary, store_path, id_col=id_col, **sink_options)
    ).option("checkpointLocation", checkpoint_dir)
    if processing_time is not None:
        writer = writer.trigger(processingTime=processing_time)
    elif available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def run_scoring_stream(*args, **kwargs) -> StreamingQuery:
    """Start with ``availableNow`` and block until every available file is scored."""
    kwargs["available_now"] = True
    query = start_scoring_stream(*args, **kwargs)
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(f"scoring stream failed: {query.exception()}")
    return query
