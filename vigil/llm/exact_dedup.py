"""Exact deduplication with disk-backed streaming state.

Texts are equal when identical after lower-casing A-Z. A stream of narrow rows
(digest, identifier, content locator) feeds a keyed state held in RocksDB,
checkpointed to the shared folder and never expired: per digest the row that
stays and the number of rows seen. Every digest hit is then checked on the full
bytes behind the locators.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import ascii_lower, every, located, materialize
from vigil.session import work_path

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def sha256_digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _keyed_state(rows: DataFrame) -> DataFrame:
    """digest -> (keep, n): stream ``rows`` through keyed state without expiry."""
    spark = rows.sparkSession
    source = rows.inputFiles()[0].rsplit("/", 1)[0]
    target, checkpoint = work_path(spark, "dedup-state"), work_path(spark, "dedup-stream")
    session = spark.newSession()
    session.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    # preallocated logs would cost 4 MB of disk for every state partition
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.allowFAllocate", "false")
    session.conf.set("spark.sql.shuffle.partitions", spark.conf.get("spark.sql.shuffle.partitions"))
    epochs: list[int] = []

    def keep_epoch(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/epoch={epoch}")
        epochs.append(epoch)

    state = (
        session.readStream.schema(rows.schema)
        .parquet(source)
        .groupBy("digest")
        .agg(F.max(F.struct("id", "_file", "_row")).alias("keep"), F.count(F.lit(1)).alias("n"))
    )
    query = (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .foreachBatch(keep_epoch)
        .start()
    )
    query.awaitTermination()
    if not epochs:
        return spark.createDataFrame([], state.schema)
    if len(set(epochs)) == 1:
        return spark.read.schema(state.schema).parquet(f"{target}/epoch={epochs[0]}")
    # a key updated in several epochs: its state with the most rows is the newest
    return materialize(
        spark.read.parquet(target).groupBy("digest").agg(F.max_by(F.struct("keep", "n"), "n").alias("s")).select("digest", "s.*"),
        "dedup-newest",
    )


def exact_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: Callable[[Column], Column] = sha256_digest,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, digest, _file, _row``.

    Of equal texts the row with the largest id stays. Null texts count as
    empty; a null id is smaller than any other. Rows repeated whole are ties:
    exactly one of them (the last by locator) has ``kept``. An empty table
    gives no rows. Columns other than the two named are not read, so their
    names can't clash.
    """
    source = located(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "dedup-docs")
    texts = source.select("id", ascii_lower(F.coalesce("text", F.lit(""))).alias("norm"), "_file", "_row").select(
        "*", digest(F.col("norm")).alias("digest")
    )
    rows = materialize(texts.select("digest", "id", "_file", "_row"), "dedup-rows")
    if not rows.inputFiles():
        return _decided(rows, _empty_state(rows))
    state = _keyed_state(rows)

    # Full bytes of every hit: the rows of a digest are equal if the least and
    # the greatest text are. Partial aggregation keeps one text per digest and
    # task, so a hot group never gathers.
    hits = rows.join(state.filter("n > 1").select("digest"), "digest", "left_semi")
    keys = materialize(hits.select(F.xxhash64("_file", "_row").alias("k")), "dedup-hits")
    checked = source.join(keys.hint("merge"), F.xxhash64("_file", "_row") == keys["k"], "left_semi").select(
        "id", ascii_lower(F.coalesce("text", F.lit(""))).alias("norm"), "_file", "_row"
    )
    checked = checked.withColumn("digest", digest(F.col("norm")))
    clashes = materialize(
        checked.groupBy("digest").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).filter("a <> b").select("digest"),
        "dedup-clashes",
    )
    if clashes.isEmpty():
        return _decided(rows, state)
    # Different texts under one digest: those digests are grouped by text itself.
    clashed = checked.join(clashes, "digest", "left_semi")
    by_text = clashed.groupBy("digest", "norm").agg(
        F.max(F.struct("id", "_file", "_row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )
    apart = clashed.join(by_text, ["digest", "norm"]).drop("norm")
    plain = rows.join(clashes, "digest", "left_anti")
    return _decided(plain, state).unionByName(_result(apart))


def _empty_state(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(
        F.max(F.struct("id", "_file", "_row")).alias("keep"), F.count(F.lit(1)).alias("n")
    )


def _decided(rows: DataFrame, state: DataFrame) -> DataFrame:
    return _result(rows.join(state, "digest"))


def _result(joined: DataFrame) -> DataFrame:
    return joined.select(
        "id",
        F.col("keep.id").alias("keep_id"),
        F.col("n").alias("group_size"),
        ((F.col("_file") == F.col("keep._file")) & (F.col("_row") == F.col("keep._row"))).alias("kept"),
        "digest",
        "_file",
        "_row",
    )


def keep_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the rows that ``exact_dedup`` drops, all columns as they were."""
    try:
        docs.select("_metadata.file_path")
    except Exception:  # not a scan of files: give its rows a place first
        docs = materialize(docs, "dedup-input")
    dropped = exact_dedup(docs, **options).filter(~F.col("kept")).select("_file", "_row")
    rows = docs.select(
        *every(docs), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    return rows.join(
        dropped, (rows["__file"] == dropped["_file"]) & (rows["__row"] == dropped["_row"]), "left_anti"
    ).select(*every(docs))


def query(docs: DataFrame) -> DataFrame:
    return exact_dedup(docs).select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""
