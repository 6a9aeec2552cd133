"""The append-only score store and the operators that read it.

S5 append (zero rows append nothing, returns the row count), S6 read (empty
with schema when absent), W2 newest append per id, A3 distinct valid ids, J2
semi-join / J3 anti-join against the store, L2 next unseen chunk.

Batches are ordered by a commit log (``manifest``): a batch's number is its
version there. Each row also carries a ``seq`` fixed at write time, so "newest
append wins" has an explicit order (Spark has no physical row order to rely on).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.ordered import at_or_after, at_or_before, rows_at_ranks
from vigil.operators.manifest import COMPACT_EVERY, Manifest

ID = "TransactionID"
STORE_COLUMNS = ("TransactionID", "score", "decision")
STORE_SCHEMA = T.StructType(
    [
        T.StructField("TransactionID", T.LongType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("decision", T.StringType()),
        T.StructField("seq", T.LongType()),
        T.StructField("batch_id", T.LongType()),
    ]
)


def read_store(spark: SparkSession, store_path: str, *, version: int | None = None) -> DataFrame:
    """The store, or its snapshot at ``version``; an empty frame with the schema when absent."""
    parts, fresh = Manifest(spark, store_path).snapshot(version)
    return _rows_of(spark, store_path, parts, fresh)


def _rows_of(spark: SparkSession, store_path: str, parts: Sequence[str], fresh: dict[str, int]) -> DataFrame:
    """Rows of compacted folders, which carry their batch, and of folders that are a batch."""
    folders = [f"{store_path}/{f}" for f in [*parts, *fresh]]
    if not folders:
        return spark.createDataFrame([], STORE_SCHEMA)
    rows = spark.read.schema(STORE_SCHEMA).parquet(*folders)
    if not fresh:
        return rows
    pairs = [F.lit(x) for folder, version in fresh.items() for x in (folder, version)]
    folder = F.element_at(F.split("_metadata.file_path", "/"), -2)
    batch = F.coalesce("batch_id", F.try_element_at(F.create_map(*pairs), folder).cast("long"))
    return rows.withColumn("batch_id", batch)


def row_count(spark: SparkSession, store_path: str) -> int:
    """Rows appended so far, duplicates included, from the newest log entry."""
    return Manifest(spark, store_path).latest().total


def append_scores(
    scored: DataFrame,
    store_path: str,
    *,
    writer: str | None = None,
    micro_batch: int = -1,
    compact_every: int = COMPACT_EVERY,
) -> int:
    """Append ``(TransactionID, score, decision)`` rows as one batch; returns rows appended.

    Batches are numbered in the order of the commits, whoever makes them. A
    ``writer`` numbers its own batches by ``micro_batch``; one that is committed
    already is not appended again. The cost doesn't grow with the store, but for
    a merge of the last batches after every ``compact_every`` of them.
    """
    spark = scored.sparkSession
    missing = [c for c in STORE_COLUMNS if c not in scored.columns]
    if missing:
        raise ValueError(f"a score to store needs {', '.join(STORE_COLUMNS)}; this frame lacks {', '.join(missing)}")
    log = Manifest(spark, store_path)
    if writer is not None and log.committed(writer, micro_batch):
        return 0
    folder, rows = stage_scores(scored, store_path)
    if not rows and writer is None:
        return 0
    entry = log.commit(folder, rows, writer, micro_batch)
    if entry is not None and log.behind(entry) >= compact_every:
        compact(spark, store_path)
    return rows if entry is not None else 0


def stage_scores(scored: DataFrame, store_path: str) -> tuple[str, int]:
    """Write a batch's rows without committing them: the folder and the row count."""
    rows = scored.select(
        F.col(ID).cast("long").alias(ID),
        F.col("score").cast("double").alias("score"),
        F.col("decision").cast("string").alias("decision"),
        F.monotonically_increasing_id().alias("seq"),
    )
    return Manifest(scored.sparkSession, store_path).stage(rows)


def compact(spark: SparkSession, store_path: str) -> bool:
    """Merge the batches since the last compaction into one folder; batch numbers stay."""
    return Manifest(spark, store_path).compact(lambda fresh: _rows_of(spark, store_path, [], fresh)) is not None


def latest_scores(store: DataFrame, *, id_col: str = ID) -> DataFrame:
    """The newest append per id (by ``batch_id`` then ``seq``).

    A grouped ``max_by`` keeps the aggregation partial on the map side, so an
    id re-scored many times collapses before the shuffle.
    """
    payload = [c for c in store.columns if c not in (id_col,)]
    newest = F.max_by(F.struct(*payload), F.struct("batch_id", "seq"))
    return store.groupBy(id_col).agg(newest.alias("_n")).select(id_col, "_n.*")


def scored_ids(store: DataFrame, *, id_col: str = ID) -> DataFrame:
    """Distinct ids present in the store; unparsable ids are ignored."""
    if id_col not in store.columns:
        return store.sparkSession.createDataFrame([], T.StructType([T.StructField(id_col, T.LongType())]))
    ids = F.expr(f"try_cast(`{id_col}` AS BIGINT)")
    return store.select(ids.alias(id_col)).where(F.col(id_col).isNotNull()).distinct()


def store_counts(store: DataFrame, *, id_col: str = ID) -> DataFrame:
    """Rows (duplicates included) and distinct valid ids, in one aggregate."""
    ids = F.expr(f"try_cast(`{id_col}` AS BIGINT)")
    return store.agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(ids).alias("n_ids")
    )


def scored_rows(stream: DataFrame, store: DataFrame, *, id_col: str = ID) -> DataFrame:
    """Stream rows whose id was scored (semi-join, no driver-side id set)."""
    return stream.join(scored_ids(store, id_col=id_col), id_col, "left_semi")


def unseen_rows(stream: DataFrame, store: DataFrame, *, id_col: str = ID) -> DataFrame:
    """Stream rows not yet scored (anti-join; NULL-safe unlike NOT IN)."""
    return stream.join(scored_ids(store, id_col=id_col), id_col, "left_anti")


def first_rows(
    df: DataFrame,
    n: int,
    order: Sequence[str],
    *,
    descending: bool = False,
) -> DataFrame:
    """The first ``n`` rows in ``order`` (a unique key), as a filter on ``df``.

    Ranks only the key columns with the range-bucketed row number, finds the
    key at rank ``n`` and keeps rows at or before it — no n-per-partition
    merge in a single task, and the wide rows are never shuffled.
    """
    if n <= 0:
        raise ValueError(f"n must be positive, got {n!r}")
    order = list(order)
    # Ask for an ascending rank either way (the key is unique, so the n-th
    # largest is the (total - n + 1)-th smallest); plain column names keep
    # the shuffle-free selection path available.
    total, found = rows_at_ranks(
        df.select(*order), order, lambda total: [total - n + 1 if descending else n], cache=True
    )
    if total <= n:  # no more rows than n: everything
        return df
    row = found[total - n + 1 if descending else n]
    key = [row[c] for c in order]
    return df.filter((at_or_after if descending else at_or_before)(order, key))


def next_chunk(
    stream: DataFrame,
    store: DataFrame,
    n: int = 500,
    *,
    time_col: str = "TransactionDT",
    id_col: str = ID,
) -> DataFrame:
    """L2: the first ``n`` unseen stream rows in ``(time, id)`` order."""
    return first_rows(unseen_rows(stream, store, id_col=id_col), n, [time_col, id_col])
