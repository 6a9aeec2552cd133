"""Hard negatives by a secondary-sort shuffle.

Every row is scored against every anchor. A pair travels as one packed key
(anchor, descending score, positive before negative, id): the rows are dealt out
by anchor and sorted by that key within partitions, which is what
``repartitionAndSortWithinPartitions`` does, here on DataFrames. An iterator
then reads an anchor's pairs from the highest score down. The first positives
each open a window of scores that lies below them; negatives fall into the open
windows until each has its number. Nothing of an anchor is held but its few
open windows.

A task sends on only pairs that can be among the answers: of each anchor its own
best positives, and, once the windows are known from a first sort of the
positives, its own best negatives of each window. That loses nothing, as a pair
beaten within its task is beaten overall.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize
from vigil.session import ship_package

#: Bytes of anchor vectors that are broadcast at a time, and pairs scored at a time.
BLOCK_BYTES, CELLS = 8 << 20, 1 << 22
#: Rows with a larger squared norm could have scores beyond 64 bits.
MOST_NORM = 1 << 62

_KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8")])
_UNPACK = struct.Struct(">QQBQ")
_SIGN, _TOP = 1 << 63, (1 << 63) - 1
POSITIVE, NEGATIVE = 0, 1


def pack(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.Array:
    """Keys whose byte order is: anchor, score from the highest, kind, id."""
    keys = np.empty(len(anchor), dtype=_KEY)
    keys["anchor"] = anchor.astype(np.uint64) ^ np.uint64(_SIGN)
    keys["score"] = (np.int64(_TOP) - np.maximum(score, 0)).astype(np.uint64) + np.maximum(-score, 0).astype(np.uint64)
    keys["kind"] = kind
    keys["id"] = ids.astype(np.uint64) ^ np.uint64(_SIGN)
    return pa.Array.from_buffers(pa.binary(_KEY.itemsize), len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def unpack(key: bytes) -> tuple[int, int, int, int]:
    anchor, score, kind, i = _UNPACK.unpack(key)
    return anchor - _SIGN, _TOP - score, kind, i - _SIGN


def whole(vectors: pa.Array, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per vector length: the rows' places and their components times ``scale``, rounded down."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.floor(vectors.flatten().to_numpy(zero_copy_only=False) * scale)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        grid = flat[offsets[rows][:, None] + np.arange(length)].reshape(len(rows), length)
        fits = (grid * grid).sum(axis=1) <= MOST_NORM
        yield rows[fits], grid[fits]


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All inner products of the rows of two matrices of integers, exactly."""
    most = np.sqrt((a * a).sum(axis=1).max(initial=0)) * np.sqrt((b * b).sum(axis=1).max(initial=0))
    if most < 1 << 52:  # every partial sum is an exact double
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def best(groups: np.ndarray, score: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of each group by falling score, then id."""
    order = np.lexsort((ids, -score, groups))
    own = groups[order]
    first = np.concatenate([[True], own[1:] != own[:-1]]) if len(own) else np.zeros(0, bool)
    start = np.maximum.accumulate(np.where(first, np.arange(len(own)), 0))
    return order[np.arange(len(own)) - start < most]


class _Anchors:
    """Anchors of one block: ids, labels by code, and vectors by length."""

    def __init__(self, rows: pa.Table, scale: float):
        self.ids = rows.column("id").to_numpy()
        names = rows.column("label").to_pylist()
        self.codes = {label: i for i, label in enumerate(dict.fromkeys(names))}
        self.labels = np.array([self.codes[x] for x in names], dtype=np.int64)
        self.grids = {grid.shape[1]: (rows, grid) for rows, grid in whole(rows.column("v"), scale) if len(rows)}


def _scored(anchors: _Anchors, batch: pa.RecordBatch, scale: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Anchor places, batch places and all scores between them, a bounded number at a time."""
    for rows, grid in whole(batch.column("v"), scale):
        places, theirs = anchors.grids.get(grid.shape[1], (None, None))
        if places is None or not len(rows):
            continue
        step = max(1, CELLS // len(places))
        for at in range(0, len(rows), step):
            yield places, rows[at : at + step], scores(theirs, grid[at : at + step])


def _labels(anchors: _Anchors, batch: pa.RecordBatch) -> np.ndarray:
    coded = batch.column("label").dictionary_encode()
    known = np.array([anchors.codes.get(x, -1) for x in coded.dictionary.to_pylist()], dtype=np.int64)
    return known[coded.indices.to_numpy()]


def _leading(grid: np.ndarray, allowed: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells that can be among a row's ``most`` best allowed ones."""
    if grid.shape[1] > most:
        held = np.where(allowed, grid, np.iinfo(np.int64).min)
        least = np.partition(held, grid.shape[1] - most, axis=1)[:, grid.shape[1] - most]
        allowed = allowed & (grid >= least[:, None])
    return np.nonzero(allowed)


def _keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(anchor, pa.int64()), pack(anchor, score, kind, ids)], names=["anchor", "key"])


def _send_positives(held, scale: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: _Anchors = held.value
        at, score, ids = (np.zeros(0, np.int64) for _ in range(3))
        for batch in batches:
            labels, own = _labels(anchors, batch), batch.column("id").to_numpy()
            for places, rows, grid in _scored(anchors, batch, scale):
                allowed = (anchors.labels[places][:, None] == labels[rows]) & (anchors.ids[places][:, None] != own[rows])
                i, j = _leading(grid, allowed, most)
                at = np.concatenate([at, places[i]])
                score, ids = np.concatenate([score, grid[i, j]]), np.concatenate([ids, own[rows[j]]])
                keep = best(at, score, ids, most)
                at, score, ids = at[keep], score[keep], ids[keep]
        if len(at):
            yield _keys(anchors.ids[at], score, POSITIVE, ids)

    return run


def _send_pairs(held, scale: float, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, low, high = held.value
        window, score, ids, number = (np.zeros(0, np.int64) for _ in range(4))
        seen = 0
        for batch in batches:
            labels, own = _labels(anchors, batch), batch.column("id").to_numpy()
            for places, rows, grid in _scored(anchors, batch, scale):
                other = anchors.labels[places][:, None] != labels[rows]
                for k in range(low.shape[1]):
                    allowed = other & (grid >= low[places, k][:, None]) & (grid <= high[places, k][:, None])
                    i, j = _leading(grid, allowed, most)
                    window = np.concatenate([window, places[i] * low.shape[1] + k])
                    score, ids = np.concatenate([score, grid[i, j]]), np.concatenate([ids, own[rows[j]]])
                    number = np.concatenate([number, seen + rows[j]])
                keep = best(window, score, ids, most)
                window, score, ids, number = window[keep], score[keep], ids[keep], number[keep]
            seen += batch.num_rows
        if len(window):
            at = window // low.shape[1]
            once = np.unique(np.stack([at, number]), axis=1, return_index=True)[1]  # a row may be in several windows
            yield _keys(anchors.ids[at[once]], score[once], NEGATIVE, ids[once])

    return run


def _first_positives(most: int):
    """Streams sorted keys; an anchor's first keys are its positives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, taken = None, 0
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                anchor, score, _, i = unpack(key)
                taken = taken + 1 if anchor == last else 1
                last = anchor
                if taken <= most:
                    out.append((anchor, taken, i, score))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["anchor", "place", "id", "score"])

    return run


def bounds(score: int, low: int, high: int) -> tuple[int, int]:
    """Least and largest whole s with low * score <= 100 * s <= high * score."""
    return -((-low * score) // 100), high * score // 100


def _open_windows(most: int, low: int, high: int):
    """Streams sorted keys: positives open windows, negatives are emitted into those they fall in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, windows = None, []
        for batch in batches:
            out = []
            for key in batch.column("key").to_pylist():
                anchor, score, kind, i = unpack(key)
                if anchor != last:
                    last, windows = anchor, []
                if kind == POSITIVE:
                    windows.append([i, score, *bounds(score, low, high), 0])
                    continue
                for w in windows:
                    if w[2] <= score <= w[3] and w[4] < most:
                        w[4] += 1
                        out.append((anchor, w[0], w[4], i, w[1], score))
            if out:
                names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
                columns = [pa.array(c, pa.int32() if n == "rank" else pa.int64()) for n, c in zip(names, zip(*out, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


OUT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per anchor and positive its first ``negatives`` rows of another label within the window.

    A score is the inner product of vectors whose components are multiplied by
    ``scale`` and rounded down. An anchor's positives are its first
    ``positives`` rows of the same label and another id. A negative's score lies
    between ``low`` and ``high`` percent of the positive's. Higher scores come
    first, ties by smaller id; a repeated row counts again as candidate, and of
    rows with an anchor's id the least (label, vector) is the anchor. Rows with
    a null id or label, a null vector, null or non-finite components, or a
    scaled squared norm above 2**62 take no part; only vectors of one length are
    compared, empty ones included. Empty tables, or none that are anchors, give no
    rows. Other columns aren't read.

    Anchors are broadcast in blocks of about ``block_bytes``; each block scores
    all rows.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
        F.coalesce(anchor, F.lit(False)).alias("asks"),
    ).filter("id is not null and label is not null and v is not null and forall(v, x -> x is not null and abs(x) < double('Infinity') and not isnan(x))")
    asking = materialize(
        rows.filter("asks").groupBy("id").agg(F.min(F.struct("label", "v")).alias("x")).select("id", "x.label", "x.v"), "anchors"
    )
    rows = rows.select("id", "label", "v")
    held = asking.agg(F.sum(F.size("v") * 8 + 64)).first()[0] or 0
    blocks = -(-held // block_bytes)
    secondary_sort: Callable[[DataFrame], DataFrame] = lambda pairs: pairs.repartition("anchor").sortWithinPartitions("key")
    found = []
    for block in range(blocks):
        part = asking.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == block).toArrow()
        if not part.num_rows:
            continue
        anchors = _Anchors(part, scale)
        sent = rows.mapInArrow(_send_positives(spark.sparkContext.broadcast(anchors), scale, positives), "anchor long, key binary")
        first = materialize(
            secondary_sort(sent).mapInArrow(_first_positives(positives), "anchor long, place long, id long, score long"), "positives"
        )
        shape = (len(anchors.ids), positives)
        least, most = np.ones(shape, np.int64), np.zeros(shape, np.int64)
        places = {int(x): i for i, x in enumerate(anchors.ids)}
        for x in first.toArrow().to_pylist():  # a few per anchor of the block
            least[places[x["anchor"]], x["place"] - 1], most[places[x["anchor"]], x["place"] - 1] = bounds(x["score"], low, high)
        pairs = rows.mapInArrow(_send_pairs(spark.sparkContext.broadcast((anchors, least, most)), scale, negatives), "anchor long, key binary")
        opening = first.mapInArrow(_again, "anchor long, key binary")
        mined = secondary_sort(opening.union(pairs)).mapInArrow(_open_windows(negatives, low, high), OUT)
        found.append(mined if blocks == 1 else materialize(mined, "negatives"))
    if not found:
        return spark.createDataFrame([], OUT)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out


def _again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        anchor, score, ids = (batch.column(c).to_numpy() for c in ("anchor", "score", "id"))
        yield _keys(anchor, score, POSITIVE, ids)


def query(vectors: DataFrame) -> DataFrame:
    moved = F.col("label").cast("long")
    return hard_negatives(
        vectors.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (moved + 1) % 10).otherwise(moved)), F.col("vec_id") % 100 == 0
    )


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM e a JOIN e b ON len(a.q) = len(b.q) WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same AND id <> anchor_id
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 10
"""
