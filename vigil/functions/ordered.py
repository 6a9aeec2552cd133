"""Globally ordered running sums without a single-partition window.

A window with ``orderBy`` but no ``partitionBy`` plans ``Exchange
SinglePartition``: every row goes through one task. The split, AUC, cost
curve, KS and DeLong placements all need a *global* running sum, so they share
this primitive instead:

1. range-partition the (narrow) input on ``(*by, *order)`` — Spark samples the
   full composite key, so one hot value of the first key is still spread over
   several buckets by the later keys;
2. tag each row with its bucket (the range partition id) and checkpoint the
   narrow result to the shared checkpoint folder, so the totals and the rows
   see the very same buckets (and lineage is cut for executor loss);
3. per ``(by, bucket)`` totals (``groups x buckets`` rows) -> running offsets;
4. an in-bucket window ``partitionBy(by, bucket).orderBy(order)`` plus offset.

Only the offsets table is small; it is broadcast if its measured size allows. The
bucket count follows from the counted input, so a small input takes the same
path with one bucket.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.session import ensure_checkpoint_dir

BUCKET = "_bucket"

# Rows per range bucket; the bucket count follows from the counted input.
ROWS_PER_BUCKET = 1_000_000
# Measured bytes up to which an offsets table is broadcast.
BROADCAST_BYTES = 32 << 20
# Rank lookup: bin edges per pass, the sketch's accuracy, and the rows that are
# sorted once a rank's region has shrunk to them. All fixed, so state is bounded.
EDGES, SKETCH_ACCURACY, SORT_ROWS = 100, 2_000, 100_000


def _sort_expr(c: str | Column) -> Column:
    return F.col(c).asc_nulls_last() if isinstance(c, str) else c


def range_bucketed(
    df: DataFrame,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    n_buckets: int | None = None,
) -> DataFrame:
    """``df`` range-partitioned on ``(*by, *order)`` with a bucket id, checkpointed.

    The input is computed once: cached, counted (which sets the bucket count,
    ``ROWS_PER_BUCKET`` rows each) and checkpointed from the cache.
    """
    ensure_checkpoint_dir(df.sparkSession)
    keys = [F.col(c).asc() for c in by] + [_sort_expr(c) for c in order]
    base = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = n_buckets or max(1, -(-base.count() // ROWS_PER_BUCKET))
        tagged = base.repartitionByRange(n, *keys).withColumn(BUCKET, F.spark_partition_id())
        return tagged.checkpoint(eager=True)
    finally:
        base.unpersist()


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its measured size allows one; without, the join shuffles."""
    text = F.length(F.concat_ws("", *[F.col(c).cast("string") for c in df.columns]))
    size = df.agg(F.count(F.lit(1)).alias("n"), F.sum(text).alias("b")).first()
    measured = size["n"] * 16 * (len(df.columns) + 1) + 4 * (size["b"] or 0)
    return F.broadcast(df) if measured <= BROADCAST_BYTES else df


def bucket_sizes(rp: DataFrame) -> list[tuple[int, int]]:
    """``[(bucket, rows)]`` of a range-bucketed frame, in bucket order.

    At most one row per bucket reaches the driver (bounded by the bucket
    count, not by the data).
    """
    rows = rp.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n")).collect()
    return sorted((int(r[BUCKET]), int(r["n"])) for r in rows)


def at_or_before(cols: Sequence[str], key: Sequence) -> Column:
    """Whether ``cols`` come at or before ``key``, ascending with NULLs last.

    Plain comparisons, so scans can use them; a NULL result counts as false.
    """
    pred = F.lit(True)
    for c, v in reversed(list(zip(cols, key, strict=True))):
        col = F.col(c)
        before = col.isNotNull() if v is None else col < F.lit(v)
        pred = before | (col.eqNullSafe(F.lit(v)) & pred)
    return pred


def at_or_after(cols: Sequence[str], key: Sequence) -> Column:
    """Whether ``cols`` come at or after ``key``, ascending with NULLs last."""
    pred = F.lit(True)
    for c, v in reversed(list(zip(cols, key, strict=True))):
        col = F.col(c)
        after = F.lit(False) if v is None else (col.isNull() | (col > F.lit(v)))
        pred = after | (col.eqNullSafe(F.lit(v)) & pred)
    return pred


@dataclass(frozen=True)
class _Region:
    """Rows whose first keys equal ``fixed`` and whose next key is in the open interval ``(low, high)``."""

    fixed: tuple = ()
    low: object = None
    high: object = None

    def holds(self, order: Sequence[str]) -> Column:
        pred = F.lit(True)
        for c, v in zip(order, self.fixed, strict=False):
            pred = pred & F.col(c).eqNullSafe(F.lit(v))
        if len(self.fixed) < len(order):
            key = F.col(order[len(self.fixed)])
            if self.low is not None:
                pred = pred & (key > F.lit(self.low))
            if self.high is not None:
                pred = pred & (key < F.lit(self.high))
        return F.coalesce(pred, F.lit(False))


def rows_at_ranks(
    df: DataFrame,
    order: Sequence[str | Column],
    ranks: Callable[[int], Iterable[int]],
    *,
    cache: bool = False,
) -> tuple[int, dict[int, Row]]:
    """``(n, {rank: row})`` for the 1-based global ranks ``ranks(n)``, NULLs last.

    Numeric and temporal keys are never shuffled. All wanted ranks share the
    passes: a fixed-size quantile sketch gives each rank's region ``EDGES`` bin
    edges, one exact count per bin finds the bin that holds the rank, and only
    that bin is refined, over the next key once a bin is a single value. A
    region of at most ``SORT_ROWS`` rows is sorted. Other key types go through
    :func:`ranks_by_buckets`. ``cache`` keeps the keys for the passes of one
    lookup; callers set it where the keys come from joins or aggregates.
    """
    order = list(order)
    if not all(isinstance(c, str) and _binnable(df, c) for c in order):
        return ranks_by_buckets(df, order, ranks)
    keys = df.select(*order)
    if cache:
        keys = keys.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n = keys.count()
        wanted = sorted({int(r) for r in ranks(n) if 1 <= int(r) <= n})
        places = {r: (_Region(), r, n) for r in wanted}  # region, rank in it, rows in it
        while True:
            wide = {reg for reg, _, rows in places.values() if rows > SORT_ROWS and len(reg.fixed) < len(order)}
            if not wide:
                return n, _sorted_rows(keys, order, places)
            bins = {}
            for group in _by_depth(wide):
                bins |= _bins(keys, order, group)
            places = {r: _narrow(bins[reg], rank) if reg in wide else (reg, rank, rows) for r, (reg, rank, rows) in places.items()}
    finally:
        if cache:
            keys.unpersist()


def _binnable(df: DataFrame, column: str) -> bool:
    kind = df.schema[column].dataType
    return isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)) and not isinstance(
        kind, T.DecimalType
    )


def _by_depth(regions: Iterable[_Region]) -> list[list[_Region]]:
    groups: dict[int, list[_Region]] = {}
    for reg in regions:
        groups.setdefault(len(reg.fixed), []).append(reg)
    return list(groups.values())


def _bins(keys: DataFrame, order: Sequence[str], regions: list[_Region]) -> dict[_Region, list[tuple[_Region, int]]]:
    """Per region its bins in order with their exact row counts (two passes, bounded results)."""
    depth = len(regions[0].fixed)
    key = F.col(order[depth])
    number = F.lit(None).cast("int")
    for i, reg in enumerate(regions):
        number = F.when(reg.holds(order), F.lit(i)).otherwise(number)
    inside = keys.withColumn("_reg", number).where(F.col("_reg").isNotNull())
    probs = [i / EDGES for i in range(EDGES + 1)]
    sketch = inside.groupBy("_reg").agg(F.percentile_approx(key, probs, SKETCH_ACCURACY).alias("e")).collect()
    edges = {r["_reg"]: sorted(set(r["e"] or [])) for r in sketch}
    # an even bin lies between edges, an odd one is the edge itself; NULLs come last
    kind = keys.schema[order[depth]].dataType
    place = F.lit(None).cast("int")
    for i, es in edges.items():
        if es:
            array = F.array(*[F.lit(e).cast(kind) for e in es])
            below = F.size(F.filter(array, lambda e: e < key))
            spot = F.when(key.isNull(), 2 * len(es) + 2).otherwise(2 * below + F.array_contains(array, key).cast("int"))
        else:
            spot = F.lit(2)
        place = F.when(F.col("_reg") == i, spot).otherwise(place)
    cells = inside.groupBy("_reg", place.alias("_bin")).agg(F.count(F.lit(1)).alias("c")).collect()
    out: dict[_Region, list[tuple[_Region, int]]] = {reg: [] for reg in regions}
    for cell in sorted(cells, key=lambda c: (c["_reg"], c["_bin"])):
        reg, es, b = regions[cell["_reg"]], edges[cell["_reg"]], cell["_bin"]
        if b == 2 * len(es) + 2:
            part = _Region((*reg.fixed, None))
        elif b % 2:
            part = _Region((*reg.fixed, es[b // 2]))
        else:
            part = _Region(
                reg.fixed, es[b // 2 - 1] if b else reg.low, es[b // 2] if b // 2 < len(es) else reg.high
            )
        out[reg].append((part, int(cell["c"])))
    return out


def _narrow(bins: list[tuple[_Region, int]], rank: int) -> tuple[_Region, int, int]:
    for part, rows in bins:
        if rank <= rows:
            return part, rank, rows
        rank -= rows
    raise ValueError("the keys changed between the passes of a rank lookup")


def _sorted_rows(keys: DataFrame, order: Sequence[str], places: dict) -> dict[int, Row]:
    """The wanted row of every region: sorted in the region, at most ``SORT_ROWS`` rows, or fixed whole."""
    named = Row(*order)
    found = {r: named(*reg.fixed) for r, (reg, _, _) in places.items() if len(reg.fixed) == len(order)}
    regions = sorted({reg for r, (reg, _, _) in places.items() if r not in found}, key=repr)
    if not regions:
        return found
    number = F.lit(None).cast("int")
    for i, reg in enumerate(regions):
        number = F.when(reg.holds(order) if reg != _Region() else F.lit(True), F.lit(i)).otherwise(number)
    inside = keys.withColumn("_reg", number).where(F.col("_reg").isNotNull())
    w = Window.partitionBy("_reg").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    hit = F.lit(False)
    for r, (reg, rank, _) in places.items():
        if r not in found:
            hit = hit | ((F.col("_reg") == regions.index(reg)) & (F.col("_lrn") == rank))
    rows = {(x["_reg"], x["_lrn"]): x for x in inside.withColumn("_lrn", F.row_number().over(w)).where(hit).collect()}
    for r, (reg, rank, _) in places.items():
        if r not in found:
            row = rows[regions.index(reg), rank]
            found[r] = named(*[row[c] for c in order])
    return found


def ranks_by_buckets(
    df: DataFrame,
    order: Sequence[str | Column],
    ranks: Callable[[int], Iterable[int]],
    *,
    n_buckets: int | None = None,
) -> tuple[int, dict[int, Row]]:
    """Exact rank lookup through range buckets (any key types, any skew).

    Only the buckets holding a wanted rank are sorted (each about ``n / B``
    rows); the rest of the data is never ordered.
    """
    order = list(order)
    rp = range_bucketed(df, order, (), n_buckets)
    sizes = bucket_sizes(rp)
    n = sum(c for _, c in sizes)
    wanted = sorted({int(r) for r in ranks(n) if 1 <= int(r) <= n})
    targets: dict[int, list[tuple[int, int]]] = {}
    start = 0
    for b, c in sizes:
        for r in wanted:
            if start < r <= start + c:
                targets.setdefault(b, []).append((r - start, r))
        start += c
    if not targets:
        return n, {}
    w = Window.partitionBy(BUCKET).orderBy(*[_sort_expr(c) for c in order])
    local = rp.filter(F.col(BUCKET).isin(list(targets))).withColumn("_lrn", F.row_number().over(w))
    cond = F.lit(False)
    for b, pairs in targets.items():
        cond = cond | ((F.col(BUCKET) == b) & F.col("_lrn").isin([lr for lr, _ in pairs]))
    lookup = {(b, lr): r for b, pairs in targets.items() for lr, r in pairs}
    found = {}
    for row in local.filter(cond).collect():  # one row per wanted rank
        found[lookup[(int(row[BUCKET]), int(row["_lrn"]))]] = row
    return n, found


def prefix_sums(
    df: DataFrame,
    order: Sequence[str | Column],
    sums: Sequence[str],
    *,
    by: Sequence[str] = (),
    prefix: str = "cum_",
    totals: bool = False,
    n_buckets: int | None = None,
) -> DataFrame:
    """Add ``<prefix><c>`` = running sum of ``c`` in ``order`` within ``by``.

    The running sum is inclusive of the current row; rows that tie on the
    whole ordering get distinct (arbitrary-order) prefixes, so callers either
    order by a unique key or collapse ties with a ``groupBy`` first. With
    ``totals`` each row also gets ``tot_<c>``, the sum over its whole group,
    read off the same small bucket-totals table (no extra scan).

    One plan at every size: the bucket count follows from the counted input,
    and the totals table (one row per bucket and group in it) is broadcast
    only if its measured size allows.
    """
    order = list(order)
    whole = ["_whole"] if not by else []
    groups = [*by, *whole]
    frame = df.withColumn("_whole", F.lit(0)) if whole else df
    rp = range_bucketed(frame, order, by, n_buckets)
    bucket_totals = rp.groupBy(*groups, BUCKET).agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy(*groups).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = bucket_totals.select(
        *groups,
        BUCKET,
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_off_{c}") for c in sums],
        *([F.sum(c).over(Window.partitionBy(*groups)).alias(f"tot_{c}") for c in sums] if totals else []),
    )
    matched = F.col(f"r.{BUCKET}") == F.col(f"o.{BUCKET}")
    for c in groups:
        matched = matched & F.col(f"r.{c}").eqNullSafe(F.col(f"o.{c}"))
    added = [c for c in offsets.columns if c not in (*groups, BUCKET)]
    small = broadcast_if_small(offsets)
    joined = rp.alias("r").join(small.alias("o"), matched).select("r.*", *[F.col(f"o.{c}") for c in added])
    running = Window.partitionBy(*groups, BUCKET).orderBy(*[_sort_expr(c) for c in order]).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    out = joined
    for c in sums:
        out = out.withColumn(f"{prefix}{c}", F.col(f"_off_{c}") + F.sum(c).over(running))
    return out.drop(BUCKET, *whole, *[f"_off_{c}" for c in sums])


__all__ = [
    "BUCKET",
    "bucket_sizes",
    "ranks_by_buckets",
    "rows_at_ranks",
    "at_or_before",
    "at_or_after",
    "prefix_sums",
    "range_bucketed",
]
