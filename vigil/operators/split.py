"""W1 chronological train / test / stream split and M9 expanding time folds.

Rows are ranked by ``(time, id)`` (the id breaks ties the reference leaves
unspecified). Only the ranks of the narrow ``(time, id)`` projection are
computed; the two cut keys (the rows at ranks ``round(n*f1)`` and
``round(n*(f1+f2))``, Python's half-to-even ``round``) are then turned into
plain range predicates on ``(time, id)``. The full table is therefore never
shuffled for the split, and each slice is a filter Catalyst can push into the
Parquet scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.ordered import at_or_before, rows_at_ranks

TRAIN_FRAC = 0.70
TEST_FRAC = 0.15
SLICE = "slice"


@dataclass(frozen=True)
class SplitCuts:
    """Row count, cut ranks and the ``(time, id)`` keys at those ranks."""

    n: int
    i_test: int
    i_stream: int
    key_test: tuple | None  # last train row, None when the train slice is empty
    key_stream: tuple | None  # last test row, None when train+test is empty


def _key_at_or_before(time_col: str, id_col: str, key: tuple | None) -> Column:
    """Rows up to and including ``key`` in ``(time, id)`` order, NULLs last."""
    return F.lit(False) if key is None else at_or_before([time_col, id_col], key)


def _check(df: DataFrame, time_col: str, train_frac: float, test_frac: float) -> None:
    if time_col not in df.columns:
        raise ValueError(f"no column {time_col!r} to order the rows by")
    if min(train_frac, test_frac) < 0 or train_frac + test_frac >= 1.0:
        raise ValueError(f"slice shares {train_frac} and {test_frac} must not be negative and must leave rows for the stream")


def split_cuts(
    df: DataFrame,
    *,
    time_col: str = "TransactionDT",
    id_col: str = "TransactionID",
    train_frac: float = TRAIN_FRAC,
    test_frac: float = TEST_FRAC,
) -> SplitCuts:
    """Rank ``(time, id)`` globally and return the two cut keys."""
    _check(df, time_col, train_frac, test_frac)
    keys = df.select(time_col, id_col)
    fracs = (train_frac, train_frac + test_frac)
    n, found = rows_at_ranks(keys, [time_col, id_col], lambda n: [round(n * f) for f in fracs])
    i_test, i_stream = (round(n * f) for f in fracs)

    def key(rank: int) -> tuple | None:
        row = found.get(rank)
        return None if row is None else (row[time_col], row[id_col])

    return SplitCuts(n, i_test, i_stream, key(i_test), key(i_stream))


def slice_column(cuts: SplitCuts, time_col: str = "TransactionDT", id_col: str = "TransactionID") -> Column:
    """``train`` / ``test`` / ``stream`` as a pure expression over ``(time, id)``."""
    return (
        F.when(_key_at_or_before(time_col, id_col, cuts.key_test), "train")
        .when(_key_at_or_before(time_col, id_col, cuts.key_stream), "test")
        .otherwise("stream")
    )


def with_slice(
    df: DataFrame,
    *,
    time_col: str = "TransactionDT",
    id_col: str = "TransactionID",
    train_frac: float = TRAIN_FRAC,
    test_frac: float = TEST_FRAC,
    cuts: SplitCuts | None = None,
) -> DataFrame:
    """``df`` with a derived ``slice`` column (one frame instead of three)."""
    cuts = cuts or split_cuts(
        df, time_col=time_col, id_col=id_col, train_frac=train_frac, test_frac=test_frac
    )
    return df.withColumn(SLICE, slice_column(cuts, time_col, id_col))


def temporal_split(
    df: DataFrame,
    *,
    time_col: str = "TransactionDT",
    id_col: str = "TransactionID",
    train_frac: float = TRAIN_FRAC,
    test_frac: float = TEST_FRAC,
    cuts: SplitCuts | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(train, test, stream)``: three disjoint filters whose union is ``df``."""
    cuts = cuts or split_cuts(
        df, time_col=time_col, id_col=id_col, train_frac=train_frac, test_frac=test_frac
    )
    in_train = _key_at_or_before(time_col, id_col, cuts.key_test)
    in_first_two = _key_at_or_before(time_col, id_col, cuts.key_stream)
    # a predicate that is NULL for a row doesn't hold, so its negation does
    after = lambda pred: ~F.coalesce(pred, F.lit(False))
    return (
        df.filter(in_train),
        df.filter(after(in_train) & in_first_two),
        df.filter(after(in_first_two)),
    )


def split_summary(df: DataFrame, *, time_col: str = "TransactionDT", label_col: str = "isFraud") -> DataFrame:
    """Per slice: rows, first/last time and label rate (input has ``slice``)."""
    return df.groupBy(SLICE).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(time_col).alias("min_time"),
        F.max(time_col).alias("max_time"),
        F.round(F.avg(F.col(label_col).cast("double")), 9).alias("label_rate"),
    )


def time_series_folds(
    df: DataFrame,
    *,
    n_splits: int = 5,
    time_col: str = "TransactionDT",
    id_col: str = "TransactionID",
) -> DataFrame:
    """M9 expanding-window folds from global ``(time, id)`` ranks.

    With ``n`` rows and ``size = n // (n_splits + 1)``, fold ``f`` (0-based)
    trains on ranks ``1 .. s_f`` with ``s_f = n - (n_splits - f) * size`` and
    tests on ranks ``s_f + 1 .. s_f + size``. Counts follow from ``n``; the
    time bounds are the times at those boundary ranks, looked up with the
    shared rank primitive (only the buckets holding them are sorted).
    Returns one row per (fold, role).
    """
    if n_splits < 2:
        raise ValueError("n_splits must be at least 2")
    keys = df.select(time_col, id_col)

    def boundaries(n: int) -> list[int]:
        size = n // (n_splits + 1)
        out = [1]
        for f in range(n_splits):
            s = n - (n_splits - f) * size
            out += [s, s + 1, s + size]
        return out

    n, found = rows_at_ranks(keys, [time_col, id_col], boundaries)
    size = n // (n_splits + 1)
    if size == 0:
        raise ValueError(f"too few rows ({n}) for {n_splits} folds")
    t = {r: row[time_col] for r, row in found.items()}
    rows = []
    for f in range(n_splits):
        s = n - (n_splits - f) * size
        rows.append((f, "train", s, t[1], t[s]))
        rows.append((f, "test", size, t[s + 1], t[s + size]))
    schema = f"fold int, role string, n_rows long, min_time {keys.schema[time_col].dataType.simpleString()}, max_time {keys.schema[time_col].dataType.simpleString()}"
    return df.sparkSession.createDataFrame(rows, schema)
