"""Properties of the chronological split and the expanding folds."""

import pytest

from vigil.operators import split

COLUMNS = "TransactionID long, TransactionDT long, isFraud int"


def rows_at(times):
    return [(i, t, i % 2) for i, t in enumerate(times)]


def slices(spark, rows, **fractions):
    parts = split.temporal_split(spark.createDataFrame(rows, COLUMNS), **fractions)
    return [sorted((r.TransactionDT, r.TransactionID) for r in p.collect()) for p in parts]


@pytest.mark.parametrize(
    ("n", "fractions", "sizes"),
    [
        (100, {}, [70, 15, 15]),  # sizes are fixed values of the split rule
        (300, {}, [210, 45, 45]),
        (1000, {}, [700, 150, 150]),
        (100, {"train_frac": 0.5, "test_frac": 0.3}, [50, 30, 20]),
    ],
)
def test_slices_are_consecutive_runs_of_the_ordered_rows(spark, n, fractions, sizes):
    rows = rows_at([(i * 37) % n for i in range(n)])  # out of order
    parts = slices(spark, rows, **fractions)
    assert [len(p) for p in parts] == sizes
    assert parts[0] + parts[1] + parts[2] == sorted((t, i) for i, t, _ in rows)


def test_equal_times_are_ordered_by_id(spark):
    rows = [(i, 10, 0) for i in (5, 3, 9, 1)]
    labelled = split.with_slice(spark.createDataFrame(rows, COLUMNS), train_frac=0.5, test_frac=0.25)
    assert {r.TransactionID: r["slice"] for r in labelled.collect()} == {1: "train", 3: "train", 5: "test", 9: "stream"}


@pytest.mark.parametrize("fractions", [(0.7, 0.3), (1.0, 0.0), (-0.1, 0.2)])
def test_shares_have_to_leave_a_stream(spark, fractions):
    with pytest.raises(ValueError, match="slice shares"):
        slices(spark, rows_at(range(10)), train_frac=fractions[0], test_frac=fractions[1])


def test_a_time_column_is_needed(spark):
    with pytest.raises(ValueError, match="TransactionDT"):
        split.temporal_split(spark.createDataFrame([(1, 0)], "TransactionID long, isFraud int"))


def test_folds_expand(spark):
    folds = split.time_series_folds(spark.createDataFrame(rows_at(range(60)), COLUMNS), n_splits=5)
    got = {(r.fold, r.role): (r.n_rows, r.min_time, r.max_time) for r in folds.collect()}
    for f in range(5):
        end = 10 * (f + 1)
        assert got[f, "train"] == (end, 0, end - 1)
        assert got[f, "test"] == (10, end, end + 9)
