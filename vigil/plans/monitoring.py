"""The monitoring pass, as lazily built DataFrames with few actions.

1. chronological split (W1); 2. score the next unseen chunk of the stream
slice (L2) and append it to the store (S5); 3. reference half (M6); 4. current
window (M7) against all features; 5. drift metrics + alarm (M8), or the
no-drift report for an empty window (A14); 6. on alarm, the retrain trigger.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame

from vigil.operators import drift, split, store, window
from vigil.operators.contract import ScoringBoundary
from vigil.session import written
from vigil.sources.io import write_report_json


def drift_pass(
    reference: DataFrame,
    current: DataFrame,
    feature_columns: Sequence[str],
    *,
    thresholds: drift.DriftThresholds = drift.DriftThresholds(),
) -> tuple[DataFrame, DataFrame]:
    """``(metrics, decision)``; an empty current window reports no drift."""
    if current.isEmpty():
        metrics = drift.no_drift_metrics(reference.sparkSession, feature_columns)
    else:
        metrics = drift.compute_drift(reference, current, feature_columns=feature_columns)
    return metrics, drift.decide_drift(metrics, thresholds)


@dataclass(frozen=True)
class MonitoringOutcome:
    metrics: DataFrame
    decision: dict
    n_scored: int
    n_current: int
    n_reference: int
    triggered_retraining: bool


def monitoring_pass(
    transactions: DataFrame,
    boundary: ScoringBoundary,
    store_path: str,
    *,
    chunk_rows: int | None = None,
    window_rows: int | None = None,
    window_days: float | None = None,
    reference: DataFrame | None = None,
    reference_max_rows: int | None = None,
    thresholds: drift.DriftThresholds = drift.DriftThresholds(),
    now: float | None = None,
    id_col: str = "TransactionID",
    time_col: str = "TransactionDT",
    cuts: split.SplitCuts | None = None,
    report_path: str | None = None,
    on_alarm: Callable[[], object] | None = None,
) -> MonitoringOutcome:
    """One scheduled pass; returns the metrics, the decision row and counts.

    Both halves and the metrics are written once and read from there. The
    metrics are saved as JSON to ``report_path``; ``on_alarm`` starts the
    retraining pass and runs only if the decision is an alarm.
    """
    spark = transactions.sparkSession
    features = list(boundary.contract.feature_columns)
    train, _test, stream = split.temporal_split(transactions, time_col=time_col, id_col=id_col, cuts=cuts)
    current_store = store.read_store(spark, store_path)
    if chunk_rows is None:  # all rows not scored yet
        chunk = store.unseen_rows(stream, current_store, id_col=id_col)
    else:
        chunk = store.next_chunk(stream, current_store, chunk_rows, time_col=time_col, id_col=id_col)
    scored = boundary.score(chunk.select(id_col, *features), keep=[id_col], validate_rows=False)
    n_scored = store.append_scores(scored, store_path)
    if reference is None:
        reference = window.build_reference(
            train.select(id_col, *features),
            lambda f: _score_rows(boundary, f, features, id_col),
            max_rows=reference_max_rows,
            id_col=id_col,
        ).select(*features, "score")
    current = window.current_window(
        store.read_store(spark, store_path),
        transactions,
        features,
        window_rows=window_rows,
        window_days=window_days,
        now=now,
        id_col=id_col,
        time_col=time_col,
    )
    reference, current = written(reference, "reference"), written(current, "current")
    metrics, _ = drift_pass(reference, current, features, thresholds=thresholds)
    metrics = written(metrics, "metrics")
    decision = drift.decide_drift(metrics, thresholds).collect()[0].asDict()
    if report_path is not None:
        write_report_json(metrics, report_path)
    retrain = bool(decision["alarm"]) and on_alarm is not None
    if retrain:
        on_alarm()
    return MonitoringOutcome(metrics, decision, n_scored, current.count(), reference.count(), retrain)


def _score_rows(boundary: ScoringBoundary, frame: DataFrame, features: Sequence[str], id_col: str) -> DataFrame:
    """Features plus the boundary's score, on the same rows (no join)."""
    scored = boundary.score(frame.select(id_col, *features), keep=[id_col, *features], validate_rows=False)
    return scored.drop("decision", "threshold")
