"""Best row per group by a metric, ignoring NaN/NULL metrics.

Per group: the row with the highest finite metric (ties -> earliest by the
sequence column); a group with no finite metric falls back to its earliest
row. One grouped aggregate (``max_by`` / ``min_by`` with struct orderings),
partial on the map side, so a hot group never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def best_per_group(
    df: DataFrame,
    *,
    group_cols: Sequence[str],
    metric_col: str,
    seq_col: str,
    payload: Sequence[str],
) -> DataFrame:
    """``group_cols + payload`` of the chosen row, plus ``metric`` and ``fallback``."""
    m = F.col(metric_col).cast("double")
    finite = m.isNotNull() & ~F.isnan(m) & (F.abs(m) != float("inf"))
    row = F.struct(*[F.col(c) for c in payload], m.alias("_metric"))
    best = F.max_by(F.when(finite, row), F.when(finite, F.struct(m, -F.col(seq_col))))
    first = F.min_by(row, F.col(seq_col))
    agg = df.groupBy(*group_cols).agg(best.alias("_best"), first.alias("_first"))
    chosen = F.coalesce(F.col("_best"), F.col("_first"))
    return agg.select(
        *group_cols,
        *[chosen[c].alias(c) for c in payload],
        chosen["_metric"].alias("metric"),
        F.col("_best").isNull().alias("fallback"),
    )
