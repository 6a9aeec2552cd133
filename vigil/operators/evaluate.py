"""A4 exact ROC AUC, A5 expected cost, A6 cost curve, A7 operating threshold.

All four collapse the scored rows to one row per distinct score first
(``groupBy(by, score)`` with positive / negative counts — map-side partial
aggregation, so a score shared by a third of all rows becomes one row), then
run the shared ordered prefix sum over the distinct scores. Nothing is
quadratic and no single task sees all rows.

* AUC = sum over scores of ``pos * (neg_below + neg_tied / 2) / (P * N)`` —
  ties count one half, as in the rank-sum definition.
* cost(t) = ``ratio * fraud_below(t) + good_at_or_above(t)`` over the distinct
  observed scores; the operating threshold is the lowest score with minimal
  cost (ties lean toward catching fraud).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.ordered import prefix_sums

DEFAULT_COST_RATIO = 10.0


def score_counts(
    df: DataFrame, label_col: str, score_col: str, by: Sequence[str] = ()
) -> DataFrame:
    """One row per ``(by, score)``: ``pos`` (label 1) and ``neg`` (other) counts.

    A NULL or NaN score has no rank, so the aggregate raises on one.
    """
    is_pos = F.coalesce((F.col(label_col) == 1).cast("long"), F.lit(0))
    return df.groupBy(*by, checked_score(score_col).alias("score")).agg(
        F.sum(is_pos).alias("pos"),
        F.sum(1 - is_pos).alias("neg"),
    )


def checked_score(score_col: str) -> Column:
    """The score, or an error at run time where it is NULL or NaN."""
    score = F.col(score_col)
    return F.when(
        score.isNull() | F.isnan(score.cast("double")), F.raise_error(F.lit(f"{score_col} holds a NULL or NaN score"))
    ).otherwise(score)


def rejected_scores(df: DataFrame, score_cols: Sequence[str]) -> DataFrame:
    """Per score column how many rows hold no usable score."""
    bad = lambda c: F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double")))
    return df.agg(*[bad(c).alias(c) for c in score_cols]).unpivot([], list(score_cols), "scorer", "n_rejected")


def stack_scores(df: DataFrame, label_col: str, score_cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Long form ``(by..., scorer, label, score)`` so several scorers share one pass."""
    return df.select(*by, label_col, *score_cols).unpivot(
        [*by, label_col], list(score_cols), "scorer", "score"
    )


def ordered_score_curve(
    df: DataFrame,
    label_col: str,
    score_col: str,
    by: Sequence[str] = (),
) -> DataFrame:
    """Distinct scores ascending with ``cum_pos``/``cum_neg`` and group totals
    ``tot_pos``/``tot_neg``."""
    counts = score_counts(df, label_col, score_col, by)
    return prefix_sums(counts, ["score"], ["pos", "neg"], by=by, totals=True)


def auc_frame(
    df: DataFrame,
    *,
    label_col: str = "isFraud",
    score_col: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """``(by..., n_pos, n_neg, auc)``; ``auc`` is NULL when a class is absent."""
    curve = ordered_score_curve(df, label_col, score_col, by)
    credit = F.col("pos") * (F.col("cum_neg") - F.col("neg") * 0.5)
    agg = curve.groupBy(*by).agg(
        F.sum("pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
        F.sum(credit).alias("_credit"),
    )
    denom = F.col("n_pos").cast("double") * F.col("n_neg").cast("double")
    return agg.select(
        *by,
        "n_pos",
        "n_neg",
        F.when(denom > 0, F.col("_credit") / denom).alias("auc"),
    )


def auc(df: DataFrame, *, label_col: str = "isFraud", score_col: str = "score") -> float:
    """Exact ROC AUC as a float; raises when only one class is present."""
    row = auc_frame(df, label_col=label_col, score_col=score_col).collect()
    if not row or row[0]["auc"] is None:
        raise ValueError("no AUC without both a positive and a negative label")
    return float(row[0]["auc"])


def expected_cost_frame(
    df: DataFrame,
    threshold: float,
    *,
    cost_ratio: float = DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    score_col: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """``ratio * missed + blocked`` when flagging ``score >= threshold``."""
    fraud = F.col(label_col) == 1
    s = F.col(score_col)
    missed = F.sum(F.when(fraud & (s < threshold), 1).otherwise(0))
    blocked = F.sum(F.when(~fraud & (s >= threshold), 1).otherwise(0))
    return df.groupBy(*by).agg(
        missed.alias("missed"),
        blocked.alias("blocked"),
        (missed * float(cost_ratio) + blocked).alias("cost"),
    )


def expected_cost(
    df: DataFrame,
    threshold: float,
    *,
    cost_ratio: float = DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    score_col: str = "score",
) -> float:
    row = expected_cost_frame(
        df, threshold, cost_ratio=cost_ratio, label_col=label_col, score_col=score_col
    ).collect()
    return float(row[0]["cost"]) if row else 0.0


def cost_curve(
    df: DataFrame,
    *,
    cost_ratio: float = DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    score_col: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """Cost at every distinct observed score (the threshold candidates)."""
    if not cost_ratio > 0:
        raise ValueError(f"a missed positive costs more than nothing: cost_ratio {cost_ratio!r}")
    curve = ordered_score_curve(df, label_col, score_col, by)
    missed = F.col("cum_pos") - F.col("pos")  # fraud strictly below t
    blocked = F.col("tot_neg") - (F.col("cum_neg") - F.col("neg"))  # good at or above t
    return curve.select(
        *by,
        F.col("score").alias("threshold"),
        missed.alias("missed"),
        blocked.alias("blocked"),
        (missed * float(cost_ratio) + blocked).alias("cost"),
    )


def operating_threshold_frame(
    df: DataFrame,
    *,
    cost_ratio: float = DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    score_col: str = "score",
    by: Sequence[str] = (),
) -> DataFrame:
    """Lowest threshold reaching the minimal cost, per group."""
    curve = cost_curve(df, cost_ratio=cost_ratio, label_col=label_col, score_col=score_col, by=by)
    best = F.min_by(F.struct("threshold", "cost"), F.struct("cost", "threshold"))
    return curve.groupBy(*by).agg(best.alias("b")).select(
        *by, F.col("b.threshold").alias("threshold"), F.col("b.cost").alias("cost")
    )


def operating_threshold(
    df: DataFrame,
    *,
    cost_ratio: float = DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    score_col: str = "score",
) -> float:
    """The cost-optimal threshold as a float; raises on empty input."""
    rows = operating_threshold_frame(
        df, cost_ratio=cost_ratio, label_col=label_col, score_col=score_col
    ).collect()
    if not rows or rows[0]["threshold"] is None:
        raise ValueError("no scores to choose a threshold from")
    return float(rows[0]["threshold"])
