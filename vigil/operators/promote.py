"""DeLong test for two correlated AUCs and the promotion gate.

No ``n_pos x n_neg`` kernel matrix: each scorer's scores collapse to one row
per distinct score with class counts, the shared ordered prefix sum gives
every row's placement value

* positive with score v: ``(neg below v + neg at v / 2) / N``
* negative with score v: ``(pos above v + pos at v / 2) / P``

and the structural-components variance of ``AUC_b - AUC_a`` reduces to
``var_samp(pp_b - pp_a) / P + var_samp(pn_b - pn_a) / N`` (each placement
mean equals the AUC), so identical scorers give exactly ``se = 0``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from vigil.functions.stats import norm_sf
from vigil.operators.evaluate import ordered_score_curve, stack_scores

DEFAULT_ALPHA = 0.05


def placements(rows: DataFrame, *, label_col: str, score_cols: Sequence[str]) -> DataFrame:
    """Per ``(scorer, distinct score)``: placement values ``pp`` and ``pn``.

    All scorers go through one ordered pass (``by = scorer``).
    """
    curve = ordered_score_curve(
        stack_scores(rows, label_col, score_cols), label_col, "score", ["scorer"]
    )
    neg_below = F.col("cum_neg") - F.col("neg")
    pos_above = F.col("tot_pos") - F.col("cum_pos")
    return curve.select(
        "scorer",
        "score",
        F.try_divide(neg_below + F.col("neg") * 0.5, F.col("tot_neg").cast("double")).alias("pp"),
        F.try_divide(pos_above + F.col("pos") * 0.5, F.col("tot_pos").cast("double")).alias("pn"),
    )


def delong_frame(
    df: DataFrame,
    *,
    label_col: str = "isFraud",
    champion_col: str = "champion",
    challenger_col: str = "challenger",
    alpha: float = DEFAULT_ALPHA,
) -> DataFrame:
    """One row: ``n_pos, n_neg, auc_champion, auc_challenger, se, z, p_value, promote``.

    One-sided test that the challenger is better; ``p = 1`` when ``se = 0`` or
    the difference is not positive; promote iff ``p <= alpha``.
    """
    if not 0 < alpha < 1:
        raise ValueError(f"alpha must be in (0, 1), got {alpha!r}")
    rows = df.select(
        (F.col(label_col) == 1).cast("int").alias("_y"),
        F.col(champion_col).cast("double").alias("_a"),
        F.col(challenger_col).cast("double").alias("_b"),
    )
    both = rows.select(F.col("_y").alias("y"), F.col("_a").alias("a"), F.col("_b").alias("b"))
    pl = placements(both, label_col="y", score_cols=["a", "b"])
    pa = pl.filter(F.col("scorer") == "a").select(
        F.col("score").alias("a_v"), F.col("pp").alias("a_pp"), F.col("pn").alias("a_pn")
    )
    pb = pl.filter(F.col("scorer") == "b").select(
        F.col("score").alias("b_v"), F.col("pp").alias("b_pp"), F.col("pn").alias("b_pn")
    )
    # equal rows collapse first, so a rounded score shared by many is one row here
    cells = rows.groupBy("_y", "_a", "_b").agg(F.count(F.lit(1)).alias("_c"))
    joined = cells.join(pa, cells["_a"] == pa["a_v"]).join(pb, cells["_b"] == pb["b_v"])
    pos, neg = F.col("_y") == 1, F.col("_y") == 0

    def total(cond: Column, value: Column) -> Column:
        return F.sum(F.when(cond, F.col("_c") * value))

    sums = joined.agg(
        F.coalesce(total(pos, F.lit(1)), F.lit(0)).alias("n_pos"),
        F.coalesce(total(neg, F.lit(1)), F.lit(0)).alias("n_neg"),
        total(pos, F.col("a_pp")).alias("_a1"),
        total(pos, F.col("b_pp")).alias("_b1"),
        *[total(c, (F.col(f"b_{k}") - F.col(f"a_{k}")) ** p).alias(f"_{k}{p}") for c, k in ((pos, "pp"), (neg, "pn")) for p in (1, 2)],
    )

    def sample_variance(k: str, n: str) -> Column:
        spread = F.col(f"_{k}2") - F.col(f"_{k}1") * F.col(f"_{k}1") / F.col(n)
        return F.try_divide(F.greatest(spread, F.lit(0.0)), F.col(n) - 1)

    agg = sums.select(
        "n_pos",
        "n_neg",
        F.try_divide("_a1", "n_pos").alias("auc_champion"),
        F.try_divide("_b1", "n_pos").alias("auc_challenger"),
        sample_variance("pp", "n_pos").alias("_v10"),
        sample_variance("pn", "n_neg").alias("_v01"),
    )
    se = F.sqrt(F.greatest(F.col("_v10") / F.col("n_pos") + F.col("_v01") / F.col("n_neg"), F.lit(0.0)))
    diff = F.col("auc_challenger") - F.col("auc_champion")
    both_classes = (F.col("n_pos") >= 1) & (F.col("n_neg") >= 1)
    enough = (F.col("n_pos") >= 2) & (F.col("n_neg") >= 2)
    checked = F.when(
        ~both_classes,
        F.raise_error(F.lit("no comparison without both a positive and a negative label")),
    ).when(~enough, F.raise_error(F.lit("no variance with fewer than two positives or two negatives")))
    out = agg.select(
        "n_pos",
        "n_neg",
        F.coalesce(checked.cast("double"), F.col("auc_champion")).alias("auc_champion"),
        "auc_challenger",
        se.alias("se"),
    ).withColumn("z", F.when(F.col("se") > 0, diff / F.col("se")))
    p = F.when((F.col("se") == 0) | (diff <= 0), F.lit(1.0)).otherwise(norm_sf(F.col("z")))
    return out.withColumn("p_value", p).withColumn("promote", F.col("p_value") <= F.lit(alpha))


def decide_promotion(df: DataFrame, **how) -> Row:
    """A16 as a value: the gate's row (``delong_frame``)."""
    return delong_frame(df, **how).first()
