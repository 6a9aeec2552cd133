"""M3 seed champion, M4 challenger, M13 retraining pass, M9 time-series CV.

Every step is a Spark job: the chronological split (W1) gives the slices,
Spark ML fits and scores, the exact AUC / cost threshold (A4-A7) and the
DeLong gate (A15/A16) evaluate, and the model plus contract is written to the
cluster file system (S10). The retrain checkpoint row is written last, so a
failed pass is simply retried.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import timedelta
from multiprocessing.pool import ThreadPool

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from vigil.functions.ordered import at_or_before, rows_at_ranks
from vigil.operators import corpus, evaluate, leaderboard, models, promote, split, store, trigger
from vigil.operators.contract import Contract, ScoringBoundary
from vigil.session import work_path, written


@dataclass(frozen=True)
class TrainedModel:
    model: PipelineModel
    contract: Contract
    test_auc: float
    threshold: float
    expected_cost: float
    n_train: int
    n_test: int
    n_stream: int
    #: The test slice's labels and scores, as written.
    scored: DataFrame | None = None


def _fit_and_evaluate(
    frame: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    *,
    cost_ratio: float,
    label_col: str,
    kind: str,
    params: dict,
) -> TrainedModel:
    train, test, stream = split.temporal_split(frame)
    model = models.fit(train, features, categorical, label_col=label_col, kind=kind, **params)
    numeric = [c for c in features if c not in set(categorical)]
    scored = models.score_frame(model, test.select(label_col, *features), numeric, categorical)
    scored = written(scored.select(label_col, "score"), "test-scores")
    auc = evaluate.auc(scored, label_col=label_col)
    threshold = evaluate.operating_threshold(scored, cost_ratio=cost_ratio, label_col=label_col)
    cost = evaluate.expected_cost(scored, threshold, cost_ratio=cost_ratio, label_col=label_col)
    sizes = (
        train.select(F.lit("train").alias("p"))
        .unionByName(test.select(F.lit("test").alias("p")))
        .unionByName(stream.select(F.lit("stream").alias("p")))
        .groupBy("p")
        .count()
        .collect()
    )
    n = {r["p"]: r["count"] for r in sizes}
    contract = Contract(tuple(features), tuple(categorical), float(threshold))
    return TrainedModel(model, contract, auc, threshold, cost, n.get("train", 0), n.get("test", 0), n.get("stream", 0), scored)


def seed_champion(
    transactions: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    *,
    cost_ratio: float = evaluate.DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    kind: str = "gbt",
    params: dict | None = None,
    model_path: str | None = None,
) -> TrainedModel:
    """M3: split -> fit on train -> AUC, threshold, cost on test -> save."""
    trained = _fit_and_evaluate(
        transactions, features, categorical, cost_ratio=cost_ratio, label_col=label_col, kind=kind, params=params or {}
    )
    if model_path:
        models.save_model(transactions.sparkSession, trained.model, trained.contract, model_path)
    return trained


def train_challenger(
    corpus_df: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    *,
    cost_ratio: float = evaluate.DEFAULT_COST_RATIO,
    label_col: str = "isFraud",
    kind: str = "gbt",
    params: dict | None = None,
) -> TrainedModel:
    """M4: fresh 70/15/15 split of the corpus; threshold on its own test slice."""
    return _fit_and_evaluate(
        corpus_df, features, categorical, cost_ratio=cost_ratio, label_col=label_col, kind=kind, params=params or {}
    )


def model_boundary(model: PipelineModel, contract: Contract, *, require_complete: bool = False) -> ScoringBoundary:
    scorer = models.ModelScorer(model, contract.feature_columns, contract.categorical_columns)
    return ScoringBoundary(scorer, contract, require_complete=require_complete)


@dataclass(frozen=True)
class RetrainingOutcome:
    trigger: Row
    corpus_size: int
    shared_test_size: int
    decision: Row | None
    promoted: bool
    #: The shared test slice's labels and both models' scores, as written.
    paired: DataFrame | None = None


def retraining_pass(
    transactions: DataFrame,
    champion: PipelineModel,
    champion_contract: Contract,
    store_path: str,
    state_path: str,
    *,
    served_path: str | None = None,
    volume_threshold: int = trigger.DEFAULT_VOLUME_THRESHOLD,
    drift_alarm: bool = False,
    reveal_lag: timedelta | float = corpus.DEFAULT_REVEAL_LAG,
    cost_ratio: float = evaluate.DEFAULT_COST_RATIO,
    alpha: float = promote.DEFAULT_ALPHA,
    now: float | None = None,
    label_col: str = "isFraud",
    id_col: str = "TransactionID",
    kind: str = "gbt",
    params: dict | None = None,
) -> RetrainingOutcome:
    """Trigger -> corpus -> challenger -> DeLong gate -> publish -> state."""
    spark = transactions.sparkSession
    st = store.read_store(spark, store_path)
    store_rows = store.row_count(spark, store_path)
    last = trigger.last_store_row_count(trigger.read_state(spark, state_path))
    trig = trigger.retrain_decision(
        spark, max(store_rows - last, 0), volume_threshold=volume_threshold, drift_alarm=drift_alarm
    )
    if not trig.retrain:
        return RetrainingOutcome(trig, 0, 0, None, False)
    features = list(champion_contract.feature_columns)
    categorical = list(champion_contract.categorical_columns)
    revealed, shared_test, _stream = corpus.prepare_retraining_inputs(
        transactions, st, reveal_lag=reveal_lag, now=now, id_col=id_col, label_col=label_col
    )
    # split, fit, score and count all read the corpus: write it once
    corpus_df = written(revealed, "corpus")
    challenger = train_challenger(
        corpus_df, features, categorical, cost_ratio=cost_ratio, label_col=label_col, kind=kind, params=params
    )
    numeric = [c for c in features if c not in set(categorical)]
    test = shared_test.select(label_col, *features)
    # both scores are appended to the same shared-test rows (no join back)
    a = models.score_frame(champion, test, numeric, categorical).withColumnRenamed("score", "champion")
    paired = models.score_frame(challenger.model, a, numeric, categorical).withColumnRenamed("score", "challenger")
    paired = written(paired.select(label_col, "champion", "challenger"), "paired-scores")
    decision = promote.decide_promotion(paired, label_col=label_col, alpha=alpha)
    if decision.promote and served_path:
        models.save_model(spark, challenger.model, challenger.contract, served_path)
    sizes = corpus_df.count(), shared_test.count()
    trigger.write_state(spark, state_path, store_row_count=store_rows)
    return RetrainingOutcome(trig, sizes[0], sizes[1], decision, decision.promote, paired)


@dataclass(frozen=True)
class CrossValidation:
    """Per draw the mean fold AUC and whether it is the best; ``draw, fold, label, score`` of all test rows."""

    per_draw: DataFrame
    scored: DataFrame
    #: Rows that each fold's models were fitted and stopped on.
    folds: DataFrame


def cross_validate(
    frame: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    *,
    param_space: dict[str, Sequence],
    n_draws: int = 4,
    n_splits: int = 5,
    label_col: str = "isFraud",
    time_col: str = "TransactionDT",
    id_col: str = "TransactionID",
    kind: str = "gbt",
    seed: int = 0,
    side_by_side: int = 4,
    stop_share: float = 0.2,
) -> CrossValidation:
    """M9: random parameter draws x expanding folds, as one job over cached features.

    Rows carry the first fold they are tested in (``_fold``, ranks of (time,
    id), NULL times last); fold f is fitted on the rows before it. Boosted
    trees stop early on the newest ``stop_share`` of these. All fits of all
    folds and draws run side by side, ``side_by_side`` at a time, from one
    cached frame; every fit writes its test scores, and one pass over them
    gives all fold AUCs.
    """
    rng = random.Random(seed)
    draws = [{k: rng.choice(list(v)) for k, v in param_space.items()} for _ in range(n_draws)]
    order = [time_col, id_col]

    def cut(n: int, f: int) -> int:
        return n - (n_splits - f) * (n // (n_splits + 1))

    def stop(n: int, f: int) -> int:
        return max(1, cut(n, f) - int(cut(n, f) * stop_share))

    keys = frame.select(*order)
    n, found = rows_at_ranks(keys, order, lambda n: [r for f in range(n_splits) for r in (cut(n, f), stop(n, f))])
    if n < n_splits + 1:
        raise ValueError(f"{n} rows are too few for {n_splits} folds")
    upto = lambda rank: at_or_before(order, [found[rank][c] for c in order])
    fold = F.lit(n_splits - 1)
    for f in reversed(range(n_splits)):
        fold = F.when(upto(cut(n, f)), f - 1).otherwise(fold)
    spark = frame.sparkSession
    numeric = [c for c in features if c not in set(categorical)]
    cached = frame.select(label_col, *dict.fromkeys([*order, *features]), fold.alias("_fold")).persist(StorageLevel.MEMORY_AND_DISK)
    path = work_path(spark, "cv-scores")

    def middle(f: int) -> dict[str, float | None]:
        return models.column_medians(cached.filter(F.col("_fold") < f), numeric)

    def run(job: tuple[int, int]) -> None:
        d, f = job
        params = dict(draws[d])
        train = cached.filter(F.col("_fold") < f)
        if kind == "gbt":
            train = train.withColumn("_late", ~upto(stop(n, f)))
            params["validationIndicatorCol"] = "_late"
        model = models.fit(train, features, categorical, label_col=label_col, kind=kind, medians=medians[f], **params)
        test = cached.filter(F.col("_fold") == f).select(label_col, *features)
        models.score_frame(model, test, numeric, categorical).select(label_col, "score").write.parquet(f"{path}/draw={d}/fold={f}")

    try:
        with ThreadPool(side_by_side) as pool:
            medians = pool.map(inheritable_thread_target(middle), range(n_splits), chunksize=1)  # a fold's draws share them
            pool.map(inheritable_thread_target(run), [(d, f) for d in range(n_draws) for f in range(n_splits)], chunksize=1)
        counts = cached.groupBy("_fold").agg(F.count(F.lit(1)).alias("n")).collect()
    finally:
        cached.unpersist()
    scored = spark.read.parquet(path)
    sizes = {r["_fold"]: r["n"] for r in counts}
    folds = spark.createDataFrame(
        [(f, sum(c for g, c in sizes.items() if g < f), stop(n, f), sizes.get(f, 0)) for f in range(n_splits)],
        "fold int, n_train long, n_fitted long, n_test long",
    )
    table = written(evaluate.auc_frame(scored, label_col=label_col, by=["draw", "fold"]), "cv-aucs")
    named = spark.createDataFrame([(d, str(p)) for d, p in enumerate(draws)], "draw int, params string")
    per_draw = written(
        table.groupBy("draw").agg(F.avg("auc").alias("mean_auc"), F.count(F.lit(1)).alias("folds")).join(named, "draw"), "cv-draws"
    )
    # The best draw by mean AUC (NaN-safe, ties -> earliest draw)
    best = leaderboard.best_per_group(
        per_draw.withColumn("_all", F.lit(1)), group_cols=["_all"], metric_col="mean_auc", seq_col="draw", payload=["draw"]
    ).select(F.col("draw").alias("_best"))
    told = per_draw.join(best, how="left", on=per_draw["draw"] == best["_best"]).select(
        "draw", "params", "mean_auc", "folds", F.col("_best").isNotNull().alias("best")
    )
    return CrossValidation(told, scored, folds)


def time_series_cv(frame: DataFrame, features: Sequence[str], categorical: Sequence[str], **how) -> DataFrame:
    """M9's table: ``draw, params, mean_auc, folds, best``; see ``cross_validate``."""
    return cross_validate(frame, features, categorical, **how).per_draw


__all__ = [
    "CrossValidation",
    "RetrainingOutcome",
    "TrainedModel",
    "cross_validate",
    "model_boundary",
    "retraining_pass",
    "seed_champion",
    "time_series_cv",
    "train_challenger",
]

