"""Registered queries of the model operators: fits, encodings, gates, saved models.

A fitted model has no SQL form, so a query that fits writes the table it scored
and derives its figures a second time from that table, by another path than the
operator's: the ROC area by Spark ML's evaluator, costs by plain SQL. The
oracle states the row counts and that the figures agree.
"""

from __future__ import annotations

import json

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.errors import ContractError, SeedContractError
from vigil.operators import contract, discriminant, encoding, foreign, models, promote, store
from vigil.plans import catalog, training
from vigil.plans.catalog import register
from vigil.plans.sql import CHAMPION_SQL, SLICED_CTE, TX_CTE
from vigil.session import work_path
from vigil.sources import io
from vigil.sources import testdata as td

#: Fits of the registered queries are small; what they check doesn't depend on the size.
SMALL = {"maxIter": 8, "maxDepth": 3}


def area(scored: DataFrame, score: str = "score") -> float:
    """ROC area of every distinct score as a threshold, by Spark ML."""
    rows = scored.select(F.col(td.LABEL).cast("double").alias("label"), F.col(score).alias("rawPrediction"))
    return BinaryClassificationEvaluator(numBins=0).evaluate(rows)


def costs(scored: DataFrame, thresholds: list[float]) -> list[float]:
    """Expected cost at each threshold, by SQL over the scored table."""
    each = ", ".join(
        f"CAST(sum(CASE WHEN {td.LABEL} = 1 AND score < {t!r}D THEN 10 WHEN {td.LABEL} = 0 AND score >= {t!r}D THEN 1 ELSE 0 END) AS DOUBLE)"
        for t in thresholds
    )
    return list(scored.sparkSession.sql(f"SELECT {each} FROM {{rows}}", rows=scored).first())


def summary(spark: SparkSession, trained: training.TrainedModel) -> DataFrame:
    """Slice sizes, and whether AUC, threshold and cost agree with the scored table."""
    grid = trained.scored.select(F.percentile("score", F.lit([i / 40 for i in range(41)]))).first()[0]
    at, *others = costs(trained.scored, [trained.threshold, *sorted(set(grid))])
    row = (
        trained.n_train, trained.n_test, trained.n_stream, trained.scored.count(),
        abs(area(trained.scored) - trained.test_auc) < 1e-9, abs(at - trained.expected_cost) < 1e-9, min(others) >= at, trained.test_auc > 0.5,
    )
    return spark.createDataFrame(
        [row],
        "n_train long, n_test long, n_stream long, n_scored long, auc_agrees boolean, cost_agrees boolean, "
        "no_cheaper_threshold boolean, better_than_chance boolean",
    )


_AGREES = "true AS auc_agrees, true AS cost_agrees, true AS no_cheaper_threshold, true AS better_than_chance"


@register(
    "m3_seed_champion",
    f"""WITH {SLICED_CTE}, c AS (
  SELECT count(*) FILTER (slice = 'train') AS n_train, count(*) FILTER (slice = 'test') AS n_test, count(*) FILTER (slice = 'stream') AS n_stream FROM sliced)
SELECT n_train, n_test, n_stream, n_test AS n_scored, {_AGREES} FROM c""",
)
def q_seed(spark: SparkSession, sf: str) -> DataFrame:
    trained = training.seed_champion(
        catalog.tx(spark, sf), td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES, model_path=work_path(spark, "seed")
    )
    return summary(spark, trained)


@register(
    "m4_challenger",
    f"""WITH {catalog._CORPUS_CTE}, n AS (SELECT count(*) AS n FROM corpus), s AS (
  SELECT CAST(round_even(n * 0.7, 0) AS BIGINT) AS a, CAST(round_even(n * (0.7 + 0.15), 0) AS BIGINT) AS b, n FROM n)
SELECT a AS n_train, b - a AS n_test, n - b AS n_stream, b - a AS n_scored, {_AGREES} FROM s""",
)
def q_challenger(spark: SparkSession, sf: str) -> DataFrame:
    c, _test, _stream = catalog._corpus(spark, sf)
    return summary(spark, training.train_challenger(c, td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES))


_KINDS = ("logreg", "svc", "lda", "rf", "gbt")


@register(
    "m11_baselines",
    f"""WITH {SLICED_CTE}, v AS (
  SELECT count(*) FILTER (isFraud = 1) AS n_pos, count(*) FILTER (isFraud = 0) AS n_neg FROM sliced WHERE slice = 'test')
SELECT unnest({list(_KINDS)}) AS model, n_pos, n_neg, true AS auc_agrees, true AS better_than_chance FROM v""",
)
def q_baselines(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.operators.evaluate import auc_frame
    from vigil.session import written

    s = catalog.sliced(spark, sf)
    train, valid = s.filter("slice = 'train'"), s.filter("slice = 'test'")
    scored = written(models.baseline_scores(train, valid, td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES, kinds=_KINDS), "baselines")
    found = {r["model"]: r["auc"] for r in auc_frame(scored, label_col=td.LABEL, by=["model"]).collect()}  # five rows
    again = spark.createDataFrame(
        [(k, abs(area(scored.filter(F.col("model") == k)) - found[k]) < 1e-9, found[k] > 0.5) for k in _KINDS],
        "model string, auc_agrees boolean, better_than_chance boolean",
    )
    counts = scored.groupBy("model").agg(F.count_if(F.col(td.LABEL) == 1).alias("n_pos"), F.count_if(F.col(td.LABEL) == 0).alias("n_neg"))
    return counts.join(again, "model")


@register(
    "m11_discriminant_moments",
    f"""WITH {SLICED_CTE}, r AS (
  SELECT isFraud AS y, CAST(amount AS DOUBLE) AS a, CAST(k AS DOUBLE) AS b FROM sliced WHERE slice = 'train' AND amount IS NOT NULL AND k IS NOT NULL
), c AS (
  SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) * count(*) AS saa, covar_pop(a, b) * count(*) AS sab, var_pop(b) * count(*) AS sbb FROM r GROUP BY y
), p AS (SELECT sum(saa) / (sum(n) - 2) AS caa, sum(sab) / (sum(n) - 2) AS cab, sum(sbb) / (sum(n) - 2) AS cbb FROM c)
SELECT y AS label, n AS n_rows, round(ma, 6) AS mean_a, round(mb, 6) AS mean_b, round(caa, 5) AS var_a, round(cab, 5) AS cov_ab, round(cbb, 5) AS var_b FROM c, p""",
)
def q_discriminant_moments(spark: SparkSession, sf: str) -> DataFrame:
    """Class means and pooled covariance of the discriminant, from its one Gram matrix."""
    from pyspark.ml.feature import VectorAssembler

    rows = catalog.sliced(spark, sf).filter("slice = 'train'").select(td.LABEL, F.col("amount").cast("double"), F.col("k").cast("double")).na.drop()
    n, means, cov = discriminant.scatter(VectorAssembler(inputCols=["amount", "k"], outputCol="x").transform(rows), "x", td.LABEL)
    told = [(y, int(n[y]), *[round(float(v), 6) for v in means[y]], *[round(float(v), 5) for v in (cov[0, 0], cov[0, 1], cov[1, 1])]) for y in (0, 1)]
    return spark.createDataFrame(told, "label int, n_rows long, mean_a double, mean_b double, var_a double, cov_ab double, var_b double")


@register(
    "m11_discriminant_scores",
    f"""WITH {SLICED_CTE}, r AS (
  SELECT TransactionID, slice, isFraud AS y, CAST(amount AS DOUBLE) AS a, CAST(k AS DOUBLE) AS b FROM sliced WHERE amount IS NOT NULL AND k IS NOT NULL
), c AS (
  SELECT y, count(*) AS n, avg(a) AS ma, avg(b) AS mb, var_pop(a) * count(*) AS saa, covar_pop(a, b) * count(*) AS sab, var_pop(b) * count(*) AS sbb
  FROM r WHERE slice = 'train' GROUP BY y
), p AS (SELECT sum(saa) / (sum(n) - 2) AS caa, sum(sab) / (sum(n) - 2) AS cab, sum(sbb) / (sum(n) - 2) AS cbb FROM c
), w AS (
  SELECT (cbb * (x.ma - z.ma) - cab * (x.mb - z.mb)) / (caa * cbb - cab * cab) AS wa, (caa * (x.mb - z.mb) - cab * (x.ma - z.ma)) / (caa * cbb - cab * cab) AS wb,
         ln(x.n / CAST(z.n AS DOUBLE)) AS odds, (x.ma + z.ma) / 2 AS ca, (x.mb + z.mb) / 2 AS cb
  FROM p, (SELECT * FROM c WHERE y = 1) x, (SELECT * FROM c WHERE y = 0) z
)
SELECT TransactionID, round(1 / (1 + exp(-(odds + wa * (a - ca) + wb * (b - cb)))), 6) AS score FROM r, w WHERE slice = 'stream'""",
)
def q_discriminant_scores(spark: SparkSession, sf: str) -> DataFrame:
    """The discriminant of two features, fitted on train, scoring the stream."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array

    rows = catalog.sliced(spark, sf).select(td.ID, "slice", td.LABEL, F.col("amount").cast("double"), F.col("k").cast("double")).na.drop()
    rows = VectorAssembler(inputCols=["amount", "k"], outputCol="x").transform(rows)
    model = discriminant.LinearDiscriminant(featuresCol="x", labelCol=td.LABEL).fit(rows.filter("slice = 'train'"))
    scored = model.transform(rows.filter("slice = 'stream'"))
    return scored.select(td.ID, F.round(vector_to_array("probability")[1], 6).alias("score"))


@register(
    "m1_target_statistics",
    f"""WITH {SLICED_CTE}, r AS (
  SELECT TransactionID, TransactionDT, isFraud, slice, coalesce(CAST(user_id AS VARCHAR), 'missing') AS u, coalesce(CAST(amount AS VARCHAR), 'missing') AS m FROM sliced
), p AS (SELECT avg(CAST(isFraud AS DOUBLE)) AS prior FROM r WHERE slice = 'train'
), o AS (
  SELECT TransactionID, slice,
         (coalesce(sum(isFraud) OVER u, 0) + 10 * prior) / (count(*) OVER u + 10) AS user_te,
         (coalesce(sum(isFraud) OVER m, 0) + 10 * prior) / (count(*) OVER m + 10) AS amount_te
  FROM r, p WHERE slice = 'train'
  WINDOW u AS (PARTITION BY u ORDER BY TransactionDT, TransactionID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         m AS (PARTITION BY m ORDER BY TransactionDT, TransactionID ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), lu AS (SELECT u, (sum(isFraud) + 10 * any_value(prior)) / (count(*) + 10) AS e FROM r, p WHERE slice = 'train' GROUP BY u
), lm AS (SELECT m, (sum(isFraud) + 10 * any_value(prior)) / (count(*) + 10) AS e FROM r, p WHERE slice = 'train' GROUP BY m)
SELECT TransactionID, slice, round(user_te, 9) AS user_te, round(amount_te, 9) AS amount_te FROM o
UNION ALL
SELECT TransactionID, slice, round(coalesce(lu.e, prior), 9), round(coalesce(lm.e, prior), 9)
FROM r CROSS JOIN p LEFT JOIN lu USING (u) LEFT JOIN lm USING (m) WHERE slice = 'stream'""",
)
def q_target_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered statistics of train rows and final ones of stream rows, for ids and for a level per row."""
    s = catalog.sliced(spark, sf).select(td.ID, td.TIME, td.LABEL, "slice", "user_id", F.col("amount").cast("string").alias("amount"))
    train = s.filter("slice = 'train'")
    encoder = encoding.TargetEncoder.fit(train, ["user_id", "amount"])
    ordered = train
    for c in ("user_id", "amount"):
        ordered = encoding.ordered_statistic(ordered, c, [td.TIME, td.ID], prior=encoder.prior)
    columns = [td.ID, "slice", F.round("user_id__te", 9).alias("user_te"), F.round("amount__te", 9).alias("amount_te")]
    return ordered.select(*columns).unionByName(encoder.transform(s.filter("slice = 'stream'")).select(*columns))


@register(
    "m9_time_series_cv",
    f"""WITH {TX_CTE}, n AS (SELECT count(*) AS n FROM tx), f AS (
  SELECT unnest(range(0, 5)) AS fold, n, n // 6 AS size FROM n), s AS (SELECT fold, size, n - (5 - fold) * size AS a FROM f),
d AS (SELECT unnest(range(0, 2)) AS draw)
SELECT CAST(draw AS INTEGER) AS draw, CAST(fold AS INTEGER) AS fold, a AS n_train, greatest(1, a - CAST(floor(a * 0.2) AS BIGINT)) AS n_fitted,
       size AS n_test, size AS n_scored, true AS mean_agrees, true AS best_agrees FROM s, d""",
)
def q_time_series_cv(spark: SparkSession, sf: str) -> DataFrame:
    """Five expanding folds and two random draws, fitted side by side with early stopping."""
    cv = training.cross_validate(
        catalog.tx(spark, sf), td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES,
        param_space={"maxDepth": [2, 3], "maxIter": [6, 8], "stepSize": [0.1, 0.3]}, n_draws=2, n_splits=5,
    )
    told = {r["draw"]: r for r in cv.per_draw.collect()}  # one row per draw
    means = {}
    for draw in told:
        areas = [area(cv.scored.filter((F.col("draw") == draw) & (F.col("fold") == f))) for f in range(5)]
        means[draw] = sum(areas) / len(areas)
    best = min(means, key=lambda d: (-round(means[d], 9), d))
    checks = spark.createDataFrame(
        [(d, abs(means[d] - r["mean_auc"]) < 1e-9 and r["folds"] == 5, r["best"] == (d == best)) for d, r in told.items()],
        "draw int, mean_agrees boolean, best_agrees boolean",
    )
    scored = cv.scored.groupBy("draw", "fold").agg(F.count(F.lit(1)).alias("n_scored"))
    return scored.join(cv.folds, "fold").join(checks, "draw").select("draw", "fold", "n_train", "n_fitted", "n_test", "n_scored", "mean_agrees", "best_agrees")


_FLOW_CTE = catalog._CORPUS_CTE + """, n AS (
  SELECT (SELECT count(*) FROM store) AS store_rows, (SELECT count(*) FROM corpus) AS corpus_size, (SELECT count(*) FROM sliced WHERE slice = 'test') AS test_size
)"""


@register(
    "m13_retraining_pass",
    f"""WITH {_FLOW_CTE}
SELECT store_rows >= 200 AS retrain, store_rows AS volume_since_last, if(store_rows >= 200, corpus_size, 0) AS corpus_size,
       if(store_rows >= 200, test_size, 0) AS shared_test_size, if(store_rows >= 200, test_size, 0) AS n_paired,
       true AS aucs_agree, true AS gate_agrees, false AS again_retrain, if(store_rows >= 200, 0, store_rows) AS again_volume FROM n""",
)
def q_retraining_pass(spark: SparkSession, sf: str) -> DataFrame:
    """Trigger to checkpoint, then the same pass again: nothing new, nothing done.

    A store too small to trigger gives the no-op pass twice, and its volume stays.
    """
    t = catalog.tx(spark, sf)
    seed = training.seed_champion(t, td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES, params=SMALL)
    store_path, state, served = (work_path(spark, n) for n in ("retrain-store", "retrain-state", "served"))
    store.append_scores(catalog.scored_store(spark, sf), store_path)
    how = {"served_path": served, "volume_threshold": 200, "reveal_lag": catalog._LAG, "params": SMALL}
    out = training.retraining_pass(t, seed.model, seed.contract, store_path, state, **how)
    again = training.retraining_pass(t, seed.model, seed.contract, store_path, state, **how)
    d, published = out.decision, bool(models._pointers(spark, served))
    aucs, gate, n_paired = True, out.promoted == published, 0
    if d:
        aucs = all(abs(area(out.paired, m) - d[f"auc_{m}"]) < 1e-9 for m in ("champion", "challenger"))
        gate = out.promoted == (d["p_value"] <= promote.DEFAULT_ALPHA) == published
        n_paired = out.paired.count()
    row = (
        out.trigger.retrain, out.trigger.volume_since_last, out.corpus_size, out.shared_test_size, n_paired, aucs, gate,
        again.trigger.retrain, again.trigger.volume_since_last,
    )
    return spark.createDataFrame(
        [row],
        "retrain boolean, volume_since_last long, corpus_size long, shared_test_size long, n_paired long, aucs_agree boolean, "
        "gate_agrees boolean, again_retrain boolean, again_volume long",
    )


@register(
    "m12_alarm_to_retraining",
    f"""WITH {_FLOW_CTE}, c AS (SELECT count(*) AS k FROM sliced WHERE slice = 'stream')
SELECT true AS alarm, true AS triggered_retraining, true AS retrain, true AS drift_triggered, false AS volume_triggered,
       k AS volume_since_last, corpus_size, test_size AS n_paired, k AS checkpoint_rows FROM n, c""",
)
def q_alarm_to_retraining(spark: SparkSession, sf: str) -> DataFrame:
    """A monitoring pass whose alarm starts the retraining pass, in one flow over one store."""
    from vigil.operators import trigger
    from vigil.plans import monitoring

    t = catalog.tx(spark, sf)
    seed = training.seed_champion(t, td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES, params=SMALL)
    store_path, state = work_path(spark, "flow-store"), work_path(spark, "flow-state")
    done: list = []

    def retrain() -> None:
        done.append(
            training.retraining_pass(
                t, seed.model, seed.contract, store_path, state, volume_threshold=10**12, drift_alarm=True, reveal_lag=catalog._LAG, params=SMALL
            )
        )

    out = monitoring.monitoring_pass(t, catalog._champion_boundary(), store_path, on_alarm=retrain, cuts=catalog.cuts(spark, sf))
    # without an alarm no retraining pass runs, and its columns are null
    retrained = [None] * 6
    for p in done:
        trig = p.trigger
        retrained = [trig.retrain, trig.drift_triggered, trig.volume_triggered, trig.volume_since_last, p.corpus_size, p.paired.count()]
    row = (
        out.decision["alarm"], out.triggered_retraining, *retrained, trigger.last_store_row_count(trigger.read_state(spark, state)),
    )
    return spark.createDataFrame(
        [row],
        "alarm boolean, triggered_retraining boolean, retrain boolean, drift_triggered boolean, volume_triggered boolean, "
        "volume_since_last long, corpus_size long, n_paired long, checkpoint_rows long",
    )


@register(
    "s10_publish_and_load",
    f"""WITH {SLICED_CTE}
SELECT 'seed' AS before_publishing, 'served' AS after_publishing, count(*) AS n_scored, 0 AS n_changed, CAST(0.25 AS DOUBLE) AS threshold,
       true AS newest_wins FROM sliced WHERE slice = 'stream'""",
)
def q_publish_and_load(spark: SparkSession, sf: str) -> DataFrame:
    """Seed and served models: resolved, published twice, loaded, and scoring as before they were saved."""
    s = catalog.sliced(spark, sf)
    train, stream = s.filter("slice = 'train'"), s.filter("slice = 'stream'")
    features, cats = td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES
    numeric = [c for c in features if c not in cats]
    paths = {work_path(spark, n): n for n in ("seed", "served")}
    seed_path, served_path = paths
    first, second = (models.fit(train, features, cats, kind="gbt", **{**SMALL, "maxIter": n}) for n in (2, 6))
    models.save_model(spark, first, contract.Contract(features, cats, 0.5), seed_path)
    before = models.resolve_model(spark, served_path, seed_path)
    for model, threshold in ((first, 0.75), (second, 0.25)):
        models.save_model(spark, model, contract.Contract(features, cats, threshold), served_path)
    after = models.resolve_model(spark, served_path, seed_path)
    loaded, loaded_contract = models.load_model(spark, after)
    told = models.score_frame(second, stream.select(td.ID, *features), numeric, cats).withColumnRenamed("score", "told")
    both = models.score_frame(loaded, told, numeric, cats)
    counts = both.agg(F.count(F.lit(1)).alias("n_scored"), F.count_if(F.abs(F.col("score") - F.col("told")) > 1e-12).alias("n_changed"))
    return counts.select(
        F.lit(paths[before]).alias("before_publishing"), F.lit(paths[after]).alias("after_publishing"), "n_scored", "n_changed",
        F.lit(loaded_contract.threshold).alias("threshold"), F.lit(loaded_contract.threshold == 0.25).alias("newest_wins"),
    )


@register(
    "v5_relaxed_mode",
    f"""WITH {TX_CTE}, r AS (SELECT {' OR '.join(catalog._missing_sql(c) for c in td.CONTRACT_FEATURES)} AS hole, k IS NULL AS unscored FROM tx)
SELECT count(*) AS n_scored, count(*) FILTER (hole) AS n_incomplete, count(*) FILTER (hole AND NOT unscored) > 0 AS holes_scored,
       true AS strict_refuses, true AS text_refused, true AS surplus_refused FROM r""",
)
def q_relaxed_mode(spark: SparkSession, sf: str) -> DataFrame:
    """Relaxed mode scores rows with holes; every other check of the contract still applies."""
    frame = catalog.tx(spark, sf).select(*td.CONTRACT_FEATURES)
    relaxed, strict = (catalog._champion_boundary(require_complete=c) for c in (False, True))

    def refuses(boundary, df: DataFrame) -> bool:
        try:
            boundary.score(df)
        except ContractError:
            return True
        return False

    scored = relaxed.score(frame, keep=list(td.CONTRACT_FEATURES))
    hole = F.lit(False)
    for c in td.CONTRACT_FEATURES:
        hole = hole | contract.is_missing(scored, c)
    counts = scored.agg(
        F.count(F.lit(1)).alias("n_scored"), F.count_if(hole).alias("n_incomplete"), F.count_if(hole & F.col("score").isNotNull()).alias("with_score")
    )
    return counts.select(
        "n_scored", "n_incomplete", (F.col("with_score") > 0).alias("holes_scored"),
        F.lit(refuses(strict, frame)).alias("strict_refuses"),
        F.lit(refuses(relaxed, frame.withColumn("amount", F.col("amount").cast("string")))).alias("text_refused"),
        F.lit(refuses(relaxed, frame.withColumn("surplus", F.lit(1)))).alias("surplus_refused"),
    )


@register(
    "v9_seed_contract",
    f"""WITH {TX_CTE}
SELECT count(*) AS n_rows, {len(td.CONTRACT_FEATURES)} AS n_features, {len(td.CATEGORICAL_FEATURES)} AS n_categoricals, true AS holds,
       true AS shape_refused, true AS range_refused, true AS threshold_refused FROM tx""",
)
def q_seed_contract(spark: SparkSession, sf: str) -> DataFrame:
    """The seed contract's check over the whole table, and three contracts that it refuses."""
    frame = catalog.tx(spark, sf)
    good = catalog._champion_boundary()
    shape = {"expected_features": len(td.CONTRACT_FEATURES), "expected_categoricals": len(td.CATEGORICAL_FEATURES)}

    def refuses(boundary, **how) -> bool:
        try:
            contract.check_seed_contract(boundary, frame, **how)
        except SeedContractError:
            return True
        return False

    c = contract.check_seed_contract(good, frame, **shape)
    wide = contract.ScoringBoundary(lambda df: td.champion_score() * 2, good.contract, require_complete=False)
    loose = contract.ScoringBoundary(good.scorer, contract.Contract(c.feature_columns, c.categorical_columns, 1.0), require_complete=False)
    row = [len(c.feature_columns), len(c.categorical_columns), c == good.contract, refuses(good, expected_features=1), refuses(wide), refuses(loose)]
    names = ["n_features", "n_categoricals", "holds", "shape_refused", "range_refused", "threshold_refused"]
    return frame.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", *[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)])


def _load_weights(artifact: bytes) -> dict:
    return json.loads(artifact)


def _predict_linear(weights: dict, batch):
    import pyarrow.compute as pc

    total = pc.cast(batch.column("k"), "double")
    for level, w in weights["levels"].items():
        total = pc.add(total, pc.multiply(pc.cast(pc.fill_null(pc.equal(batch.column("cat_a"), level), False), "double"), w))
    return pc.divide(total, weights["scale"])


@register(
    "m2_foreign_scorer",
    f"""WITH {SLICED_CTE}
SELECT TransactionID, {CHAMPION_SQL} AS score, CASE WHEN {CHAMPION_SQL} >= 0.5 THEN 'block' ELSE 'allow' END AS decision FROM sliced""",
)
def q_foreign_scorer(spark: SparkSession, sf: str) -> DataFrame:
    """A linear model that Spark doesn't know, loaded from its artifact in the workers."""
    artifact = json.dumps({"levels": {"error": 28.0}, "scale": 128.0}).encode()
    scorer = foreign.ForeignScorer(artifact, _load_weights, _predict_linear, ("k", "cat_a"))
    boundary = contract.ScoringBoundary(scorer, catalog._champion_boundary().contract, require_complete=False)
    rows = catalog.sliced(spark, sf).select(td.ID, *td.CONTRACT_FEATURES)
    return boundary.score(rows, keep=[td.ID]).select(td.ID, "score", "decision")


_PAYLOAD = """CASE WHEN event_id % 11 = 0 THEN left(props, length(props) - 1)
       WHEN event_id % 11 = 1 THEN '[1]'
       WHEN event_id % 11 = 2 THEN '{"k": "many", "z": 1, "a": null}'
       WHEN event_id % 11 = 3 THEN '{"other": 2.5}'
       WHEN event_id % 11 = 4 THEN NULL
       WHEN event_id % 11 = 5 THEN '{"k": null, "w": 1.5}'
       WHEN event_id % 11 = 6 THEN '{"k": 7, "w": true}' ELSE props END"""


@register(
    "s7_payload_findings",
    f"""WITH p AS (SELECT event_id, {_PAYLOAD} AS t FROM events),
v AS (SELECT event_id, t, coalesce(CASE WHEN json_valid(t) THEN json_type(t) = 'OBJECT' END, false) AS ok FROM p),
j AS (SELECT event_id, t, CASE WHEN ok THEN t END AS o, t IS NOT NULL AND NOT ok AS malformed FROM v),
x AS (
  SELECT event_id, malformed, o, coalesce(json_type(o, '$.k'), 'NULL') AS tk, coalesce(json_type(o, '$.w'), 'NULL') AS tw,
         TRY_CAST(json_extract_string(o, '$.k') AS INTEGER) AS k, CASE WHEN json_type(o, '$.w') <> 'BOOLEAN' THEN TRY_CAST(json_extract_string(o, '$.w') AS DOUBLE) WHEN json_extract_string(o, '$.w') = 'true' THEN 1.0 END AS w
  FROM j)
SELECT event_id, k, w, malformed,
       concat_ws('; ', CASE WHEN tk = 'NULL' THEN 'k' END, CASE WHEN tw = 'NULL' THEN 'w' END) AS missing_keys,
       coalesce(array_to_string(list_sort(list_filter(json_keys(o), lambda x: x <> 'k' AND x <> 'w')), '; '), '') AS unknown_keys,
       concat_ws('; ', CASE WHEN tk <> 'NULL' AND k IS NULL THEN 'k' END, CASE WHEN tw <> 'NULL' AND w IS NULL THEN 'w' END) AS bad_values
FROM x""",
)
def q_payload_findings(spark: SparkSession, sf: str) -> DataFrame:
    """Malformed, missing, extra and wrongly typed payloads, found in one parse."""
    ev = td.table(spark, sf, "events").select("event_id", F.expr(_PAYLOAD).alias("payload"))
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("w", T.DoubleType())])
    return io.json_findings(ev, "payload", schema, keep=["event_id"])
