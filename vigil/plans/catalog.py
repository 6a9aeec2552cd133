"""Registered queries: one Spark job per operator, each with an oracle SQL twin.

Every query reads the given tables (or frames Spark derives from them) in
full. ``QUERIES`` maps a name to ``(spark, sf_dir) -> DataFrame``;
``ORACLE_SQL`` maps the same name to DuckDB SQL over the raw tables.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.operators import (
    contract,
    corpus,
    drift,
    evaluate,
    leaderboard,
    profile,
    promote,
    split,
    store,
    trigger,
    window,
)
from vigil.operators.drift_log import DriftLog
from vigil.operators.manifest import Manifest
from vigil.plans.sql import CHALLENGER_SQL, CHAMPION_SQL, NORMAL_TAIL, SLICED_CTE, STORE_CTE, TX_CTE, ks_tail
from vigil.sources import testdata as td

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE_SQL: dict[str, str] = {}

# Per-call memo (split cut keys): shared by the helpers while one query's
# plan is being built, cleared around every call so queries stay independent.
_MEMO: dict = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        @functools.wraps(fn)
        def run(spark: SparkSession, sf: str) -> DataFrame:
            _MEMO.clear()
            try:
                return fn(spark, sf)
            finally:
                _MEMO.clear()

        QUERIES[name] = run
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------- #
# shared derived frames
# --------------------------------------------------------------------------- #


def _memo(key, build):
    if key not in _MEMO:
        _MEMO[key] = build()
    return _MEMO[key]


def tx(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(("tx", sf), lambda: td.transactions(spark, sf))


def cuts(spark: SparkSession, sf: str) -> split.SplitCuts:
    return _memo(("cuts", sf), lambda: split.split_cuts(tx(spark, sf)))


def sliced(spark: SparkSession, sf: str) -> DataFrame:
    return _memo(("sliced", sf), lambda: split.with_slice(tx(spark, sf), cuts=cuts(spark, sf)))


def scored_store(spark: SparkSession, sf: str) -> DataFrame:
    """The derived store: stream scored by the champion, errors re-scored."""
    return _memo(("store", sf), lambda: _build_store(spark, sf))


def _build_store(spark: SparkSession, sf: str) -> DataFrame:
    s = sliced(spark, sf).filter(F.col("slice") == "stream")
    first = s.select(
        td.ID,
        td.champion_score().alias("score"),
        F.lit(0).cast("long").alias("batch_id"),
    )
    replay = s.filter(F.col("cat_a") == "error").select(
        td.ID,
        td.challenger_score().alias("score"),
        F.lit(1).cast("long").alias("batch_id"),
    )
    rows = first.unionByName(replay)
    decision = F.when(F.col("score") >= td.CHAMPION_THRESHOLD, "block").otherwise("allow")
    return rows.select(td.ID, "score", decision.alias("decision"), F.lit(0).cast("long").alias("seq"), "batch_id")


# --------------------------------------------------------------------------- #
# W1 chronological split
# --------------------------------------------------------------------------- #


@register(
    "w1_split_assign",
    f"WITH {SLICED_CTE} SELECT TransactionID, TransactionDT, slice FROM sliced",
)
def q_split_assign(spark: SparkSession, sf: str) -> DataFrame:
    return sliced(spark, sf).select(td.ID, td.TIME, "slice")


@register(
    "w1_split_summary",
    f"""WITH {SLICED_CTE}
SELECT slice, count(*) AS n_rows, min(TransactionDT) AS min_time, max(TransactionDT) AS max_time,
       round(avg(CAST(isFraud AS DOUBLE)), 9) AS label_rate
FROM sliced GROUP BY slice""",
)
def q_split_summary(spark: SparkSession, sf: str) -> DataFrame:
    return split.split_summary(sliced(spark, sf))


# --------------------------------------------------------------------------- #
# A4 AUC, A5-A7 cost / threshold
# --------------------------------------------------------------------------- #

_AUC_SQL = """
{name} AS (
  SELECT slice, sum(y) AS n_pos, sum(1 - y) AS n_neg,
         (sum(CASE WHEN y = 1 THEN ar END) - sum(y) * (sum(y) + 1) / 2.0)
           / (CAST(sum(y) AS DOUBLE) * CAST(sum(1 - y) AS DOUBLE)) AS auc
  FROM (
    SELECT slice, y,
           rank() OVER (PARTITION BY slice ORDER BY s)
             + (count(*) OVER (PARTITION BY slice, s) - 1) / 2.0 AS ar
    FROM (SELECT slice, isFraud AS y, {score} AS s FROM sliced)
  ) GROUP BY slice
)"""


@register(
    "a4_auc_by_slice",
    f"""WITH {SLICED_CTE},
{_AUC_SQL.format(name='ca', score=CHAMPION_SQL)},
{_AUC_SQL.format(name='cb', score=CHALLENGER_SQL)}
SELECT ca.slice, CAST(ca.n_pos AS BIGINT) AS n_pos, CAST(ca.n_neg AS BIGINT) AS n_neg,
       ca.auc AS auc_champion, cb.auc AS auc_challenger
FROM ca JOIN cb USING (slice)""",
)
def q_auc(spark: SparkSession, sf: str) -> DataFrame:
    s = sliced(spark, sf).select(
        "slice", td.LABEL, td.champion_score().alias("a"), td.challenger_score().alias("b")
    )
    long = evaluate.stack_scores(s, td.LABEL, ["a", "b"], by=["slice"])
    auc = evaluate.auc_frame(long, by=["slice", "scorer"])
    return auc.groupBy("slice").agg(
        F.first("n_pos").alias("n_pos"),
        F.first("n_neg").alias("n_neg"),
        F.max(F.when(F.col("scorer") == "a", F.col("auc"))).alias("auc_champion"),
        F.max(F.when(F.col("scorer") == "b", F.col("auc"))).alias("auc_challenger"),
    )


_COUNTS_SQL = """
c AS (
  SELECT {score} AS score,
         CAST(sum(CASE WHEN isFraud = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
         CAST(sum(CASE WHEN isFraud = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
  FROM sliced WHERE slice = 'test' GROUP BY 1
),
w AS (
  SELECT score, pos, neg,
         CAST(coalesce(sum(pos) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS missed,
         CAST(sum(neg) OVER () - coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS blocked
  FROM c
),
curve AS (
  SELECT score AS threshold, missed, blocked, CAST(missed AS DOUBLE) * 10.0 + CAST(blocked AS DOUBLE) AS cost FROM w
)"""


def _test_scored(spark: SparkSession, sf: str) -> DataFrame:
    return sliced(spark, sf).filter(F.col("slice") == "test").select(
        td.LABEL, td.champion_score().alias("score")
    )


@register(
    "a6_cost_curve",
    f"WITH {SLICED_CTE}, {_COUNTS_SQL.format(score=CHAMPION_SQL)} SELECT * FROM curve",
)
def q_cost_curve(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.cost_curve(_test_scored(spark, sf), cost_ratio=10.0)


@register(
    "a7_operating_threshold",
    f"""WITH {SLICED_CTE}, {_COUNTS_SQL.format(score=CHAMPION_SQL)}
SELECT threshold, cost FROM curve ORDER BY cost, threshold LIMIT 1""",
)
def q_threshold(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.operating_threshold_frame(_test_scored(spark, sf), cost_ratio=10.0)


@register(
    "a5_expected_cost",
    f"""WITH {SLICED_CTE}
SELECT CAST(sum(CASE WHEN isFraud = 1 AND {CHAMPION_SQL} < 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS missed,
       CAST(sum(CASE WHEN isFraud <> 1 AND {CHAMPION_SQL} >= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS blocked,
       CAST(sum(CASE WHEN isFraud = 1 AND {CHAMPION_SQL} < 0.5 THEN 1 ELSE 0 END) AS DOUBLE) * 10.0
         + CAST(sum(CASE WHEN isFraud <> 1 AND {CHAMPION_SQL} >= 0.5 THEN 1 ELSE 0 END) AS DOUBLE) AS cost
FROM sliced WHERE slice = 'test'""",
)
def q_expected_cost(spark: SparkSession, sf: str) -> DataFrame:
    return evaluate.expected_cost_frame(_test_scored(spark, sf), 0.5, cost_ratio=10.0)




# --------------------------------------------------------------------------- #
# helpers for SQL generation
# --------------------------------------------------------------------------- #

_TX_COLUMNS = (
    "TransactionID", "TransactionDT", "isFraud", "amount", "k", "user_id", "hour",
    "cat_a", "cat_b", "f_partial", "f_sparse",
)
_DOUBLE_COLUMNS = ("amount", "f_partial", "f_sparse")
_CONTRACT = contract.Contract(td.CONTRACT_FEATURES, td.CATEGORICAL_FEATURES, td.CHAMPION_THRESHOLD)
_NUMERIC_CONTRACT = [c for c in td.CONTRACT_FEATURES if c not in td.CATEGORICAL_FEATURES]


def _missing_sql(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if c in _DOUBLE_COLUMNS else f"({c} IS NULL)"


def _feature_list(cols) -> str:
    return ", ".join(cols)


# --------------------------------------------------------------------------- #
# P1-P3, A21 profiling
# --------------------------------------------------------------------------- #


@register(
    "p1_null_profile",
    f"WITH {TX_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, avg(CASE WHEN {_missing_sql(c)} THEN 1.0 ELSE 0.0 END::DOUBLE) * 100.0 AS null_pct FROM tx"
        for c in _TX_COLUMNS
    ),
)
def q_null_profile(spark: SparkSession, sf: str) -> DataFrame:
    return profile.null_profile(tx(spark, sf))


@register("p2_missingness_filter", f"WITH {TX_CTE} SELECT * EXCLUDE (f_sparse) FROM tx")
def q_missingness_filter(spark: SparkSession, sf: str) -> DataFrame:
    return profile.filter_columns_by_missingness(tx(spark, sf), 50.0)


@register(
    "p3_dropped_columns",
    f"WITH {TX_CTE} SELECT 'f_sparse' AS column_name, "
    f"avg(CASE WHEN {_missing_sql('f_sparse')} THEN 1.0 ELSE 0.0 END::DOUBLE) * 100.0 AS null_pct FROM tx",
)
def q_dropped_columns(spark: SparkSession, sf: str) -> DataFrame:
    return profile.dropped_columns(tx(spark, sf), 50.0)


_LIFT_SQL = """SELECT '{c}' AS column_name,
  CAST(sum(CASE WHEN {m} THEN 1 ELSE 0 END) AS BIGINT) AS n_missing,
  CAST(sum(CASE WHEN {m} THEN 0 ELSE 1 END) AS BIGINT) AS n_present,
  round(sum(CASE WHEN {m} THEN CAST(isFraud AS DOUBLE) ELSE 0.0 END) / sum(CASE WHEN {m} THEN 1 ELSE 0 END), 9) AS rate_missing,
  round(sum(CASE WHEN {m} THEN 0.0 ELSE CAST(isFraud AS DOUBLE) END) / sum(CASE WHEN {m} THEN 0 ELSE 1 END), 9) AS rate_present,
  round((sum(CASE WHEN {m} THEN CAST(isFraud AS DOUBLE) ELSE 0.0 END) / sum(CASE WHEN {m} THEN 1 ELSE 0 END))
      / (sum(CASE WHEN {m} THEN 0.0 ELSE CAST(isFraud AS DOUBLE) END) / sum(CASE WHEN {m} THEN 0 ELSE 1 END)), 9) AS lift
FROM tx"""


@register(
    "a21_missingness_lift",
    f"WITH {TX_CTE} "
    + " UNION ALL ".join(_LIFT_SQL.format(c=c, m=_missing_sql(c)) for c in ("f_partial", "f_sparse")),
)
def q_missingness_lift(spark: SparkSession, sf: str) -> DataFrame:
    return profile.missingness_lift(tx(spark, sf), ["f_partial", "f_sparse"])


# --------------------------------------------------------------------------- #
# V4 completeness, V10 quarantine, P6/P7 scoring, A22
# --------------------------------------------------------------------------- #


@register(
    "v4_incomplete_columns",
    f"WITH {TX_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, bool_or({_missing_sql(c)}) AS has_missing FROM tx"
        for c in td.CONTRACT_FEATURES
    ),
)
def q_incomplete(spark: SparkSession, sf: str) -> DataFrame:
    return contract.completeness(tx(spark, sf), td.CONTRACT_FEATURES)


@register(
    "v10_quarantine",
    f"WITH {TX_CTE}, r AS (SELECT TransactionID, concat_ws('; ', "
    + ", ".join(f"CASE WHEN {_missing_sql(c)} THEN 'null: {c}' END" for c in td.CONTRACT_FEATURES)
    + ") AS reasons FROM tx) SELECT TransactionID, reasons = '' AS accepted, reasons FROM r",
)
def q_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select(td.ID, *td.CONTRACT_FEATURES)
    return contract.tag_rows(t, _CONTRACT).select(td.ID, "accepted", "reasons")


def _champion_boundary(require_complete: bool = False) -> contract.ScoringBoundary:
    return contract.ScoringBoundary(td.champion_score, _CONTRACT, require_complete=require_complete)


@register(
    "p7_score_stream",
    f"""WITH {SLICED_CTE}
SELECT TransactionID, {CHAMPION_SQL} AS score,
       CASE WHEN {CHAMPION_SQL} >= 0.5 THEN 'block' ELSE 'allow' END AS decision, CAST(0.5 AS DOUBLE) AS threshold
FROM sliced WHERE slice = 'stream'""",
)
def q_score_stream(spark: SparkSession, sf: str) -> DataFrame:
    stream = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    return _champion_boundary().score(stream, keep=[td.ID])


@register(
    "a22_score_summary",
    f"""WITH {SLICED_CTE}, s AS (
  SELECT {CHAMPION_SQL} AS score, CASE WHEN {CHAMPION_SQL} >= 0.5 THEN 'block' ELSE 'allow' END AS decision
  FROM sliced WHERE slice = 'stream')
SELECT decision, count(*) AS n_rows, min(score) AS min_score, max(score) AS max_score FROM s GROUP BY decision""",
)
def q_score_summary(spark: SparkSession, sf: str) -> DataFrame:
    stream = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    scored = _champion_boundary().score(stream, keep=[td.ID])
    return scored.groupBy("decision").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("score").alias("min_score"), F.max("score").alias("max_score")
    )


# --------------------------------------------------------------------------- #
# J4 partial-coverage left join (documents with labels)
# --------------------------------------------------------------------------- #


@register(
    "j4_label_coverage",
    """SELECT d.lang, count(*) AS n_docs, count(l.doc_id) AS n_labeled,
       round(avg(CASE WHEN l.doc_id IS NULL THEN 0.0 ELSE 1.0 END::DOUBLE), 9) AS coverage,
       round(avg(CAST(l.quality AS DOUBLE)), 9) AS quality_rate
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""",
)
def q_label_coverage(spark: SparkSession, sf: str) -> DataFrame:
    docs = td.table(spark, sf, "documents").select("doc_id", "lang")
    labels = td.table(spark, sf, "labels").select(F.col("doc_id").alias("l_doc_id"), "quality")
    joined = docs.join(labels, docs.doc_id == labels.l_doc_id, "left")
    return joined.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count("l_doc_id").alias("n_labeled"),
        F.round(F.avg(F.col("l_doc_id").isNotNull().cast("double")), 9).alias("coverage"),
        F.round(F.avg(F.col("quality").cast("double")), 9).alias("quality_rate"),
    )


# --------------------------------------------------------------------------- #
# Store: W2, A3, J2, J3, L2
# --------------------------------------------------------------------------- #


@register(
    "w2_latest_scores",
    f"""WITH {STORE_CTE}
SELECT TransactionID, arg_max(score, batch_id) AS score, arg_max(decision, batch_id) AS decision,
       CAST(max(batch_id) AS BIGINT) AS batch_id
FROM store GROUP BY TransactionID""",
)
def q_latest(spark: SparkSession, sf: str) -> DataFrame:
    return store.latest_scores(scored_store(spark, sf)).select(td.ID, "score", "decision", "batch_id")


@register(
    "a3_store_counts",
    f"""WITH {STORE_CTE}
SELECT count(*) AS n_rows, count(DISTINCT TransactionID) AS n_ids FROM store""",
)
def q_store_counts(spark: SparkSession, sf: str) -> DataFrame:
    return store.store_counts(scored_store(spark, sf))


@register(
    "j2_scored_rows",
    f"""WITH {STORE_CTE}
SELECT TransactionID, TransactionDT FROM tx WHERE TransactionID IN (SELECT TransactionID FROM store)""",
)
def q_scored_rows(spark: SparkSession, sf: str) -> DataFrame:
    return store.scored_rows(tx(spark, sf), scored_store(spark, sf)).select(td.ID, td.TIME)


@register(
    "j3_unseen_rows",
    f"""WITH {STORE_CTE}
SELECT TransactionID, TransactionDT FROM tx t
WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.TransactionID = t.TransactionID)""",
)
def q_unseen_rows(spark: SparkSession, sf: str) -> DataFrame:
    return store.unseen_rows(tx(spark, sf), scored_store(spark, sf)).select(td.ID, td.TIME)


@register(
    "l2_next_chunk",
    f"""WITH {STORE_CTE}
SELECT TransactionID, TransactionDT FROM tx t
WHERE NOT EXISTS (SELECT 1 FROM store s WHERE s.TransactionID = t.TransactionID)
ORDER BY TransactionDT, TransactionID LIMIT 500""",
)
def q_next_chunk(spark: SparkSession, sf: str) -> DataFrame:
    return store.next_chunk(tx(spark, sf), scored_store(spark, sf), 500).select(td.ID, td.TIME)


# --------------------------------------------------------------------------- #
# Windows: M6 reference, M7 current, W3 last N, W4 trailing, L4 sample
# --------------------------------------------------------------------------- #

_FEATS = _feature_list(td.CONTRACT_FEATURES)
_T_FEATS = ", ".join(f"t.{c}" for c in td.CONTRACT_FEATURES)
_WINDOW_CTE = (
    STORE_CTE
    + f""",
ref AS (SELECT {_FEATS}, {CHAMPION_SQL} AS score FROM sliced WHERE slice = 'train'),
cur_all AS (SELECT t.TransactionID, {_T_FEATS}, l.score FROM latest l JOIN tx t USING (TransactionID)),
cur AS (SELECT {_FEATS}, score FROM cur_all)"""
)


def reference_frame(spark: SparkSession, sf: str) -> DataFrame:
    train = sliced(spark, sf).filter(F.col("slice") == "train").select(td.ID, *td.CONTRACT_FEATURES)
    ref = window.build_reference(train, td.champion_score, max_rows=None)
    return ref.select(*td.CONTRACT_FEATURES, "score")


def current_frame(spark: SparkSession, sf: str, **kw) -> DataFrame:
    kw.setdefault("window_rows", None)
    return window.current_window(scored_store(spark, sf), tx(spark, sf), td.CONTRACT_FEATURES, **kw)


@register("m6_reference", f"WITH {_WINDOW_CTE} SELECT * FROM ref")
def q_reference(spark: SparkSession, sf: str) -> DataFrame:
    return reference_frame(spark, sf)


@register("m7_current_window", f"WITH {_WINDOW_CTE} SELECT * FROM cur")
def q_current(spark: SparkSession, sf: str) -> DataFrame:
    return current_frame(spark, sf)


@register(
    "w3_last_n_window",
    f"WITH {_WINDOW_CTE} SELECT {_FEATS}, score FROM cur_all ORDER BY TransactionDT DESC, TransactionID DESC LIMIT 1000",
)
def q_last_n(spark: SparkSession, sf: str) -> DataFrame:
    return current_frame(spark, sf, window_rows=1000)


@register(
    "w4_trailing_window",
    f"WITH {_WINDOW_CTE} SELECT * FROM cur WHERE TransactionDT > (SELECT max(TransactionDT) FROM cur) - 259200",
)
def q_trailing(spark: SparkSession, sf: str) -> DataFrame:
    return current_frame(spark, sf, window_days=3 * 86400.0)


_SAMPLE_KEY_SQL = (
    "(((((TransactionID % 2147483647) + 0) % 2147483647) * 48271 % 2147483647) * 48271 % 2147483647)"
)


@register(
    "l4_sample",
    f"""WITH {SLICED_CTE}
SELECT TransactionID, TransactionDT FROM sliced WHERE slice = 'train'
ORDER BY {_SAMPLE_KEY_SQL}, TransactionID LIMIT 1000""",
)
def q_sample(spark: SparkSession, sf: str) -> DataFrame:
    train = sliced(spark, sf).filter(F.col("slice") == "train").select(td.ID, td.TIME)
    return window.deterministic_sample(train, 1000)


# --------------------------------------------------------------------------- #
# Drift: A8-A14, M8
# --------------------------------------------------------------------------- #

_NUM_WITH_SCORE = [*_NUMERIC_CONTRACT, "score"]
_KS_PART = (
    f""",
u AS (SELECT 0 AS side, * FROM ref UNION ALL SELECT 1 AS side, * FROM cur),
nl AS (
  UNPIVOT (SELECT side, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _NUM_WITH_SCORE)} FROM u)
  ON {", ".join(_NUM_WITH_SCORE)} INTO NAME feature VALUE value
),
nc AS (
  SELECT feature, value,
         CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS ref_n,
         CAST(sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS cur_n
  FROM nl WHERE NOT isnan(value) GROUP BY feature, value
),
ne AS (
  SELECT feature,
         sum(ref_n) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cr,
         sum(cur_n) OVER (PARTITION BY feature ORDER BY value ROWS UNBOUNDED PRECEDING) AS cc,
         sum(ref_n) OVER (PARTITION BY feature) AS tot_ref, sum(cur_n) OVER (PARTITION BY feature) AS tot_cur
  FROM nc
),
nd AS (
  SELECT feature, CAST(any_value(tot_ref) AS BIGINT) AS n_ref, CAST(any_value(tot_cur) AS BIGINT) AS n_cur,
         max(abs(CAST(cr AS DOUBLE) / tot_ref - CAST(cc AS DOUBLE) / tot_cur)) AS d
  FROM ne GROUP BY feature
),
ks AS (
  SELECT feature, n_ref, n_cur, CASE WHEN n_ref < 2 OR n_cur < 2 THEN CAST(0.0 AS DOUBLE) ELSE d END AS statistic
  FROM nd
)"""
    + ks_tail("ks", "feature")
)

_KS_CTE = _WINDOW_CTE + _KS_PART

_CHI_CTE = """,
cl AS (
  UNPIVOT (SELECT side, CAST(cat_a AS VARCHAR) AS cat_a, CAST(cat_b AS VARCHAR) AS cat_b FROM u)
  ON cat_a, cat_b INTO NAME feature VALUE category
),
cc AS (
  SELECT feature, category,
         CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS ref_n,
         CAST(sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS BIGINT) AS cur_n
  FROM cl GROUP BY feature, category
),
ct AS (SELECT feature, sum(ref_n) AS tot_ref, sum(cur_n) AS tot_cur, count(*) AS K FROM cc GROUP BY feature),
cs AS (
  SELECT feature, CAST(any_value(tot_ref) AS BIGINT) AS n_ref, CAST(any_value(tot_cur) AS BIGINT) AS n_cur,
         CAST(any_value(K) - 1 AS BIGINT) AS dof,
         sum(CASE WHEN ref_n * (CAST(tot_cur AS DOUBLE) / tot_ref) = 0 THEN CAST('inf' AS DOUBLE)
                  ELSE power(cur_n - ref_n * (CAST(tot_cur AS DOUBLE) / tot_ref), 2) / (ref_n * (CAST(tot_cur AS DOUBLE) / tot_ref)) END) AS statistic
  FROM cc JOIN ct USING (feature) GROUP BY feature
),
csp AS (
  SELECT feature, n_ref, n_cur, statistic, dof,
         CASE WHEN dof <= 0 THEN CAST(1.0 AS DOUBLE)
              WHEN isinf(statistic) THEN CAST(0.0 AS DOUBLE)
              ELSE least(greatest(exp(-statistic / 2.0) * list_sum(list_transform(range(0, CAST(dof / 2 AS BIGINT)),
                     lambda i: power(statistic / 2.0, i) / gamma(i + 1))), 0.0), 1.0) END AS p_value
  FROM cs
)"""


def drift_inputs(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return reference_frame(spark, sf), current_frame(spark, sf)


def _rounded_metrics(m: DataFrame) -> DataFrame:
    return m.withColumn("statistic", F.round("statistic", 9)).withColumn("p_value", F.round("p_value", 9))


@register(
    "a8_score_distance",
    f"WITH {_KS_CTE} SELECT n_ref, n_cur, statistic AS score_distance FROM ks WHERE feature = 'score'",
)
def q_score_distance(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = drift_inputs(spark, sf)
    m = drift.ks_metrics(ref, cur, ["score"], kind="score")
    return m.select("n_ref", "n_cur", F.col("statistic").alias("score_distance"))


@register(
    "a9_ks_features",
    f"""WITH {_KS_CTE}
SELECT feature, n_ref, n_cur, statistic, round(p_value, 9) AS p_value FROM ksp WHERE feature <> 'score'""",
)
def q_ks_features(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = drift_inputs(spark, sf)
    m = drift.ks_metrics(ref, cur, _NUMERIC_CONTRACT)
    return m.select("feature", "n_ref", "n_cur", "statistic", F.round("p_value", 9).alias("p_value"))


@register(
    "a9_ks_exact_windows",
    f"""WITH {SLICED_CTE},
r AS (
  SELECT hour, CAST(amount AS DOUBLE) AS value, CASE WHEN slice = 'train' THEN 1 ELSE 0 END AS a
  FROM sliced WHERE slice <> 'test' AND amount IS NOT NULL AND NOT isnan(CAST(amount AS DOUBLE))
),
c AS (SELECT hour, value, sum(a) AS x, sum(1 - a) AS y FROM r GROUP BY hour, value),
e AS (
  SELECT hour, sum(x) OVER w AS cx, sum(y) OVER w AS cy, sum(x) OVER (PARTITION BY hour) AS tx, sum(y) OVER (PARTITION BY hour) AS ty
  FROM c WINDOW w AS (PARTITION BY hour ORDER BY value ROWS UNBOUNDED PRECEDING)
),
g AS (
  SELECT hour, CAST(any_value(tx) AS BIGINT) AS n_ref, CAST(any_value(ty) AS BIGINT) AS n_cur,
         CASE WHEN any_value(tx) < 2 OR any_value(ty) < 2 THEN 0.0 ELSE max(abs(cx / CAST(tx AS DOUBLE) - cy / CAST(ty AS DOUBLE))) END AS statistic
  FROM e GROUP BY hour
){ks_tail("g", "hour")}
SELECT hour, n_ref, n_cur, round(statistic, 9) AS statistic, round(p_value, 9) AS p_value FROM ksp""",
)
def q_ks_exact_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The amounts of each hour of day, train against stream, with exact tails for small windows."""
    rows = sliced(spark, sf).select("hour", "amount", "slice")
    found = drift.ks_by_group(rows.filter("slice = 'train'"), rows.filter("slice = 'stream'"), "amount", ["hour"])
    return found.select("hour", "n_ref", "n_cur", F.round("statistic", 9).alias("statistic"), F.round("p_value", 9).alias("p_value"))


@register(
    "a10_chisquare_features",
    f"""WITH {_WINDOW_CTE}, u AS (SELECT 0 AS side, * FROM ref UNION ALL SELECT 1 AS side, * FROM cur){_CHI_CTE}
SELECT feature, n_ref, n_cur, round(statistic, 9) AS statistic, dof, round(p_value, 9) AS p_value FROM csp""",
)
def q_chisquare(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = drift_inputs(spark, sf)
    m = drift.chisquare_metrics(ref, cur, list(td.CATEGORICAL_FEATURES))
    return _rounded_metrics(m).drop("kind")


_METRICS_PART = """,
metrics AS (
  SELECT feature, CASE WHEN feature = 'score' THEN 'score' ELSE 'ks' END AS kind, n_ref, n_cur,
         statistic, CAST(NULL AS BIGINT) AS dof, p_value FROM ksp
  UNION ALL
  SELECT feature, 'chisquare' AS kind, n_ref, n_cur, statistic, dof, p_value FROM csp
)"""
_METRICS_SQL = f"WITH {_KS_CTE}{_CHI_CTE}{_METRICS_PART}"


@register(
    "m8_drift_metrics",
    _METRICS_SQL
    + " SELECT feature, kind, n_ref, n_cur, round(statistic, 9) AS statistic, dof, round(p_value, 9) AS p_value FROM metrics",
)
def q_drift_metrics(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = drift_inputs(spark, sf)
    return _rounded_metrics(drift.compute_drift(ref, cur, feature_columns=td.CONTRACT_FEATURES))


@register(
    "st6_incremental_drift",
    _METRICS_SQL
    + " SELECT feature, kind, n_ref, n_cur, round(statistic, 9) AS statistic, dof, round(p_value, 9) AS p_value FROM metrics",
)
def q_incremental_drift(spark: SparkSession, sf: str) -> DataFrame:
    """M8's metrics from batch summaries: four batches, a replay, then re-scored rows that replace others."""
    rows = sliced(spark, sf)
    features = list(td.CONTRACT_FEATURES)
    log = DriftLog(spark, work_path(spark, "drift-log"), _NUMERIC_CONTRACT, td.CATEGORICAL_FEATURES)
    log.set_reference(reference_frame(spark, sf))
    stream = rows.filter("slice = 'stream'").select(td.ID, *features, td.champion_score().alias("score"), td.challenger_score().alias("again"))
    for batch in (0, 1, 2, 2, 3):  # the second 2 is a replay
        log.append(stream.filter(F.col(td.ID) % 4 == batch), batch)
    errors = stream.filter("cat_a = 'error'")
    log.append(errors.withColumn("score", F.col("again")), 4, replaced=errors)
    return _rounded_metrics(log.metrics())


_DECISION_SQL = """
SELECT CAST(count(*) FILTER (WHERE kind <> 'score') AS BIGINT) AS n_features,
       CAST(count(*) FILTER (WHERE kind <> 'score' AND p_value < 0.05) AS BIGINT) AS n_drifted,
       CASE WHEN count(*) FILTER (WHERE kind <> 'score') > 0
            THEN CAST(count(*) FILTER (WHERE kind <> 'score' AND p_value < 0.05) AS DOUBLE)
                 / count(*) FILTER (WHERE kind <> 'score') ELSE 0.0 END AS feature_fraction,
       coalesce(CAST(count(*) FILTER (WHERE kind <> 'score' AND p_value < 0.05) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE kind <> 'score'), 0), 0.0) >= 0.1 AS feature_alarm,
       coalesce(max(statistic) FILTER (WHERE kind = 'score'), 0.0) AS score_distance,
       coalesce(max(statistic) FILTER (WHERE kind = 'score'), 0.0) >= 0.1 AS score_alarm,
       (coalesce(CAST(count(*) FILTER (WHERE kind <> 'score' AND p_value < 0.05) AS DOUBLE)
                 / nullif(count(*) FILTER (WHERE kind <> 'score'), 0), 0.0) >= 0.1)
         OR (coalesce(max(statistic) FILTER (WHERE kind = 'score'), 0.0) >= 0.1) AS alarm
FROM metrics"""


@register("a12_drift_decision", _METRICS_SQL + _DECISION_SQL)
def q_drift_decision(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = drift_inputs(spark, sf)
    _, decision = drift.run_drift_monitor(ref, cur, feature_columns=td.CONTRACT_FEATURES)
    return decision


@register(
    "a14_no_drift_decision",
    f"""WITH {_WINDOW_CTE},
empty_cur AS (SELECT * FROM cur WHERE TransactionDT > (SELECT max(TransactionDT) FROM cur)),
metrics AS (
  SELECT f AS feature, 'none' AS kind, CAST(1.0 AS DOUBLE) AS p_value, CAST(0.0 AS DOUBLE) AS statistic
  FROM (SELECT unnest({list(td.CONTRACT_FEATURES)}) AS f)
  WHERE (SELECT count(*) FROM empty_cur) = 0
  UNION ALL SELECT 'score', 'score', 1.0, 0.0
)"""
    + _DECISION_SQL,
)
def q_no_drift(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.plans.monitoring import drift_pass

    ref = reference_frame(spark, sf)
    cur = current_frame(spark, sf, window_days=0.0)  # strictly newer than the newest row: empty
    _, decision = drift_pass(ref, cur, td.CONTRACT_FEATURES)
    return decision


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: the full drift metrics table."""
    return QUERIES["m8_drift_metrics"](spark, sf)


# --------------------------------------------------------------------------- #
# A15/A16/W5 DeLong promotion gate
# --------------------------------------------------------------------------- #

_PLACE_SQL = """
{p} AS (
  SELECT v, (coalesce(nb, 0) + 0.5 * neg) / tot_neg AS pp, (coalesce(pa, 0) + 0.5 * pos) / tot_pos AS pn
  FROM (
    SELECT v, pos, neg,
           sum(neg) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS nb,
           sum(pos) OVER (ORDER BY v ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS pa,
           CAST(sum(pos) OVER () AS DOUBLE) AS tot_pos, CAST(sum(neg) OVER () AS DOUBLE) AS tot_neg
    FROM (SELECT {s} AS v, sum(y) AS pos, sum(1 - y) AS neg FROM gate GROUP BY {s})
  )
)"""


@register(
    "a15_delong_gate",
    f"""WITH {SLICED_CTE},
gate AS (SELECT CASE WHEN isFraud = 1 THEN 1 ELSE 0 END AS y, {CHAMPION_SQL} AS a, {CHALLENGER_SQL} AS b
         FROM sliced WHERE slice = 'test'),
{_PLACE_SQL.format(p='pa_t', s='a')},
{_PLACE_SQL.format(p='pb_t', s='b')},
j AS (SELECT g.y, x.pp AS a_pp, x.pn AS a_pn, z.pp AS b_pp, z.pn AS b_pn
      FROM gate g JOIN pa_t x ON g.a = x.v JOIN pb_t z ON g.b = z.v),
agg AS (
  SELECT count(*) FILTER (WHERE y = 1) AS n_pos, count(*) FILTER (WHERE y = 0) AS n_neg,
         avg(a_pp) FILTER (WHERE y = 1) AS auc_a, avg(b_pp) FILTER (WHERE y = 1) AS auc_b,
         var_samp(b_pp - a_pp) FILTER (WHERE y = 1) AS v10, var_samp(b_pn - a_pn) FILTER (WHERE y = 0) AS v01
  FROM j
),
res AS (SELECT *, sqrt(greatest(v10 / n_pos + v01 / n_neg, 0.0)) AS se FROM agg)
SELECT CAST(n_pos AS BIGINT) AS n_pos, CAST(n_neg AS BIGINT) AS n_neg,
       round(auc_a, 9) AS auc_champion, round(auc_b, 9) AS auc_challenger, round(se, 9) AS se,
       round(CASE WHEN se > 0 THEN (auc_b - auc_a) / se END, 6) AS z,
       round(CASE WHEN se = 0 OR auc_b <= auc_a THEN 1.0 ELSE {NORMAL_TAIL.format(z="(auc_b - auc_a) / se")} END, 9) AS p_value,
       (se > 0 AND auc_b - auc_a > 0 AND (auc_b - auc_a) / se >= 1.6448536269514722) AS promote
FROM res""",
)
def q_delong(spark: SparkSession, sf: str) -> DataFrame:
    test = sliced(spark, sf).filter(F.col("slice") == "test").select(
        td.LABEL, td.champion_score().alias("champion"), td.challenger_score().alias("challenger")
    )
    d = promote.delong_frame(test)
    return d.select(
        "n_pos",
        "n_neg",
        F.round("auc_champion", 9).alias("auc_champion"),
        F.round("auc_challenger", 9).alias("auc_challenger"),
        F.round("se", 9).alias("se"),
        F.round("z", 6).alias("z"),
        F.round("p_value", 9).alias("p_value"),
        "promote",
    )


# --------------------------------------------------------------------------- #
# P10/U1/A2/M5 corpus, A17/A18 trigger
# --------------------------------------------------------------------------- #

_LAG = 2 * 86400.0  # two days, in TransactionDT seconds
_CORPUS_CTE = (
    STORE_CTE
    + f""",
scored_stream AS (SELECT * FROM sliced WHERE slice = 'stream' AND TransactionID IN (SELECT TransactionID FROM store)),
newest AS (SELECT max(TransactionDT) AS m FROM (SELECT TransactionDT FROM sliced WHERE slice = 'train'
                                                UNION ALL SELECT TransactionDT FROM scored_stream)),
corpus AS (
  SELECT TransactionID, TransactionDT, isFraud, 'history' AS origin FROM sliced WHERE slice = 'train'
  UNION ALL
  SELECT TransactionID, TransactionDT, isFraud, 'revealed' AS origin FROM scored_stream
  WHERE TransactionDT <= (SELECT m FROM newest) - {_LAG}
)"""
)


def _corpus(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """M5 over the stand-in data: (corpus, shared test, stream)."""
    return _memo(
        ("corpus", sf),
        lambda: corpus.prepare_retraining_inputs(
            tx(spark, sf), scored_store(spark, sf), reveal_lag=_LAG, cuts=cuts(spark, sf)
        ),
    )


@register("m5_corpus_rows", f"WITH {_CORPUS_CTE} SELECT * FROM corpus")
def q_corpus_rows(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf)
    c = cuts(spark, sf)
    train, _test, stream = split.temporal_split(t, cuts=c)
    scored = store.scored_rows(stream, scored_store(spark, sf)).withColumn("origin", F.lit("revealed"))
    history = train.withColumn("origin", F.lit("history"))
    out = corpus.build_retraining_corpus(history, scored, reveal_lag=_LAG)
    return out.select(td.ID, td.TIME, td.LABEL, "origin")


@register(
    "m5_retraining_counts",
    f"""WITH {_CORPUS_CTE}
SELECT (SELECT count(*) FROM corpus) AS corpus_size,
       (SELECT count(*) FROM sliced WHERE slice = 'test') AS shared_test_size,
       (SELECT count(*) FROM sliced WHERE slice = 'stream') AS stream_size,
       (SELECT m FROM newest) AS newest_time""",
)
def q_retraining_counts(spark: SparkSession, sf: str) -> DataFrame:
    c, test, stream = _corpus(spark, sf)
    parts = (
        c.select(F.lit("corpus").alias("part"))
        .unionByName(test.select(F.lit("test").alias("part")))
        .unionByName(stream.select(F.lit("stream").alias("part")))
    )
    counts = parts.agg(
        F.count_if(F.col("part") == "corpus").alias("corpus_size"),
        F.count_if(F.col("part") == "test").alias("shared_test_size"),
        F.count_if(F.col("part") == "stream").alias("stream_size"),
    )
    # A2: the "now" the corpus used — newest time over history and the scored stream
    train, _t, st = split.temporal_split(tx(spark, sf), cuts=cuts(spark, sf))
    newest = corpus.newest_time(train, store.scored_rows(st, scored_store(spark, sf)))
    return counts.withColumn("newest_time", F.lit(newest).cast("long"))


@register(
    "a17_retrain_trigger",
    f"""WITH {STORE_CTE}
SELECT CAST(greatest(count(*) - count(*) FILTER (WHERE batch_id <= 0), 0) AS BIGINT) AS volume_since_last,
       CAST(200 AS BIGINT) AS volume_threshold,
       greatest(count(*) - count(*) FILTER (WHERE batch_id <= 0), 0) >= 200 AS volume_triggered,
       false AS drift_triggered,
       greatest(count(*) - count(*) FILTER (WHERE batch_id <= 0), 0) >= 200 AS retrain
FROM store""",
)
def q_trigger(spark: SparkSession, sf: str) -> DataFrame:
    st = scored_store(spark, sf)
    # checkpoint = the store's row count when batch 0 completed (derived state)
    volume = F.greatest(F.count(F.lit(1)) - F.count_if(F.col("batch_id") <= 0), F.lit(0))
    agg = st.agg(volume.alias("v"))
    return agg.select(*trigger.trigger_columns(F.col("v"), volume_threshold=200, drift_alarm=False))


# --------------------------------------------------------------------------- #
# A19 best row per group, M9 expanding time folds
# --------------------------------------------------------------------------- #


@register(
    "a19_best_per_group",
    """SELECT o_orderpriority, o_orderkey, o_custkey, o_totalprice AS metric, false AS fallback
FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS r
      FROM orders WHERE o_totalprice IS NOT NULL AND NOT isnan(o_totalprice))
WHERE r = 1""",
)
def q_best(spark: SparkSession, sf: str) -> DataFrame:
    orders = td.table(spark, sf, "orders")
    return leaderboard.best_per_group(
        orders,
        group_cols=["o_orderpriority"],
        metric_col="o_totalprice",
        seq_col="o_orderkey",
        payload=["o_orderkey", "o_custkey"],
    )


@register(
    "m9_time_folds",
    f"""WITH {TX_CTE},
r AS (SELECT TransactionDT, row_number() OVER (ORDER BY TransactionDT, TransactionID) - 1 AS rn0,
             count(*) OVER () AS n FROM tx),
f AS (SELECT unnest(range(0, 5)) AS fold),
a AS (SELECT f.fold, r.TransactionDT,
             CASE WHEN rn0 < n - (5 - f.fold) * (n // 6) THEN 'train'
                  WHEN rn0 < n - (5 - f.fold) * (n // 6) + (n // 6) THEN 'test' END AS role
      FROM r, f)
SELECT CAST(fold AS INTEGER) AS fold, role, count(*) AS n_rows, min(TransactionDT) AS min_time, max(TransactionDT) AS max_time
FROM a WHERE role IS NOT NULL GROUP BY fold, role""",
)
def q_folds(spark: SparkSession, sf: str) -> DataFrame:
    return split.time_series_folds(tx(spark, sf))


# --------------------------------------------------------------------------- #
# Sources and sinks: S1/S4 CSV, S3 Parquet, S5/S6 store, S7 JSON, S8, S12
# --------------------------------------------------------------------------- #

from vigil.session import work_path  # noqa: E402
from vigil.sources import io  # noqa: E402


@register("s1_csv_roundtrip", f"WITH {TX_CTE} SELECT * FROM tx")
def q_csv_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf)
    path = work_path(spark, "csv")
    io.write_csv(t, path)
    return io.read_csv(spark, path, t.schema)


@register(
    "s3_features_roundtrip",
    f"WITH {TX_CTE} SELECT * EXCLUDE (f_sparse) FROM tx",
)
def q_features_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    features = profile.convert_categoricals(
        profile.filter_columns_by_missingness(tx(spark, sf)), td.CATEGORICAL_FEATURES
    )
    path = work_path(spark, "features")
    io.write_parquet(features, path)
    return io.read_parquet(spark, path)


@register(
    "s5_store_roundtrip",
    f"""WITH {STORE_CTE}
SELECT TransactionID, arg_max(score, batch_id) AS score, arg_max(decision, batch_id) AS decision,
       CAST(max(batch_id) AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n_appends
FROM store GROUP BY TransactionID""",
)
def q_store_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    derived = scored_store(spark, sf)
    path = work_path(spark, "store")
    for b in (0, 1):
        store.append_scores(derived.filter(F.col("batch_id") == b), path)  # next batch id
    st = store.read_store(spark, path)
    appends = st.groupBy(td.ID).agg(F.count(F.lit(1)).alias("n_appends"))
    latest = store.latest_scores(st).select(td.ID, "score", "decision", "batch_id")
    return latest.join(appends, td.ID)


@register(
    "s7_json_props",
    """SELECT event_id,
       TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       array_to_string(list_sort(list_filter(json_keys(props), lambda x: x <> 'k')), '; ') AS unknown_keys,
       CASE WHEN json_extract_string(props, '$.k') IS NOT NULL
             AND TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) IS NULL THEN 'k' ELSE '' END AS bad_values
FROM events""",
)
def q_json_props(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T

    ev = td.table(spark, sf, "events")
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return io.parse_json_payloads(ev, "props", schema, keep=["event_id"])


@register(
    "s8_report_json",
    _METRICS_SQL
    + " SELECT feature, kind, n_ref, n_cur, round(statistic, 9) AS statistic, dof, round(p_value, 9) AS p_value FROM metrics",
)
def q_report_json(spark: SparkSession, sf: str) -> DataFrame:
    ref, cur = drift_inputs(spark, sf)
    metrics = _rounded_metrics(drift.compute_drift(ref, cur, feature_columns=td.CONTRACT_FEATURES))
    path = work_path(spark, "drift-report")
    io.write_report_json(metrics, path)
    return io.read_report_json(spark, path, drift.METRICS_SCHEMA)


@register(
    "s12_submission",
    f"WITH {SLICED_CTE} SELECT TransactionID, {CHAMPION_SQL} AS score FROM sliced WHERE slice = 'stream'",
)
def q_submission(spark: SparkSession, sf: str) -> DataFrame:
    from pyspark.sql import types as T

    unlabeled = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    scored = _champion_boundary().score(unlabeled, keep=[td.ID])
    path = work_path(spark, "submission")
    io.write_submission(scored, path)
    schema = T.StructType([T.StructField(td.ID, T.LongType()), T.StructField("score", T.DoubleType())])
    return io.read_csv(spark, path, schema)


# --------------------------------------------------------------------------- #
# ST1/ST2 streaming scoring into the store
# --------------------------------------------------------------------------- #


@register(
    "st1_stream_scoring",
    f"""WITH {SLICED_CTE}
SELECT TransactionID, {CHAMPION_SQL} AS score,
       CASE WHEN {CHAMPION_SQL} >= 0.5 THEN 'block' ELSE 'allow' END AS decision
FROM sliced WHERE slice = 'stream'""",
)
def q_stream_scoring(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.streaming import scoring as st_scoring

    stream_rows = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    source = work_path(spark, "replay")
    stream_rows.write.parquet(source)
    store_path = work_path(spark, "stream-store")
    st_scoring.run_scoring_stream(
        spark,
        source,
        stream_rows.schema,
        _champion_boundary(),
        store_path,
        work_path(spark, "stream-ckpt"),
        max_files_per_trigger=1,
    )
    return store.latest_scores(store.read_store(spark, store_path)).select(td.ID, "score", "decision")


# --------------------------------------------------------------------------- #
# M10 exact medians / imputation, M3 seed champion, M4 challenger, M11
# --------------------------------------------------------------------------- #


@register(
    "m10_medians",
    f"WITH {TX_CTE} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round(median(CAST({c} AS DOUBLE)), 9) AS median FROM tx"
        for c in _NUMERIC_CONTRACT
    ),
)
def q_medians(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.operators import models

    out = models.exact_medians(tx(spark, sf), _NUMERIC_CONTRACT)
    return out.withColumn("median", F.round("median", 9))


@register(
    "m10_impute_rows",
    f"""WITH {TX_CTE}
SELECT TransactionID, coalesce(f_partial, (SELECT median(f_partial) FROM tx)) AS f_partial,
       CAST(f_partial IS NULL AS INTEGER) AS f_partial_missing,
       coalesce(cat_b, 'missing') AS cat_b
FROM tx""",
)
def q_impute_rows(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.operators import models

    t = tx(spark, sf).select(td.ID, "f_partial", "cat_b")
    imputed, _ = models.impute_exact(t, ["f_partial"], ["cat_b"])
    return imputed.select(td.ID, "f_partial", "f_partial_missing", "cat_b")


# --------------------------------------------------------------------------- #
# P8/P9 complete rows, V9 score range, W5 placement values
# --------------------------------------------------------------------------- #

_COMPLETE_SQL = " AND ".join(f"NOT {_missing_sql(c)}" for c in td.CONTRACT_FEATURES)


@register(
    "p8_complete_rows",
    f"WITH {SLICED_CTE} SELECT TransactionID, TransactionDT FROM sliced WHERE slice = 'stream' AND {_COMPLETE_SQL}",
)
def q_complete_rows(spark: SparkSession, sf: str) -> DataFrame:
    stream = sliced(spark, sf).filter(F.col("slice") == "stream")
    return stream.na.drop("any", subset=list(td.CONTRACT_FEATURES)).select(td.ID, td.TIME)


@register(
    "p8_incomplete_count",
    f"""WITH {SLICED_CTE}
SELECT count(*) FILTER (WHERE NOT ({_COMPLETE_SQL})) AS n_incomplete, count(*) FILTER (WHERE {_COMPLETE_SQL}) AS n_complete
FROM sliced WHERE slice = 'stream'""",
)
def q_incomplete_count(spark: SparkSession, sf: str) -> DataFrame:
    stream = sliced(spark, sf).filter(F.col("slice") == "stream")
    complete = F.lit(True)
    for c in td.CONTRACT_FEATURES:
        complete = complete & ~(F.col(c).isNull() | (F.isnan(c) if c in _DOUBLE_COLUMNS else F.lit(False)))
    return stream.agg(F.count_if(~complete).alias("n_incomplete"), F.count_if(complete).alias("n_complete"))


@register(
    "v9_score_range",
    f"""WITH {SLICED_CTE}, s AS (SELECT {CHAMPION_SQL} AS score FROM sliced WHERE slice = 'stream')
SELECT count(*) AS n_rows, count(*) FILTER (WHERE score IS NULL OR isnan(score) OR score < 0 OR score > 1) AS n_out_of_range,
       min(score) AS min_score, max(score) AS max_score FROM s""",
)
def q_score_range(spark: SparkSession, sf: str) -> DataFrame:
    stream = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    scored = _champion_boundary().score(stream, keep=[td.ID])
    s = F.col("score")
    bad = s.isNull() | F.isnan(s) | (s < 0) | (s > 1)
    return scored.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(bad).alias("n_out_of_range"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
    )


@register(
    "w5_placements",
    f"""WITH {SLICED_CTE},
gate AS (SELECT CASE WHEN isFraud = 1 THEN 1 ELSE 0 END AS y, {CHAMPION_SQL} AS a FROM sliced WHERE slice = 'test'),
{_PLACE_SQL.format(p='pa_t', s='a')}
SELECT v AS score, pp, pn FROM pa_t""",
)
def q_placements(spark: SparkSession, sf: str) -> DataFrame:
    test = sliced(spark, sf).filter(F.col("slice") == "test").select(
        (F.col(td.LABEL) == 1).cast("int").alias("y"), td.champion_score().alias("a")
    )
    return promote.placements(test, label_col="y", score_cols=["a"]).select("score", "pp", "pn")


# --------------------------------------------------------------------------- #
# ST4 late labels: stream-stream join within the reveal lag
# --------------------------------------------------------------------------- #

_LABEL_LAG_SECONDS = 3600  # a label counts when it arrives within one hour


@register(
    "st4_label_join",
    f"""WITH {SLICED_CTE}
SELECT TransactionID, {CHAMPION_SQL} AS score, isFraud
FROM sliced WHERE slice = 'stream' AND k * 60 <= {_LABEL_LAG_SECONDS}""",
)
def q_label_join(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.streaming import labels

    stream = sliced(spark, sf).filter(F.col("slice") == "stream")
    events = labels.with_event_time(
        stream.select(td.ID, td.TIME, td.champion_score().alias("score")), td.TIME, "event_ts"
    ).drop(td.TIME)
    # label events: each stream row's label arrives k minutes after the event
    label_events = labels.with_event_time(
        stream.select(td.ID, td.LABEL, (F.col(td.TIME) + F.col("k") * 60).alias("label_time")), "label_time", "label_ts"
    ).drop("label_time")
    ev_path, lab_path, out_path = (work_path(spark, n) for n in ("scored-events", "label-events", "revealed"))
    events.write.parquet(ev_path)
    label_events.write.parquet(lab_path)
    ev_stream = spark.readStream.schema(events.schema).parquet(ev_path)
    lab_stream = spark.readStream.schema(label_events.schema).parquet(lab_path)
    joined = labels.revealed_labels(ev_stream, lab_stream, lag_seconds=_LABEL_LAG_SECONDS)
    with labels.state_partitions(spark, spark.sparkContext.defaultParallelism):
        query = (
            joined.writeStream.format("parquet")
            .option("path", out_path)
            .option("checkpointLocation", work_path(spark, "revealed-ckpt"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(joined.schema).parquet(out_path).select(td.ID, "score", td.LABEL)



# --------------------------------------------------------------------------- #
# ST4 reveal timers, ST3 exact replays
# --------------------------------------------------------------------------- #

_PATIENCE = 43200.0  # half a day more for labels that are late


@register(
    "st4_reveal_timers",
    f"""WITH {SLICED_CTE}, r AS (
  SELECT TransactionID, {CHAMPION_SQL} AS score, TransactionDT AS t, CASE WHEN k % 5 <> 0 THEN isFraud END AS label,
         max(greatest(TransactionDT, CASE WHEN k % 5 <> 0 THEN TransactionDT + k * 60 ELSE 0 END)) OVER () AS now
  FROM sliced WHERE slice = 'stream'
)
SELECT TransactionID, score, label AS isFraud, CASE WHEN label IS NULL THEN 'unlabelled' ELSE 'revealed' END AS outcome
FROM r WHERE t + CASE WHEN label IS NULL THEN {_LAG + _PATIENCE} ELSE {_LAG} END <= now""",
)
def q_reveal_timers(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows and labels as one stream: labels leave once the lag has passed, rows without one on the side."""
    from vigil.streaming import labels, reveal

    rows = sliced(spark, sf).filter(F.col("slice") == "stream")
    at = F.timestamp_seconds(td.TIME)
    none = lambda kind: F.lit(None).cast(kind)
    column = lambda c, name: c.alias(name)
    scored = rows.select(
        column(F.col(td.ID), "id"), column(F.lit(0).cast("long"), "seq"), column(td.champion_score(), "score"),
        column(none("int"), "label"), column(at, "event_ts"), column(at, "at"),
    )
    told = rows.filter("k % 5 <> 0").select(
        column(F.col(td.ID), "id"), column(F.lit(0).cast("long"), "seq"), column(none("double"), "score"),
        column(F.col(td.LABEL).cast("int"), "label"), column(none("timestamp"), "event_ts"),
        column(F.timestamp_seconds(F.col(td.TIME) + F.col("k") * 60), "at"),
    )
    source, target = work_path(spark, "records"), work_path(spark, "outcomes")
    records = scored.unionByName(told)
    records.write.parquet(source)
    stream = spark.readStream.schema(records.schema).parquet(source)
    with reveal.rocksdb_state(spark), labels.state_partitions(spark, spark.sparkContext.defaultParallelism):
        out = reveal.reveal(stream, lag_seconds=_LAG, patience_seconds=_PATIENCE)
        query = (
            out.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", work_path(spark, "outcomes-ckpt"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.schema(out.schema).parquet(target).select(
        F.col("id").alias(td.ID), "score", F.col("label").alias(td.LABEL), "outcome"
    )


@register(
    "st3_exact_replays",
    f"""WITH {SLICED_CTE}, r AS (SELECT TransactionID, {CHAMPION_SQL} AS score, cat_a, k FROM sliced WHERE slice = 'stream'),
passed AS (
  SELECT TransactionID, score FROM r
  UNION ALL SELECT TransactionID, score + 1 FROM r WHERE cat_a = 'error'
  UNION ALL SELECT TransactionID, score FROM r WHERE k < 10
)
SELECT TransactionID, CAST(count(*) AS BIGINT) AS n_passed, max(score) AS score FROM passed GROUP BY TransactionID""",
)
def q_exact_replays(spark: SparkSession, sf: str) -> DataFrame:
    """Replays inside the delay are dropped; other payloads pass, and so do replays long after."""
    from vigil.streaming import labels, replays, reveal

    rows = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, td.champion_score().alias("score"), "cat_a", "k")
    source, target = work_path(spark, "replayed"), work_path(spark, "passed")
    told = lambda df, minute: df.select(td.ID, "score", F.timestamp_seconds(F.lit(minute * 60)).alias("at"))
    errors = rows.filter("cat_a = 'error'").withColumn("score", F.col("score") + 1)
    ahead = spark.range(1).select(F.lit(-1).cast("long").alias(td.ID), F.lit(0.0).alias("score"))
    parts = [
        told(rows, 0).unionByName(told(rows.filter("k % 3 = 0"), 0)),  # repeated within a micro-batch
        told(rows, 20).unionByName(told(errors, 20)),  # and in the next one
        told(ahead, 600),  # the delay has passed
        told(ahead.withColumn("score", F.lit(1.0)), 605),
        told(rows.filter("k < 10"), 610),
    ]
    for part in parts:  # a file each, one micro-batch each
        part.coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(parts[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
    with reveal.rocksdb_state(spark), labels.state_partitions(spark, spark.sparkContext.defaultParallelism):
        out = replays.without_replays(stream, id_col=td.ID, time_col="at", payload=["score"], delay="1 hour")
        query = (
            out.writeStream.format("parquet")
            .option("path", target)
            .option("checkpointLocation", work_path(spark, "passed-ckpt"))
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    passed = spark.read.schema(out.schema).parquet(target).filter(F.col(td.ID) >= 0)
    return passed.groupBy(td.ID).agg(F.count(F.lit(1)).alias("n_passed"), F.max("score").alias("score"))


# --------------------------------------------------------------------------- #
# M12 monitoring pass: next unseen chunk -> store -> drift -> decision
# --------------------------------------------------------------------------- #

_M12_CTE = (
    SLICED_CTE
    + f""",
ref AS (SELECT {_FEATS}, {CHAMPION_SQL} AS score FROM sliced WHERE slice = 'train'),
cur AS (
  SELECT {_FEATS}, {CHAMPION_SQL} AS score FROM sliced WHERE slice = 'stream'
)"""
    + _KS_PART
    + _CHI_CTE
    + _METRICS_PART
)


@register(
    "m12_monitoring_pass",
    f"WITH {_M12_CTE}" + _DECISION_SQL.replace(
        "FROM metrics",
        ", (SELECT count(*) FROM cur) AS n_scored, (SELECT count(*) FROM cur) AS n_current, "
        "(SELECT count(*) FROM ref) AS n_reference, alarm AS triggered_retraining FROM metrics",
    ),
)
def q_monitoring_pass(spark: SparkSession, sf: str) -> DataFrame:
    from vigil.plans import monitoring

    out = monitoring.monitoring_pass(
        tx(spark, sf),
        _champion_boundary(),
        work_path(spark, "monitor-store"),
        report_path=work_path(spark, "monitor-report"),
        on_alarm=lambda: None,
        cuts=cuts(spark, sf),
    )
    d = out.decision
    row = [(d["n_features"], d["n_drifted"], d["feature_fraction"], d["feature_alarm"], d["score_distance"],
            d["score_alarm"], d["alarm"], out.n_scored, out.n_current, out.n_reference, out.triggered_retraining)]
    return spark.createDataFrame(
        row,
        "n_features long, n_drifted long, feature_fraction double, feature_alarm boolean, score_distance double, "
        "score_alarm boolean, alarm boolean, n_scored long, n_current long, "
        "n_reference long, triggered_retraining boolean",
    )


# --------------------------------------------------------------------------- #
# V3 on raw text input: CSV read as text, numeric checks row by row
# --------------------------------------------------------------------------- #


@register(
    "v3_raw_text_quarantine",
    f"WITH {TX_CTE}, r AS (SELECT TransactionID, concat_ws('; ', "
    + ", ".join(f"CASE WHEN {c} IS NULL THEN 'null: {c}' END" for c in td.CONTRACT_FEATURES)
    + ") AS reasons FROM tx) SELECT TransactionID, reasons = '' AS accepted, reasons FROM r",
)
def q_raw_text_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    t = tx(spark, sf).select(td.ID, *td.CONTRACT_FEATURES)
    path = work_path(spark, "raw-csv")
    io.write_csv(t, path)
    raw = io.read_csv_text(spark, path, t.columns)  # every column as text
    tagged = contract.tag_rows(raw, _CONTRACT)  # try_cast checks for numeric contract columns
    return tagged.select(F.col(td.ID).cast("long").alias(td.ID), "accepted", "reasons")


# --------------------------------------------------------------------------- #
# checks of whole flows: CSV score job, shared store, NULL times, rejected scores
# --------------------------------------------------------------------------- #

_BAD_AMOUNT = "CASE WHEN TransactionID % 97 = 0 THEN 'n/a' WHEN TransactionID % 89 = 0 THEN 'NaN' END"
_BAD_ID = "CASE WHEN TransactionID % 83 = 0 THEN 'abc' WHEN TransactionID % 79 = 0 THEN '' WHEN TransactionID % 73 = 0 THEN ' ' END"


def _score_job(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Raw CSV with its columns in another order, bad amounts and bad ids -> (store, rejects)."""
    from vigil.plans.scoring_job import score_csv

    rows = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    text = rows.select(*reversed([F.col(c).cast("string").alias(c) for c in rows.columns]))
    text = text.withColumns(
        {"amount": F.coalesce(F.expr(_BAD_AMOUNT), F.col("amount")), td.ID: F.coalesce(F.expr(_BAD_ID.replace(td.ID, f"cast({td.ID} as bigint)")), F.col(td.ID))}
    )
    source, store_path, rejects = (work_path(spark, n) for n in ("job-in", "job-store", "job-rejects"))
    io.write_csv(text, source)
    boundary = _champion_boundary(require_complete=True)
    score_csv(spark, source, work_path(spark, "job-out"), boundary, store_path, rejects=rejects)
    columns = [td.ID, *td.CONTRACT_FEATURES, "reasons"]
    return store.read_store(spark, store_path), io.read_csv_text(spark, rejects, columns)


@register(
    "s4_csv_score_job",
    f"""WITH {SLICED_CTE}, r AS (
  SELECT TransactionID, {CHAMPION_SQL} AS score,
         TransactionID % 97 <> 0 AND TransactionID % 89 <> 0 AND TransactionID % 83 <> 0 AND TransactionID % 79 <> 0
         AND TransactionID % 73 <> 0
         {''.join(f' AND {c} IS NOT NULL' for c in td.CONTRACT_FEATURES)} AS ok
  FROM sliced WHERE slice = 'stream')
SELECT TransactionID, score, CASE WHEN score >= 0.5 THEN 'block' ELSE 'allow' END AS decision FROM r WHERE ok""",
)
def q_csv_score_job(spark: SparkSession, sf: str) -> DataFrame:
    return _score_job(spark, sf)[0].select(td.ID, "score", "decision")


@register(
    "s4_csv_rejects",
    f"""WITH {SLICED_CTE}, r AS (
  SELECT concat_ws('; ', CASE WHEN TransactionID % 83 = 0 THEN 'bad id' WHEN TransactionID % 79 = 0 OR TransactionID % 73 = 0 THEN 'missing id' END,
         {', '.join(f"""CASE WHEN TransactionID % 97 = 0 THEN 'not numeric: amount' WHEN TransactionID % 89 = 0 THEN 'null: amount' WHEN {c} IS NULL THEN 'null: {c}' END"""
                     if c == 'amount' else f"CASE WHEN {c} IS NULL THEN 'null: {c}' END" for c in td.CONTRACT_FEATURES)}) AS reasons
  FROM sliced WHERE slice = 'stream')
SELECT reasons, count(*) AS n_rows FROM r WHERE reasons <> '' GROUP BY reasons""",
)
def q_csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """The rows the score job turns away, by reasons: broken values, missing and unusable ids."""
    return _score_job(spark, sf)[1].groupBy("reasons").agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "s5_manifest_log",
    f"""WITH {SLICED_CTE}, rows AS (
  SELECT *, CASE WHEN TransactionID % 2 = 0 THEN 'even' ELSE 'odd' END AS w, TransactionID % 3 AS b FROM sliced WHERE slice = 'stream'
), appends AS (
  SELECT TransactionID, {CHAMPION_SQL} AS score, 0 AS later FROM rows
  UNION ALL SELECT TransactionID, {CHALLENGER_SQL}, 1 FROM rows WHERE cat_a = 'error'
)
SELECT TransactionID, arg_max(score, later) AS score, count(*) AS n_appends,
       (SELECT count(*) FROM appends) AS log_total, (SELECT count(*) FROM appends WHERE later = 0) AS first_total,
       9 AS n_versions
FROM appends GROUP BY TransactionID""",
)
def q_manifest_log(spark: SparkSession, sf: str) -> DataFrame:
    """Two writers, a crash between write and commit, replays and compactions in one store."""
    rows = sliced(spark, sf).filter(F.col("slice") == "stream").select(
        td.ID, td.champion_score().alias("score"), td.challenger_score().alias("again"), F.lit("allow").alias("decision"), "cat_a"
    )
    path = work_path(spark, "log-store")
    parity = {"even": 0, "odd": 1}
    for b in range(3):
        for writer, odd in parity.items():
            part = rows.filter((F.col(td.ID) % 2 == odd) & (F.col(td.ID) % 3 == b))
            if b == 1:  # written, and lost before the commit; then the same micro-batch again
                store.stage_scores(part, path)
            for _ in range(2):  # the second is a replay after the commit
                store.append_scores(part, path, writer=writer, micro_batch=b)
        if b == 1:
            store.compact(spark, path)
    before = Manifest(spark, path).latest()
    errors = rows.filter("cat_a = 'error'").select(td.ID, F.col("again").alias("score"), "decision")
    store.append_scores(errors, path)
    store.compact(spark, path)
    log = Manifest(spark, path).latest()
    first_total = store.read_store(spark, path, version=before.version).count()  # the older snapshot is as it was
    st = store.read_store(spark, path)
    latest = store.latest_scores(st).select(td.ID, "score")
    return latest.join(st.groupBy(td.ID).agg(F.count(F.lit(1)).alias("n_appends")), td.ID).withColumns(
        {"log_total": F.lit(log.total), "first_total": F.lit(first_total), "n_versions": F.lit(log.version + 1)}
    )


@register(
    "st3_shared_store",
    f"""WITH {SLICED_CTE}
SELECT TransactionID, {CHAMPION_SQL} AS score, 3 AS n_appends, 3 AS n_batches FROM sliced WHERE slice = 'stream'""",
)
def q_shared_store(spark: SparkSession, sf: str) -> DataFrame:
    """A batch append, then the same rows by a stream's sink whose micro-batches are replayed, in one store.

    The first micro-batch is staged and not committed, then comes again; the
    second comes again after its commit; then a stream over the same rows finds
    its own micro-batches committed when its checkpoint is lost.
    """
    from vigil.streaming import scoring as st_scoring

    boundary = _champion_boundary()
    rows = sliced(spark, sf).filter(F.col("slice") == "stream").select(td.ID, *td.CONTRACT_FEATURES)
    source, path = work_path(spark, "shared-in"), work_path(spark, "shared-store")
    rows.write.parquet(source)
    scored = boundary.score(rows, keep=[td.ID], validate_rows=False)
    store.append_scores(scored, path)
    store.stage_scores(scored, path)  # a micro-batch that died before its commit
    sink = st_scoring.scoring_batch_sink(boundary, path, writer="replayed")
    batch = spark.read.schema(rows.schema).parquet(source)
    for micro_batch in (0, 0, 1, 1):
        sink(batch.filter(F.col(td.ID) % 2 == micro_batch), micro_batch)
    for checkpoint in ("first", "lost"):
        st_scoring.run_scoring_stream(
            spark, source, rows.schema, boundary, path, f"{path}-{checkpoint}", max_files_per_trigger=1000, writer="stream"
        )
    appends = store.read_store(spark, path)
    counts = appends.groupBy(td.ID).agg(F.count(F.lit(1)).alias("n_appends"), F.count_distinct("batch_id").alias("n_batches"))
    return store.latest_scores(appends).select(td.ID, "score").join(counts, td.ID)


@register(
    "w1_null_times",
    f"""WITH {TX_CTE}, t AS (
  SELECT TransactionID, CASE WHEN TransactionID % 10 < 3 THEN NULL ELSE TransactionDT END AS TransactionDT FROM tx
), n AS (SELECT count(*) AS n FROM t), r AS (
  SELECT *, row_number() OVER (ORDER BY TransactionDT NULLS LAST, TransactionID) AS k FROM t
)
SELECT CASE WHEN k <= round_even(n * 0.7, 0) THEN 'train' WHEN k <= round_even(n * (0.7 + 0.15), 0) THEN 'test' ELSE 'stream' END AS slice,
       count(*) AS n_rows, count(TransactionDT) AS n_times
FROM r, n GROUP BY 1""",
)
def q_null_times(spark: SparkSession, sf: str) -> DataFrame:
    """The split where three rows in ten have no time: those rows come last and none is lost."""
    rows = tx(spark, sf).select(
        td.ID, F.when(F.col(td.ID) % 10 >= 3, F.col(td.TIME)).alias(td.TIME)
    )
    return split.with_slice(rows).groupBy("slice").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count(td.TIME).alias("n_times")
    )


@register(
    "a4_rejected_scores",
    f"""WITH {SLICED_CTE}
SELECT 'score' AS scorer, count(*) FILTER (TransactionID % 13 < 2) AS n_rejected FROM sliced""",
)
def q_rejected_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores that can't be ranked, NULL or NaN, are counted; ranking them raises."""
    score = F.when(F.col(td.ID) % 13 == 0, F.lit(None).cast("double")).when(
        F.col(td.ID) % 13 == 1, F.lit(float("nan"))
    ).otherwise(td.champion_score().cast("double"))
    return evaluate.rejected_scores(sliced(spark, sf).select(score.alias("score")), ["score"])


@register(
    "a18_volume_trigger",
    f"""WITH {STORE_CTE}, v AS (SELECT count(*) AS n, count(*) // 3 AS seen FROM store)
SELECT n - seen AS volume_since_last, seen AS last_count, n - seen >= 5000 AS retrain FROM v""",
)
def q_volume_trigger(spark: SparkSession, sf: str) -> DataFrame:
    """Volume since the newest checkpoint row of the state table."""
    st, state = scored_store(spark, sf), work_path(spark, "retrain-state")
    total = st.count()
    trigger.write_state(spark, state, store_row_count=total // 3)
    volume = trigger.accumulated_volume(st, trigger.read_state(spark, state))
    row = trigger.retrain_decision(spark, volume)
    return spark.createDataFrame(
        [(row.volume_since_last, total // 3, row.retrain)], "volume_since_last long, last_count long, retrain boolean"
    )


@register(
    "p5_features_and_label",
    f"""WITH {TX_CTE}
SELECT isFraud, count(*) AS n_rows, round(sum(amount), 2) AS amount FROM tx GROUP BY 1""",
)
def q_features_and_label(spark: SparkSession, sf: str) -> DataFrame:
    """Features and label stay on their rows; absent columns to drop don't matter."""
    features, label = profile.prepare_data(profile.drop_present(tx(spark, sf), [td.TIME, "not there"]))
    return features.groupBy(label).agg(F.count(F.lit(1)).alias("n_rows"), F.round(F.sum("amount"), 2).alias("amount"))


# queries of the model operators register themselves
from vigil.plans import model_queries  # noqa: E402, F401
