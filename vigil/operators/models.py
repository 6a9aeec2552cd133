"""Spark ML fitting and scoring.

* M10 preprocessing: numeric features get a missing indicator and median
  imputation (Spark trees reject NaN vectors); categoricals get a ``missing``
  level, a ``StringIndexer`` with ``handleInvalid="keep"`` (unseen levels go
  to an extra index) and, for linear models, a one-hot encoder.
* M1 fit: ``Pipeline(prep..., VectorAssembler, classifier)`` on the train slice.
* M2 score: ``PipelineModel.transform`` + ``vector_to_array(probability)[1]``
  (or the raw margin for classifiers without probabilities), appended to the
  same rows — no join back.
* S10 save/load: versions of the fitted pipeline with its contract JSON on the
  cluster file system, published by a pointer written last; ``resolve_model``
  prefers the served model, else seed.
* Medians are exact (``exact_medians``) and go into the pipeline as a SQL stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LinearSVC,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.ordered import prefix_sums, rows_at_ranks
from vigil.operators.contract import Contract
from vigil.operators.discriminant import LinearDiscriminant
from vigil.session import path_exists, written

MISSING_LEVEL = "missing"


# --------------------------------------------------------------------------- #
# M10 preprocessing
# --------------------------------------------------------------------------- #


def exact_median(df: DataFrame, column: str) -> float | None:
    """Exact median (linear interpolation between the two middle values).

    Uses the range-bucketed rank lookup: only the bucket(s) holding the middle
    rank(s) are sorted; no value list is ever gathered in one place.
    """
    values = df.select(F.col(f"`{column}`").cast("double").alias("v")).where(
        F.col("v").isNotNull() & ~F.isnan("v")
    )
    n, found = rows_at_ranks(values, ["v"], lambda n: [(n + 1) // 2, n // 2 + 1])
    if n == 0:
        return None
    lo, hi = found[(n + 1) // 2]["v"], found[n // 2 + 1]["v"]
    return lo if lo == hi else lo + (hi - lo) * 0.5


def exact_medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact medians of many columns in one ordered pass: ``(column_name, median)``.

    Values are unpivoted and collapsed to ``(column, value, count)`` (partial
    aggregation), the shared prefix sum runs per column, and each column's
    middle rank(s) are picked by range predicates on the running count —
    nothing per column is gathered on the driver.
    """
    cols = list(columns)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column_name string, median double")
    long = (
        df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
        .unpivot([], cols, "column_name", "v")
        .where(F.col("v").isNotNull() & ~F.isnan("v"))
    )
    counts = long.groupBy("column_name", "v").agg(F.count(F.lit(1)).alias("c"))
    cum = prefix_sums(counts, ["v"], ["c"], by=["column_name"], totals=True)
    lo_rank = F.floor((F.col("tot_c") + 1) / 2)
    hi_rank = F.floor(F.col("tot_c") / 2) + 1
    first = F.col("cum_c") - F.col("c")  # ranks first+1 .. cum_c hold value v

    def holds(rank):
        return (first < rank) & (rank <= F.col("cum_c"))

    picked = cum.where(holds(lo_rank) | holds(hi_rank)).groupBy("column_name").agg(
        F.min_by("v", F.when(holds(lo_rank), 0).otherwise(1)).alias("lo"),
        F.max_by("v", F.when(holds(hi_rank), 1).otherwise(0)).alias("hi"),
    )
    median = F.when(F.col("lo") == F.col("hi"), F.col("lo")).otherwise(
        F.col("lo") + (F.col("hi") - F.col("lo")) * 0.5
    )
    listed = spark.createDataFrame([(c,) for c in cols], "column_name string")
    return listed.join(picked.select("column_name", median.alias("median")), "column_name", "left")


def column_medians(df: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians by column, for fits that share their rows."""
    return {r["column_name"]: r["median"] for r in exact_medians(df, columns).collect()}


def impute_exact(
    df: DataFrame, numeric: Sequence[str], categorical: Sequence[str] = ()
) -> tuple[DataFrame, dict[str, float | None]]:
    """Median-impute numeric columns (exact medians) with ``<c>_missing``
    indicators; categorical NULLs become the ``missing`` level."""
    medians = column_medians(df, numeric)
    out = df
    for c in numeric:
        col = F.col(f"`{c}`")
        missing = col.isNull() | F.isnan(col.cast("double"))
        out = out.withColumn(f"{c}_missing", missing.cast("int")).withColumn(
            c, F.when(missing, F.lit(medians[c])).otherwise(col.cast("double"))
        )
    for c in categorical:
        out = out.withColumn(c, F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_LEVEL)))
    return out, medians


def preprocessing_stages(
    numeric: Sequence[str], categorical: Sequence[str], *, medians: dict[str, float | None], one_hot: bool = False
) -> tuple[list, list[str]]:
    """Stages and assembled input columns for the M10 preprocessing."""
    numeric, categorical = list(numeric), list(categorical)
    stages: list = []
    inputs: list[str] = []
    if numeric:
        imputed = [f"{c}__imp" for c in numeric]
        filled = ", ".join(
            f"coalesce(`{c}__num`, {'0D' if medians.get(c) is None else repr(float(medians[c])) + 'D'}) AS `{c}__imp`" for c in numeric
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
        inputs += imputed + [f"{c}__isna" for c in numeric]
    if categorical:
        idx = [f"{c}__idx" for c in categorical]
        stages.append(StringIndexer(inputCols=[f"{c}__cat" for c in categorical], outputCols=idx, handleInvalid="keep"))
        if one_hot:
            ohe = [f"{c}__ohe" for c in categorical]
            stages.append(OneHotEncoder(inputCols=idx, outputCols=ohe, handleInvalid="keep"))
            inputs += ohe
        else:
            inputs += idx
    return stages, inputs


def with_model_inputs(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """Columns the preprocessing stages read: NaN-normalised doubles, missing
    indicators, and categoricals with a ``missing`` level."""
    cols = {}
    for c in numeric:
        v = F.col(f"`{c}`").cast("double")
        cols[f"{c}__num"] = F.when(F.isnan(v), F.lit(None).cast("double")).otherwise(v)
        cols[f"{c}__isna"] = (v.isNull() | F.isnan(v)).cast("double")
    for c in categorical:
        cols[f"{c}__cat"] = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_LEVEL))
    return df.withColumns(cols)


# --------------------------------------------------------------------------- #
# M1 fit, M2 score, M11 baselines
# --------------------------------------------------------------------------- #


def classifier(kind: str = "gbt", *, label_col: str = "isFraud", seed: int = 7, **params):
    """A classifier by name (gbt, rf, logreg, svc, lda)."""
    common = {"labelCol": "_label", "featuresCol": "_features"}
    if kind == "gbt":
        return GBTClassifier(seed=seed, maxIter=params.pop("maxIter", 40), maxDepth=params.pop("maxDepth", 4), **common, **params)
    if kind == "rf":
        return RandomForestClassifier(seed=seed, numTrees=params.pop("numTrees", 50), **common, **params)
    if kind == "logreg":
        return LogisticRegression(maxIter=params.pop("maxIter", 50), **common, **params)
    if kind == "svc":
        return LinearSVC(maxIter=params.pop("maxIter", 50), **common, **params)
    if kind == "lda":
        return LinearDiscriminant(**common, **params)
    raise ValueError(f"unknown classifier kind {kind!r}")


def fit(
    train: DataFrame,
    contract_features: Sequence[str],
    categorical: Sequence[str],
    *,
    label_col: str = "isFraud",
    kind: str = "gbt",
    medians: dict[str, float | None] | None = None,
    **params,
) -> PipelineModel:
    """M1: fit ``prep + assembler + classifier`` on ``train``; ``medians`` as ``column_medians`` gives them, if known."""
    numeric = [c for c in contract_features if c not in set(categorical)]
    one_hot = kind in ("logreg", "svc", "lda")
    if medians is None:
        medians = column_medians(train, numeric)
    stages, inputs = preprocessing_stages(numeric, categorical, medians=medians, one_hot=one_hot)
    if kind in ("gbt", "rf") and categorical:
        # trees need a bin per level: count the levels, plus the missing and the unseen one
        levels = train.agg(*[F.count_distinct(f"`{c}`").alias(c) for c in categorical]).first()
        params = {"maxBins": max(32, *[levels[c] + 2 for c in categorical]), **params}
    assembler = VectorAssembler(inputCols=inputs, outputCol="_features", handleInvalid="keep")
    pipe = Pipeline(stages=[*stages, assembler, classifier(kind, label_col=label_col, **params)])
    data = with_model_inputs(train, numeric, categorical).withColumn(
        "_label", F.col(label_col).cast("double")
    )
    return pipe.fit(data)


class ModelScorer:
    """Scorer for :class:`ScoringBoundary`: appends ``score`` to the rows."""

    def __init__(self, model: PipelineModel, contract_features: Sequence[str], categorical: Sequence[str]):
        self.model = model
        self.numeric = [c for c in contract_features if c not in set(categorical)]
        self.categorical = list(categorical)

    def __call__(self, df: DataFrame) -> DataFrame:
        return score_frame(self.model, df, self.numeric, self.categorical)


def score_frame(
    model: PipelineModel, df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]
) -> DataFrame:
    """M2: ``df`` plus ``score`` (positive-class probability, or raw margin)."""
    original = df.columns
    out = model.transform(with_model_inputs(df, numeric, categorical))
    if "probability" in out.columns:
        score = vector_to_array("probability")[1]
    else:  # LinearSVC has no probabilities; its margin ranks the same way
        score = vector_to_array("rawPrediction")[1]
    return out.select(*[F.col(f"`{c}`") for c in original], score.cast("double").alias("score"))


def baseline_aucs(
    train: DataFrame,
    valid: DataFrame,
    contract_features: Sequence[str],
    categorical: Sequence[str],
    *,
    label_col: str = "isFraud",
    kinds: Sequence[str] = ("logreg", "svc", "lda", "rf", "gbt"),
) -> DataFrame:
    """Validation AUC per model kind (exact AUC from the shared primitive)."""
    from vigil.operators.evaluate import auc_frame

    scored = baseline_scores(train, valid, contract_features, categorical, label_col=label_col, kinds=kinds)
    return auc_frame(scored, label_col=label_col, by=["model"])


def baseline_scores(
    train: DataFrame,
    valid: DataFrame,
    contract_features: Sequence[str],
    categorical: Sequence[str],
    *,
    label_col: str = "isFraud",
    kinds: Sequence[str] = ("logreg", "svc", "lda", "rf", "gbt"),
) -> DataFrame:
    """``model, label, score`` of every validation row under every kind of model.

    All kinds read the same rows: both slices are written and the medians taken once.
    """
    numeric = [c for c in contract_features if c not in set(categorical)]
    train, valid = (
        written(df.select(*dict.fromkeys([label_col, *contract_features])), name)
        for df, name in ((train, "baseline-train"), (valid, "baseline-valid"))
    )
    medians = column_medians(train, numeric)
    scored = None
    for kind in kinds:
        model = fit(train, contract_features, categorical, label_col=label_col, kind=kind, medians=medians)
        s = score_frame(model, valid.select(label_col, *contract_features), numeric, categorical)
        s = s.select(F.lit(kind).alias("model"), label_col, "score")
        scored = s if scored is None else scored.unionByName(s)
    return scored


# --------------------------------------------------------------------------- #
# S10 save / load
# --------------------------------------------------------------------------- #


def save_model(spark: SparkSession, model: PipelineModel, contract: Contract, path: str) -> None:
    """Publish the pipeline and its contract (JSON) as the newest version under ``path``."""
    version = f"{path}/version-{uuid.uuid4().hex[:12]}"
    model.write().save(f"{version}/pipeline")
    spark.createDataFrame([(contract.to_json(),)], "contract string").coalesce(1).write.text(f"{version}/contract")
    # pointers are only ever added, numbered, and written last: a reader sees a
    # whole version, the old one until the new pointer is there
    number = max([n for n, _ in _pointers(spark, path)], default=0) + 1
    spark.createDataFrame([(version,)], "version string").coalesce(1).write.text(f"{path}/pointers/n={number}")


def _pointers(spark: SparkSession, path: str) -> list[tuple[int, str]]:
    if not path_exists(spark, f"{path}/pointers"):
        return []
    return [(int(r["n"]), r["value"]) for r in spark.read.text(f"{path}/pointers").collect()]


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, Contract]:
    version = max(_pointers(spark, path))[1]
    model = PipelineModel.load(f"{version}/pipeline")
    text = spark.read.text(f"{version}/contract").collect()[0][0]
    return model, Contract.from_json(text)


def resolve_model(spark: SparkSession, served_path: str, seed_path: str) -> str:
    """The served model when it exists, otherwise the seed."""
    return served_path if _pointers(spark, served_path) else seed_path
