"""M1 for categoricals of any width: ordered target statistics instead of level lists.

A level's statistic is its smoothed label rate, ``(positives + a * prior) /
(rows + a)``. A training row must not see its own label, so it gets the
statistic of the rows before it in time: one ordered prefix sum per column,
which splits a hot level over range buckets. Rows to be scored get the level's
final statistic by a join; levels that training hasn't seen get the prior. The
levels are a table, never a list on the driver or in the model.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.functions.ordered import prefix_sums
from vigil.operators import models
from vigil.session import written

#: Rows of the prior that a level's own rows are mixed with.
SMOOTHING = 10.0
SUFFIX = "__te"


def _level(c: str):
    return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(models.MISSING_LEVEL))


def _rate(positives, rows, prior: float, smoothing: float):
    return (positives + smoothing * prior) / (rows + smoothing)


def prior_rate(train: DataFrame, label_col: str) -> float:
    """The label rate of all rows; 0 without rows."""
    rate = train.agg(F.avg(F.col(f"`{label_col}`").cast("double"))).first()[0]
    return float(rate or 0.0)


def ordered_statistic(
    train: DataFrame, column: str, order: Sequence[str], *, label_col: str = "isFraud", prior: float, smoothing: float = SMOOTHING
) -> DataFrame:
    """``train`` plus ``<column>__te``: the statistic of the level's rows before each row in ``order`` (a unique key)."""
    rows = train.withColumns(
        {"_level": _level(column), "_positive": F.col(f"`{label_col}`").cast("long"), "_one": F.lit(1).cast("long")}
    )
    summed = prefix_sums(rows, list(order), ["_positive", "_one"], by=["_level"])
    before = _rate(F.col("cum__positive") - F.col("_positive"), F.col("cum__one") - 1, prior, smoothing)
    return summed.select(*[F.col(f"`{c}`") for c in train.columns], before.alias(f"{column}{SUFFIX}"))


def level_statistics(train: DataFrame, column: str, *, label_col: str = "isFraud", prior: float, smoothing: float = SMOOTHING) -> DataFrame:
    """``level, n_rows, encoding`` of all training rows; NULL is a level of its own."""
    counted = train.groupBy(_level(column).alias("level")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(f"`{label_col}`").cast("long")).alias("_positive")
    )
    return counted.select("level", "n_rows", _rate(F.col("_positive"), F.col("n_rows"), prior, smoothing).alias("encoding"))


@dataclass(frozen=True)
class TargetEncoder:
    """Level tables per column, and the prior of unseen levels."""

    tables: dict[str, DataFrame]
    prior: float

    @classmethod
    def fit(cls, train: DataFrame, columns: Sequence[str], *, label_col: str = "isFraud", smoothing: float = SMOOTHING) -> TargetEncoder:
        prior = prior_rate(train, label_col)
        tables = {c: written(level_statistics(train, c, label_col=label_col, prior=prior, smoothing=smoothing), "levels") for c in columns}
        return cls(tables, prior)

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``<column>__te`` per column, on the same rows."""
        for c, table in self.tables.items():
            named = table.select(F.col("level").alias("_level"), F.col("encoding").alias("_encoding"))
            df = (
                df.withColumn("_level", _level(c))
                .join(named, "_level", "left")
                .withColumn(f"{c}{SUFFIX}", F.coalesce("_encoding", F.lit(self.prior)))
                .drop("_level", "_encoding")
            )
        return df

    def save(self, path: str) -> None:
        for i, (c, table) in enumerate(self.tables.items()):
            table.withColumn("column", F.lit(c)).write.parquet(f"{path}/levels-{i}")
        spark = SparkSession.active()
        rows = [(i, c, self.prior) for i, c in enumerate(self.tables)] or [(-1, "", self.prior)]
        spark.createDataFrame(rows, "place int, column string, prior double").coalesce(1).write.parquet(f"{path}/columns")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> TargetEncoder:
        rows = spark.read.parquet(f"{path}/columns").orderBy("place").collect()
        tables = {r["column"]: spark.read.parquet(f"{path}/levels-{r['place']}").drop("column") for r in rows if r["place"] >= 0}
        return cls(tables, rows[0]["prior"])


@dataclass(frozen=True)
class EncodedModel:
    """A pipeline over numbers, and the encoder of its categoricals."""

    pipeline: PipelineModel
    encoder: TargetEncoder
    numeric: tuple[str, ...]

    def score(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``score``."""
        encoded = self.encoder.transform(df)
        scored = models.score_frame(self.pipeline, encoded, self.numeric, [])
        return scored.select(*[F.col(f"`{c}`") for c in df.columns], "score")

    def save(self, path: str) -> None:
        self.encoder.save(f"{path}/encoder")
        self.pipeline.write().save(f"{path}/pipeline")

    @classmethod
    def load(cls, spark: SparkSession, path: str, numeric: Sequence[str]) -> EncodedModel:
        return cls(PipelineModel.load(f"{path}/pipeline"), TargetEncoder.load(spark, f"{path}/encoder"), tuple(numeric))


def fit_encoded(
    train: DataFrame,
    features: Sequence[str],
    categorical: Sequence[str],
    *,
    label_col: str = "isFraud",
    order: Sequence[str] = ("TransactionDT", "TransactionID"),
    kind: str = "gbt",
    smoothing: float = SMOOTHING,
    **params,
) -> EncodedModel:
    """M1 with ordered target statistics for ``categorical``; its width doesn't matter."""
    encoder = TargetEncoder.fit(train, categorical, label_col=label_col, smoothing=smoothing)
    encoded = train
    for c in categorical:
        encoded = ordered_statistic(encoded, c, order, label_col=label_col, prior=encoder.prior, smoothing=smoothing)
    numeric = tuple([c for c in features if c not in set(categorical)] + [f"{c}{SUFFIX}" for c in categorical])
    pipeline = models.fit(written(encoded, "encoded"), numeric, [], label_col=label_col, kind=kind, **params)
    return EncodedModel(pipeline, encoder, numeric)


__all__ = ["EncodedModel", "TargetEncoder", "fit_encoded", "level_statistics", "ordered_statistic", "prior_rate"]
