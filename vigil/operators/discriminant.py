"""A linear discriminant classifier as a Spark ML estimator.

Class counts, class sums and the scatter of all features come out of one Gram
matrix: every vector is standardised and gets an indicator per class, so that
``G = sum z z'`` holds all three (a tree aggregation in the JVM, p x p numbers
per task). The pooled covariance, its pseudo-inverse and the coefficients are
p x p work on the driver, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scatter(df: DataFrame, features: str, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, means (2 x p) and pooled covariance of the classes 0 and 1, divided by n - 2."""
    x = vector_to_array(F.col(features))
    arrays = df.select(x.alias("x"), (F.col(label) == 1).cast("double").alias("y"))
    p = len((arrays.first() or [[]])[0])
    if not p:
        raise ValueError("a discriminant needs rows with features")
    # standardised first, so that large means don't drown the spread
    got = arrays.agg(*[f(F.get("x", F.lit(i))) for i in range(p) for f in (F.avg, F.stddev_samp)]).first()
    mean, spread = np.array(got[0::2], dtype=float), np.array([v or 1.0 for v in got[1::2]], dtype=float)
    shifted = F.zip_with(
        F.zip_with("x", F.lit(mean.tolist()), lambda a, m: a - m), F.lit(spread.tolist()), lambda a, s: a / s
    )
    z = arrays.select(array_to_vector(F.concat(shifted, F.array(F.lit(1.0) - F.col("y"), F.col("y")))).alias("z"))
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(z, "z")).computeGramianMatrix().toArray()
    rows, sums = np.diag(gram)[p:], gram[p:, :p]
    if (rows < 1).any() or rows.sum() < 3:
        raise ValueError("a discriminant needs rows of both classes, three at least")
    within = gram[:p, :p] - sum(np.outer(s, s) / n for s, n in zip(sums, rows, strict=True))
    return rows, sums / rows[:, None] * spread + mean, within / (rows.sum() - 2) * np.outer(spread, spread)


class _Columns(HasFeaturesCol, HasLabelCol, HasProbabilityCol, HasRawPredictionCol):
    pass


class LinearDiscriminant(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Two-class linear discriminant with the classes' shares as priors."""

    @keyword_only
    def __init__(self, *, featuresCol: str = "features", labelCol: str = "label") -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> LinearDiscriminantModel:
        rows, means, covariance = scatter(dataset, self.getFeaturesCol(), self.getLabelCol())
        deviation = np.sqrt(np.diag(covariance))
        scale = np.where(deviation > 0, deviation, 1.0)
        # of the correlations, so that the cut-off of the pseudo-inverse doesn't depend on units
        inverse = np.linalg.pinv(covariance / np.outer(scale, scale), rcond=1e-10, hermitian=True) / np.outer(scale, scale)
        w = inverse @ (means[1] - means[0])
        b = float(np.log(rows[1] / rows[0]) - (means[0] + means[1]) @ w / 2)
        model = LinearDiscriminantModel()
        model._set(coefficients=w.tolist(), intercept=b, featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol())
        return model


class LinearDiscriminantModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``rawPrediction`` and ``probability``, vectors of the two classes."""

    coefficients: Param[list[float]] = Param(Params._dummy(), "coefficients", "a weight per feature", TypeConverters.toListFloat)
    intercept: Param[float] = Param(Params._dummy(), "intercept", "constant", TypeConverters.toFloat)

    def weights(self) -> np.ndarray:
        return np.array(self.getOrDefault(self.coefficients))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))
        dot = F.aggregate(F.zip_with(x, F.lit(self.weights().tolist()), lambda a, w: a * w), F.lit(0.0), lambda s, v: s + v)
        margin = dot + F.lit(float(self.getOrDefault(self.intercept)))
        one = F.lit(1.0) / (1.0 + F.exp(-margin))
        return dataset.withColumns(
            {
                self.getRawPredictionCol(): array_to_vector(F.array(-margin, margin)),
                self.getProbabilityCol(): array_to_vector(F.array(1.0 - one, one)),
            }
        )


__all__ = ["LinearDiscriminant", "LinearDiscriminantModel", "scatter"]
