"""Missing-value predicates: NULL, and NaN for floating columns.

pandas treats NaN as missing; Spark keeps NULL and NaN apart, so every
"missing" test here covers both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN when the column is float/double."""
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_numeric_type(dtype: T.DataType) -> bool:
    """Numeric and not boolean (Spark's BooleanType is not a NumericType anyway)."""
    return isinstance(dtype, T.NumericType) and not isinstance(dtype, T.BooleanType)
