"""Column profiling, missingness filter, categorical cast.

The profile is one aggregate over all columns (a single scan, partial
aggregation on the map side); only the per-column percentages — bounded by
the schema width — reach the driver to decide which columns to keep.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.functions.nulls import is_missing

MISSING_PERCENT_THRESHOLD = 50.0


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, null_pct)`` — percent of NULL/NaN per column, one scan."""
    cols = list(columns) if columns is not None else list(df.columns)
    pct = [
        F.struct(
            F.lit(c).alias("column_name"),
            (F.avg(is_missing(df, c).cast("double")) * 100.0).alias("null_pct"),
        )
        for c in cols
    ]
    return df.agg(F.array(*pct).alias("p")).select(F.inline("p"))


def missingness_split(
    df: DataFrame, threshold: float = MISSING_PERCENT_THRESHOLD
) -> tuple[list[str], list[str]]:
    """``(kept, dropped)`` column names; keeps ``null_pct <= threshold``, in order."""
    rows = null_profile(df).collect()  # one row per column (schema-bounded)
    pct = {r["column_name"]: r["null_pct"] for r in rows}
    if any(v is None for v in pct.values()):
        raise ValueError("missingness filter needs at least one row")
    kept = [c for c in df.columns if pct[c] <= threshold]
    dropped = [c for c in df.columns if pct[c] > threshold]
    return kept, dropped


def filter_columns_by_missingness(
    df: DataFrame, threshold: float = MISSING_PERCENT_THRESHOLD
) -> DataFrame:
    """Drop columns whose missing percentage exceeds ``threshold``."""
    kept, _ = missingness_split(df, threshold)
    return df.select(*[F.col(f"`{c}`") for c in kept])


def dropped_columns(df: DataFrame, threshold: float = MISSING_PERCENT_THRESHOLD) -> DataFrame:
    """The profile rows of the columns the filter drops."""
    return null_profile(df).filter(F.col("null_pct") > threshold)


def as_category(df: DataFrame, name: str):
    """String form of a column; integral floats print without ``.0``."""
    dtype = df.schema[name].dataType
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        integral = (c == F.floor(c)) & ~F.isnan(c) & (F.abs(c) < 9.2e18)
        return F.when(integral, c.cast("bigint").cast("string")).otherwise(c.cast("string"))
    return c.cast("string")


def convert_categoricals(df: DataFrame, categorical: Iterable[str]) -> DataFrame:
    """Cast the listed columns that are present to categorical strings."""
    present = [c for c in categorical if c in df.columns]
    return df.withColumns({c: as_category(df, c) for c in present}) if present else df


def prepare_data(
    df: DataFrame, *, label_col: str = "isFraud", drop: Sequence[str] = ("TransactionID",)
) -> tuple[DataFrame, str]:
    """P5: features frame (id and label dropped) plus the label as int.

    Returns the frame with features followed by the integer label column, and
    the label column name, so features and label stay on the same row.
    """
    features = [c for c in df.columns if c != label_col and c not in drop]
    return df.select(*features, F.col(label_col).cast("int").alias(label_col)), label_col


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Drop non-feature columns if present (Spark's drop is tolerant)."""
    return df.drop(*list(columns))


def dedup_columns(*names: str | Iterable[str]) -> list[str]:
    """A select list without repeats, first occurrence wins."""
    flat: list[str] = []
    for n in names:
        flat.extend([n] if isinstance(n, str) else list(n))
    return list(dict.fromkeys(flat))


def missingness_lift(
    df: DataFrame, columns: Sequence[str], *, label_col: str = "isFraud"
) -> DataFrame:
    """Per column, label rate when missing / label rate when present."""
    y = F.col(label_col).cast("double")
    parts = []
    for c in columns:
        m = is_missing(df, c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.sum(m).cast("long").alias("n_missing"),
                F.sum(1.0 - m).cast("long").alias("n_present"),
                F.sum(m * y).alias("_ym"),
                F.sum((1.0 - m) * y).alias("_yp"),
            )
        )
    rows = df.agg(F.array(*parts).alias("p")).select(F.inline("p"))
    rate_m = F.when(F.col("n_missing") > 0, F.col("_ym") / F.col("n_missing"))
    rate_p = F.when(F.col("n_present") > 0, F.col("_yp") / F.col("n_present"))
    return rows.select(
        "column_name",
        "n_missing",
        "n_present",
        F.round(rate_m, 9).alias("rate_missing"),
        F.round(rate_p, 9).alias("rate_present"),
        F.round(F.when(rate_p > 0, rate_m / rate_p), 9).alias("lift"),
    )
