"""P1-P4, A21 profiling and the missingness filter."""

import pandas as pd
import pytest

from vigil.operators import profile


def frame(spark):
    pdf = pd.DataFrame(
        {
            "a": [1.0, None, 3.0, float("nan")],  # 50% missing -> kept
            "b": [None, None, None, 1.0],  # 75% -> dropped
            "c": ["x", None, "y", "z"],
            "y": [1, 0, 1, 0],
        }
    )
    return spark.createDataFrame(pdf)


def test_profile_and_filter(spark):
    df = frame(spark)
    pct = {r["column_name"]: r["null_pct"] for r in profile.null_profile(df).collect()}
    assert pct == {"a": 50.0, "b": 75.0, "c": 25.0, "y": 0.0}
    assert profile.filter_columns_by_missingness(df).columns == ["a", "c", "y"]
    assert [r["column_name"] for r in profile.dropped_columns(df).collect()] == ["b"]


def test_empty_input_raises(spark):
    with pytest.raises(ValueError, match="at least one row"):
        profile.filter_columns_by_missingness(frame(spark).limit(0))


def test_categoricals_and_integral_floats(spark):
    df = spark.createDataFrame(pd.DataFrame({"card1": [150.0, 151.5], "x": [1, 2]}))
    out = profile.convert_categoricals(df, ["card1", "absent"])
    assert [r["card1"] for r in out.collect()] == ["150", "151.5"]
    assert dict(out.dtypes)["x"] == "bigint"


def test_missingness_lift(spark):
    row = profile.missingness_lift(frame(spark), ["a"], label_col="y").first()
    # missing rows have y = 0, 0 ; present rows 1, 1
    assert (row["n_missing"], row["n_present"], row["rate_missing"], row["rate_present"], row["lift"]) == (2, 2, 0.0, 1.0, 0.0)


def test_prepare_and_dedup(spark):
    df = frame(spark).withColumnRenamed("y", "isFraud").withColumnRenamed("c", "TransactionID")
    out, label = profile.prepare_data(df)
    assert out.columns == ["a", "b", "isFraud"] and label == "isFraud"
    assert profile.dedup_columns("t", ["t", "a", "t", "b"]) == ["t", "a", "b"]
