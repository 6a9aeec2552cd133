"""M1/M2/M10/S10 Spark ML fit, score, exact median, save/load; M3 on test data."""

import numpy as np
import pandas as pd
import pytest

from vigil.operators import contract, models
from vigil.plans import training


def data(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    amount = rng.uniform(0, 1000, n)
    y = ((amount > 200) & (amount < 800)).astype(int) ^ (rng.uniform(0, 1, n) < 0.1)
    pdf = pd.DataFrame(
        {
            "TransactionID": np.arange(n),
            "TransactionDT": np.arange(n) * 100,
            "amount": np.where(rng.uniform(0, 1, n) < 0.1, np.nan, amount),
            "cat_a": rng.choice(["W", "H", "C", "S"], n),
            "isFraud": y.astype(int),
        }
    )
    return spark.createDataFrame(pdf)


def test_exact_median(spark):
    df = spark.createDataFrame(pd.DataFrame({"v": [5.0, 1.0, None, 3.0, 9.0, float("nan")]}))
    assert models.exact_median(df, "v") == 4.0
    df = spark.createDataFrame(pd.DataFrame({"v": [5.0, 1.0, 3.0]}))
    assert models.exact_median(df, "v") == 3.0
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.integers(0, 5, 101).astype(float), "b": list(rng.normal(0, 1, 100)) + [None], "c": [None] * 100 + [2.0]})
    got = {r["column_name"]: r["median"] for r in models.exact_medians(spark.createDataFrame(pdf), ["a", "b", "c"]).collect()}
    assert got["a"] == float(np.median(pdf["a"])) and got["c"] == 2.0
    assert got["b"] == pytest.approx(float(np.median(pdf["b"].dropna())), abs=1e-15)


def test_fit_score_save_load(spark, scratch):
    df = data(spark)
    feats, cats = ["TransactionDT", "amount", "cat_a"], ["cat_a"]
    model = models.fit(df, feats, cats, kind="gbt", maxIter=10, maxDepth=3)
    scored = models.score_frame(model, df.select("TransactionID", *feats), ["TransactionDT", "amount"], cats)
    vals = [r["score"] for r in scored.collect()]
    assert len(vals) == 400 and all(0 <= v <= 1 for v in vals)
    c = contract.Contract(tuple(feats), tuple(cats), 0.3)
    models.save_model(spark, model, c, f"{scratch}/m")
    loaded, c2 = models.load_model(spark, f"{scratch}/m")
    assert c2 == c
    again = models.score_frame(loaded, df.select("TransactionID", *feats), ["TransactionDT", "amount"], cats)
    assert [r["score"] for r in again.collect()] == pytest.approx(vals)
    assert models.resolve_model(spark, f"{scratch}/served", f"{scratch}/m") == f"{scratch}/m"


def test_seed_champion_and_gate(spark, scratch):
    df = data(spark, 600)
    trained = training.seed_champion(df, ["TransactionDT", "amount", "cat_a"], ["cat_a"], params={"maxIter": 10})
    assert (trained.n_train, trained.n_test, trained.n_stream) == (420, 90, 90)
    assert 0.5 < trained.test_auc <= 1.0 and 0 <= trained.threshold <= 1
    b = training.model_boundary(trained.model, trained.contract)
    out = b.score(df.select("TransactionDT", "amount", "cat_a"), validate_rows=False)
    assert out.columns == ["score", "decision", "threshold"]


def test_time_series_cv(spark):
    df = data(spark, 360)
    out = training.time_series_cv(
        df,
        ["TransactionDT", "amount", "cat_a"],
        ["cat_a"],
        param_space={"maxDepth": [2, 3], "maxIter": [3]},
        n_draws=2,
        n_splits=3,
    ).collect()
    assert len(out) >= 1 and all(r["folds"] == 3 for r in out)
    assert all(0.0 <= r["mean_auc"] <= 1.0 for r in out)
    assert sum(r["best"] for r in out) == 1
    assert max(out, key=lambda r: (r["mean_auc"], -r["draw"]))["best"]


def test_fits_of_the_same_rows_share_their_medians(spark, monkeypatch):
    df = data(spark, 120)
    calls = []
    own = models.exact_medians
    monkeypatch.setattr(models, "exact_medians", lambda d, columns: calls.append(list(columns)) or own(d, columns))
    scored = models.baseline_scores(df.filter("TransactionID < 80"), df.filter("TransactionID >= 80"), ["amount", "cat_a"], ["cat_a"], kinds=("logreg", "lda"))
    assert {(r["model"], r["count"]) for r in scored.groupBy("model").count().collect()} == {("logreg", 40), ("lda", 40)}
    assert calls == [["amount"]]
    calls.clear()
    training.cross_validate(df, ["amount", "cat_a"], ["cat_a"], param_space={"regParam": [0.1]}, n_draws=2, n_splits=2, kind="logreg")
    assert calls == [["amount"]] * 2
