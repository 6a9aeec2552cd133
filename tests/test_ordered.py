"""The ordered prefix-sum primitive against pandas, including a hot key."""

import numpy as np
import pytest
import pandas as pd
from pyspark.sql import functions as F

from vigil.functions import ordered
from vigil.functions.ordered import prefix_sums, rows_at_ranks


def test_prefix_sums_match_pandas_with_groups(spark, monkeypatch):
    rng = np.random.default_rng(0)
    n = 2000
    pdf = pd.DataFrame(
        {
            "g": rng.integers(0, 3, n),
            "k": rng.permutation(n),  # unique order key
            "x": rng.integers(0, 10, n),
        }
    )
    exp = pdf.sort_values(["g", "k"]).reset_index(drop=True)
    exp["cum_x"] = exp.groupby("g")["x"].cumsum()
    exp["tot_x"] = exp.groupby("g")["x"].transform("sum")
    for rows, size in ((100, 0), (ordered.ROWS_PER_BUCKET, ordered.BROADCAST_BYTES)):  # many buckets, then one
        monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", rows)
        monkeypatch.setattr(ordered, "BROADCAST_BYTES", size)
        out = prefix_sums(spark.createDataFrame(pdf), ["k"], ["x"], by=["g"], totals=True)
        got = out.toPandas().sort_values(["g", "k"]).reset_index(drop=True)
        assert got["cum_x"].tolist() == exp["cum_x"].tolist()
        assert got["tot_x"].tolist() == exp["tot_x"].tolist()


def test_row_number_with_a_hot_time_value(spark):
    # a third of the rows share one time value; ties break by id
    n = 3000
    t = np.where(np.arange(n) % 3 == 0, 500, np.arange(n))
    pdf = pd.DataFrame({"t": t, "id": np.arange(n)[::-1]})
    ones = spark.createDataFrame(pdf).withColumn("one", F.lit(1))
    ranked = prefix_sums(ones, ["t", "id"], ["one"], n_buckets=8).toPandas().rename(columns={"cum_one": "rn"})
    exp = pdf.sort_values(["t", "id"]).reset_index(drop=True)
    exp["rn"] = np.arange(1, n + 1)
    got = ranked.sort_values("rn").reset_index(drop=True)
    assert got[["t", "id"]].values.tolist() == exp[["t", "id"]].values.tolist()


def test_hot_key_is_spread_over_several_buckets(spark):
    from vigil.functions.ordered import BUCKET, range_bucketed

    n = 3000
    pdf = pd.DataFrame({"t": np.where(np.arange(n) < n // 3, 7, np.arange(n)), "id": np.arange(n)})
    rp = range_bucketed(spark.createDataFrame(pdf), ["t", "id"], n_buckets=8)
    per = rp.filter(F.col("t") == 7).groupBy(BUCKET).count().collect()
    assert len(per) > 1  # the hot value is split by the second key


def test_rows_at_ranks(spark):
    pdf = pd.DataFrame({"v": [5.0, 1.0, 3.0, 3.0, 9.0, 2.0]})
    n, found = rows_at_ranks(spark.createDataFrame(pdf), ["v"], lambda n: [1, n, 3, 99])
    assert n == 6
    assert found[1]["v"] == 1.0 and found[6]["v"] == 9.0 and found[3]["v"] == 3.0
    assert 99 not in found


def test_rank_selection_fast_path_and_fallback_agree(spark, monkeypatch):
    monkeypatch.setattr(ordered, "SORT_ROWS", 20)
    from vigil.functions.ordered import ranks_by_buckets

    rng = np.random.default_rng(5)
    n = 5000
    # a hot value holding a third of the rows sits exactly where ranks are asked
    t = np.where(rng.uniform(0, 1, n) < 0.34, 2500, rng.integers(0, 5000, n))
    pdf = pd.DataFrame({"t": t, "id": rng.permutation(n)})
    df = spark.createDataFrame(pdf)
    want = lambda n: [1, 17, n // 3, n // 2, n - 1, n]
    n1, fast = rows_at_ranks(df, ["t", "id"], want)
    n2, exact = ranks_by_buckets(df, ["t", "id"], want)
    srt = pdf.sort_values(["t", "id"]).reset_index(drop=True)
    assert n1 == n2 == n
    for r in want(n):
        assert (fast[r]["t"], fast[r]["id"]) == (exact[r]["t"], exact[r]["id"]) == tuple(srt.iloc[r - 1])


def test_bucket_path_for_auc_ks_and_delong(spark, monkeypatch):
    """Many buckets give the same statistics as one."""
    import itertools

    from vigil.operators import drift, evaluate, promote

    rng = np.random.default_rng(2)
    n = 600
    y = rng.integers(0, 2, n)
    a = np.round(rng.uniform(0, 1, n) + 0.3 * y, 2)
    b = np.round(rng.uniform(0, 1, n) + 0.5 * y, 2)
    pdf = pd.DataFrame({"isFraud": y, "score": a, "champion": a, "challenger": b})
    df = spark.createDataFrame(pdf)
    small = (evaluate.auc(df), drift.ks_metrics(df.filter("isFraud = 1"), df.filter("isFraud = 0"), ["score"]).first()["statistic"],
             promote.delong_frame(df).first()["se"])
    monkeypatch.setattr(ordered, "ROWS_PER_BUCKET", 10)
    big = (evaluate.auc(df), drift.ks_metrics(df.filter("isFraud = 1"), df.filter("isFraud = 0"), ["score"]).first()["statistic"],
           promote.delong_frame(df).first()["se"])
    pos, neg = a[y == 1], a[y == 0]
    brute = sum((p > q) + 0.5 * (p == q) for p, q in itertools.product(pos, neg)) / (len(pos) * len(neg))
    assert small[0] == pytest.approx(brute, abs=1e-12) and big[0] == pytest.approx(brute, abs=1e-12)
    assert small[1] == big[1]
    assert small[2] == pytest.approx(big[2], rel=1e-12)


@pytest.mark.parametrize("sort_rows", [10, 100_000])
def test_null_keys_sort_last_and_are_never_lost(spark, monkeypatch, sort_rows):
    from vigil.operators import split, store

    monkeypatch.setattr(ordered, "SORT_ROWS", sort_rows)
    rows = [(None if i % 10 < 3 else i // 4, None if i == 50 else i) for i in range(100)]
    df = spark.createDataFrame(rows, "TransactionDT long, TransactionID long")
    parts = split.temporal_split(df)
    assert [p.count() for p in parts] == [70, 15, 15]
    labelled = {r["slice"]: r["count"] for r in split.with_slice(df).groupBy("slice").count().collect()}
    assert labelled == {"train": 70, "test": 15, "stream": 15}
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))
    newest = store.first_rows(df, 40, ["TransactionDT", "TransactionID"], descending=True)
    assert sorted(map(tuple, newest.collect()), key=repr) == sorted(order[-40:], key=repr)
    oldest = store.first_rows(df, 75, ["TransactionDT", "TransactionID"])
    assert sorted(map(tuple, oldest.collect()), key=repr) == sorted(order[:75], key=repr)
