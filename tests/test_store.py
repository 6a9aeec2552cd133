"""Score store append/read, W2, A3, J2/J3 and the next unseen chunk."""

import pandas as pd
from pyspark.sql import functions as F

from vigil.operators import store


def scored(spark, ids, score=0.3):
    return spark.createDataFrame([(int(i), float(score), "allow") for i in ids], "TransactionID long, score double, decision string")


def test_absent_store_is_empty_with_schema(spark, scratch):
    st = store.read_store(spark, f"{scratch}/none")
    assert st.count() == 0 and "TransactionID" in st.columns


def test_append_and_newest_wins(spark, scratch):
    path = f"{scratch}/store"
    assert store.append_scores(scored(spark, [1000, 1001]), path) == 2
    assert store.append_scores(scored(spark, [1000], 0.9), path) == 1
    assert store.append_scores(scored(spark, []).limit(0), path) == 0
    st = store.read_store(spark, path)
    assert st.count() == 3  # never de-duplicated at write
    latest = {r["TransactionID"]: r["score"] for r in store.latest_scores(st).collect()}
    assert latest == {1000: 0.9, 1001: 0.3}
    assert store.store_counts(st).first().asDict() == {"n_rows": 3, "n_ids": 2}


def test_scored_ids_ignore_invalid(spark):
    raw = spark.createDataFrame([("1000",), ("x",), (None,), ("1000",), ("7",)], "TransactionID string")
    assert sorted(r[0] for r in store.scored_ids(raw).collect()) == [7, 1000]


def test_semi_and_anti_joins(spark):
    stream = spark.createDataFrame(pd.DataFrame({"TransactionID": range(10), "TransactionDT": range(10)}))
    st = scored(spark, [2, 3, 99])
    assert sorted(r[0] for r in store.scored_rows(stream, st).select("TransactionID").collect()) == [2, 3]
    assert store.unseen_rows(stream, st).count() == 8


def test_next_chunk_f11(spark):
    flow = spark.createDataFrame(pd.DataFrame({"TransactionID": range(300), "TransactionDT": [i * 100 for i in range(300)]}))
    stream = flow.filter(F.col("TransactionID") >= 255)
    empty = scored(spark, []).limit(0)
    first = store.next_chunk(stream, empty, 20)
    assert sorted(r[0] for r in first.select("TransactionID").collect()) == list(range(255, 275))
    seen = scored(spark, range(255, 265))
    second = store.next_chunk(stream, seen, 20)
    assert sorted(r[0] for r in second.select("TransactionID").collect()) == list(range(265, 285))
    assert store.next_chunk(stream, empty, 1000).count() == 45
