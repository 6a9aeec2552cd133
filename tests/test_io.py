"""S1/S4 CSV, S7 JSON payloads, S8 report, S12 submission."""

import pandas as pd
from pyspark.sql import types as T

from vigil.operators import contract
from vigil.sources import io


def test_csv_permissive_and_text_checks(spark, scratch):
    path = f"{scratch}/in.csv"
    with open(path, "w") as fh:
        fh.write("TransactionID,amount,cat_a\n1,10.5,W\n2,abc,H\n3,,C\n")
    typed = io.read_csv(spark, path, "TransactionID long, amount double, cat_a string")
    assert [r["amount"] for r in typed.orderBy("TransactionID").collect()] == [10.5, None, None]
    raw = io.read_csv_text(spark, path, ["TransactionID", "amount", "cat_a"])
    c = contract.Contract(("amount", "cat_a"), ("cat_a",), 0.5)
    got = {r["TransactionID"]: r["reasons"] for r in contract.tag_rows(raw, c).collect()}
    assert got == {"1": "", "2": "not numeric: amount", "3": "null: amount"}


def test_json_payloads(spark):
    df = spark.createDataFrame(
        pd.DataFrame({"id": [1, 2, 3], "body": ['{"k": 5}', '{"k": "x", "zz": 1, "aa": 2}', "{}"]})
    )
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    rows = {r["id"]: r for r in io.parse_json_payloads(df, "body", schema, keep=["id"]).collect()}
    assert (rows[1]["k"], rows[1]["unknown_keys"], rows[1]["bad_values"]) == (5, "", "")
    assert (rows[2]["k"], rows[2]["unknown_keys"], rows[2]["bad_values"]) == (None, "aa; zz", "k")
    assert (rows[3]["k"], rows[3]["unknown_keys"]) == (None, "")


def test_submission_and_report_roundtrip(spark, scratch):
    scored = spark.createDataFrame([(1, 0.25), (2, 0.75)], "TransactionID long, score double")
    io.write_submission(scored, f"{scratch}/sub")
    back = io.read_csv(spark, f"{scratch}/sub", "TransactionID long, score double")
    assert sorted(tuple(r) for r in back.collect()) == [(1, 0.25), (2, 0.75)]
    from vigil.operators import drift

    m = drift.no_drift_metrics(spark, ["a"])
    io.write_report_json(m, f"{scratch}/rep")
    assert io.read_report_json(spark, f"{scratch}/rep", drift.METRICS_SCHEMA).count() == 2
