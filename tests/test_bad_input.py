"""Input that breaks the rules: headers, text, payloads, scores, statistics, levels."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.errors import ContractError
from vigil.functions.stats import chi2_sf
from vigil.operators import contract, evaluate, models, promote, store, window
from vigil.plans.scoring_job import score_csv
from vigil.sources import io

CONTRACT = contract.Contract(("amount", "kind"), ("kind",), 0.5)
BOUNDARY = contract.ScoringBoundary(lambda df: F.col("amount") / 100.0, CONTRACT)


def csv(path, *lines):
    folder = path / "in"
    folder.mkdir()
    (folder / "part.csv").write_text("\n".join(lines) + "\n")
    return str(folder)


def test_score_job_matches_columns_by_name_and_rejects_bad_rows(spark, tmp_path):
    source = csv(tmp_path, "kind,amount,TransactionID", "a,10,1", "a,NaN,2", "b,x,3", "b,,4", "b,90.5,5")
    counts = score_csv(spark, source, str(tmp_path / "out"), BOUNDARY, str(tmp_path / "store"), rejects=str(tmp_path / "bad"))
    assert (counts.scored, counts.rejected) == (2, 3)
    got = store.read_store(spark, str(tmp_path / "store")).select("TransactionID", "score", "decision").collect()
    assert sorted(map(tuple, got)) == [(1, 0.1, "allow"), (5, 0.905, "block")]
    bad = spark.read.option("header", True).csv(str(tmp_path / "bad")).select("TransactionID", "reasons").collect()
    assert sorted(map(tuple, bad)) == [("2", "null: amount"), ("3", "not numeric: amount"), ("4", "null: amount")]


@pytest.mark.parametrize("header", ["amount,TransactionID", "kind,amount,TransactionID,more"])
def test_headers_have_to_fit(spark, tmp_path, header):
    with pytest.raises(ContractError, match="header"):
        score_csv(spark, csv(tmp_path, header, "1,1"), str(tmp_path / "out"), BOUNDARY, str(tmp_path / "store"))


def test_malformed_payloads_and_missing_keys_are_found(spark):
    rows = spark.createDataFrame([(1, '{"k": 1'), (2, "[1]"), (3, '{"k": 1}'), (4, '{"k": "x", "z": 0}'), (5, None)], "id long, t string")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("m", T.IntegerType())])
    got = {r.id: r for r in io.parse_json_payloads(rows, "t", schema, keep=["id"], findings=True).collect()}
    assert [got[i].malformed for i in range(1, 6)] == [True, True, False, False, False]
    assert (got[3].missing_keys, got[4].bad_values, got[4].unknown_keys) == ("m", "k", "z")


@pytest.mark.parametrize("bad", [None, float("nan")])
def test_scores_that_have_no_rank_raise(spark, bad):
    rows = [(1, 0.9, 0.8), (0, 0.1, 0.2), (1, 0.7, 0.9), (0, bad, 0.3), (0, 0.2, 0.1)]
    df = spark.createDataFrame(rows, "isFraud int, score double, challenger double")
    with pytest.raises(Exception, match="NULL or NaN score"):
        evaluate.auc(df)
    with pytest.raises(Exception, match="NULL or NaN score"):
        evaluate.operating_threshold(df)
    with pytest.raises(Exception, match="NULL or NaN score"):
        promote.delong_frame(df.withColumnRenamed("score", "champion")).collect()
    assert evaluate.rejected_scores(df, ["score", "challenger"]).filter("n_rejected = 1").first().scorer == "score"


@pytest.mark.parametrize("dof", [3e5, 1e6, 1e8, 1e10])
def test_chi_square_tail_of_many_levels(spark, dof):
    x = [dof + d * math.sqrt(2 * dof) for d in (0, 3, -3)]
    got = spark.createDataFrame([(x,)], "x array<double>").select(*[chi2_sf(F.col("x")[i], F.lit(dof)) for i in range(3)]).first()
    assert list(got) == pytest.approx([0.5, 0.00135, 0.99865], abs=1e-3)


def test_wide_categories_fit_and_scoring_leaves_inputs_alone(spark, tmp_path):
    rows = [(i, i % 7, f"level{i % 40}", int(i % 40 > 20)) for i in range(400)]
    df = spark.createDataFrame(rows, "TransactionID long, amount long, kind string, isFraud int")
    model = models.fit(df, ["amount", "kind"], ["kind"], maxIter=2)
    scored = models.score_frame(model, df, ["amount"], ["kind"])
    assert dict(scored.dtypes)["amount"] == "bigint"
    assert evaluate.auc(scored) > 0.95
    path = str(tmp_path / "model")
    for threshold in (0.3, 0.4):
        models.save_model(spark, model, contract.Contract(("amount", "kind"), ("kind",), threshold), path)
        assert models.load_model(spark, path)[1].threshold == threshold


def test_window_over_a_store_without_append_order(spark):
    scores = spark.createDataFrame([(1, 0.5), (2, 0.6)], "TransactionID long, score double")
    rows = spark.createDataFrame([(1, 10, 1.0), (2, 20, 2.0), (3, 30, 3.0)], "TransactionID long, TransactionDT long, amount double")
    assert sorted(map(tuple, window.current_window(scores, rows, ["amount"]).collect())) == [(1.0, 0.5), (2.0, 0.6)]


def test_windows_refuse_what_they_cannot_cut(spark):
    rows = spark.createDataFrame([(1, 10.0, 0.5, 1)], "TransactionID long, TransactionDT double, score double, isFraud int")
    for call in (
        lambda: window.last_rows(rows, 0),
        lambda: window.trailing_window(rows, -1),
        lambda: window.deterministic_sample(rows, 0),
        lambda: window.current_window(rows, rows, ["TransactionDT"], window_rows=0),
        lambda: window.current_window(rows, rows, ["TransactionDT"], window_days=-1),
        lambda: evaluate.cost_curve(rows, cost_ratio=0),
        lambda: evaluate.cost_curve(rows, cost_ratio=float("nan")),
    ):
        with pytest.raises(ValueError):
            call()
    with pytest.raises(ValueError, match="scores lack score"):
        window.current_window(rows.drop("score"), rows, ["TransactionDT"])
    with pytest.raises(ValueError, match="features lack TransactionDT"):
        window.current_window(rows, rows.drop("TransactionDT"), ["score"])
