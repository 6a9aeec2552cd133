"""Target statistics, the discriminant, foreign models, payload findings, and the CV job."""

import json
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.operators import contract, discriminant, encoding, foreign
from vigil.plans import training
from vigil.sources import io


def labelled(n=600, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        level = rng.choice(["hot"] * 4 + [None, f"v{rng.randint(0, 30)}"])
        y = int(rng.random() < (0.7 if level == "hot" else 0.2))
        rows.append((i, None if i % 50 == 49 else i // 3, level, rng.gauss(y, 1), y))
    return rows


SCHEMA = "TransactionID long, TransactionDT long, c string, x double, isFraud int"


def test_ordered_statistic_sees_earlier_rows_only(spark):
    rows = labelled()
    got = encoding.ordered_statistic(spark.createDataFrame(rows, SCHEMA), "c", ["TransactionDT", "TransactionID"], prior=0.4, smoothing=5.0)
    have = {r.TransactionID: r.c__te for r in got.collect()}
    seen: dict = {}
    for i, t, c, _, y in sorted(rows, key=lambda r: (r[1] is None, r[1] or 0, r[0])):
        p, n = seen.get(c, (0, 0))
        assert have[i] == pytest.approx((p + 5 * 0.4) / (n + 5)), (i, t)
        seen[c] = (p + y, n + 1)


def test_encoder_joins_levels_and_gives_unseen_ones_the_prior(spark, scratch):
    train = spark.createDataFrame(labelled(), SCHEMA)
    encoder = encoding.TargetEncoder.fit(train, ["c"])
    new = spark.createDataFrame([(1, "hot"), (2, None), (3, "never seen")], "id long, c string")
    got = {r.id: r.c__te for r in encoder.transform(new).collect()}
    rate = train.agg(F.avg("isFraud")).first()[0]
    hot = train.filter("c = 'hot'").agg(F.sum("isFraud"), F.count(F.lit(1))).first()
    assert got[1] == pytest.approx((hot[0] + 10 * rate) / (hot[1] + 10)) and got[3] == pytest.approx(rate)
    assert got[2] != got[3]
    encoder.save(f"{scratch}/e")
    again = encoding.TargetEncoder.load(spark, f"{scratch}/e")
    assert {r.id: r.c__te for r in again.transform(new).collect()} == got


def test_fit_with_a_level_per_row(spark, scratch):
    rows = spark.range(100_000).selectExpr(
        "id as TransactionID", "id as TransactionDT", "concat('level', id) as c", "cast(id % 17 as double) as x", "cast(id % 17 > 12 as int) as isFraud"
    )
    model = encoding.fit_encoded(rows, ["x", "c"], ["c"], kind="gbt", maxIter=2, maxDepth=2)
    assert model.encoder.tables["c"].count() == 100_000
    new = spark.createDataFrame([(1, 14.0, "unseen"), (2, 3.0, "level9")], "id long, x double, c string")
    told = {r.id: r.score for r in model.score(new).collect()}
    assert told[1] > 0.5 > told[2]
    model.save(f"{scratch}/m")
    again = encoding.EncodedModel.load(spark, f"{scratch}/m", model.numeric)
    assert {r.id: r.score for r in again.score(new).collect()} == told


def test_discriminant_matches_numpy(spark, scratch):
    rng = np.random.default_rng(0)
    y = rng.integers(0, 2, 400)
    x = rng.normal(0, 1, (400, 3)) @ np.array([[1, 0.5, 0], [0, 2, 0.3], [0, 0, 1e-3]]) + y[:, None] * [1, 0.5, 1e-3] + [1e9, -5, 0]
    x = np.column_stack([x, np.full(400, 7.0), x[:, 1] * 2])  # a constant, and a copy of another column
    rows = spark.createDataFrame([(*map(float, v), int(c)) for v, c in zip(x, y, strict=True)], "a double, b double, c double, d double, e double, y int")
    rows = VectorAssembler(inputCols=list("abcde"), outputCol="f").transform(rows)
    n, means, cov = discriminant.scatter(rows, "f", "y")
    within = sum((x[y == k] - x[y == k].mean(0)).T @ (x[y == k] - x[y == k].mean(0)) for k in (0, 1)) / 398
    assert n.tolist() == [np.sum(y == 0), np.sum(y == 1)]
    assert np.allclose(means, [x[y == k].mean(0) for k in (0, 1)])
    assert np.allclose(cov, within, rtol=1e-6, atol=1e-8)
    model = discriminant.LinearDiscriminant(featuresCol="f", labelCol="y").fit(rows)
    z = x[:, :3] - x[:, :3].mean(0)
    s = np.linalg.inv(within[:3, :3])
    m = [z[y == k].mean(0) for k in (0, 1)]
    margin = z @ s @ (m[1] - m[0]) - (m[0] + m[1]) @ s @ (m[1] - m[0]) / 2 + np.log(n[1] / n[0])
    got = [r.p for r in model.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect()]
    assert np.allclose(got, 1 / (1 + np.exp(-margin)), atol=1e-4)
    model.write().overwrite().save(f"{scratch}/lda")
    again = discriminant.LinearDiscriminantModel.load(f"{scratch}/lda")
    assert np.allclose([r.p for r in again.transform(rows).select(vector_to_array("probability")[1].alias("p")).collect()], got)
    with pytest.raises(ValueError, match="both classes"):
        discriminant.scatter(rows.filter("y = 1"), "f", "y")


def test_foreign_models_score_in_place(spark):
    # closures: the workers can't import this module
    _load = lambda artifact: json.loads(artifact)
    _predict = lambda weights, batch: [None if v is None else v * weights["w"] for v in batch.column("a b").to_pylist()]
    _short = lambda weights, batch: [0.0]
    rows = spark.createDataFrame([(i, None if i == 3 else float(i), f"s{i}") for i in range(50)], "id long, `a b` double, _row string")
    scorer = foreign.ForeignScorer(b'{"w": 0.01}', _load, _predict, ("a b",), batch_rows=7)
    got = scorer(rows.repartition(3))
    assert got.columns == ["id", "a b", "_row", "score"]
    assert {r.id: (r._row, r.score) for r in got.collect()} == {i: (f"s{i}", None if i == 3 else pytest.approx(i / 100)) for i in range(50)}
    other = foreign.ForeignScorer(b'{"w": 0.02}', _load, _predict, ("a b",))
    assert other.digest != scorer.digest and other(rows).filter("id = 5").first().score == pytest.approx(0.1)
    boundary = contract.ScoringBoundary(scorer, contract.Contract(("a b",), (), 0.2), require_complete=False)
    assert boundary.score(rows, keep=["id", "_row"]).filter("decision = 'block'").count() == 30
    with pytest.raises(Exception, match="1 scores for"):
        foreign.ForeignScorer(b"{}", _load, _short, ("a b",))(rows.coalesce(1)).collect()


def test_payload_findings(spark):
    texts = ['{"k": 1, "w": 2.5}', '{"k": "7", "extra": 1, "also": {}}', "{broken", "[1, 2]", None, '{"k": null, "w": "x"}', "{}", '{"k": 1e10, "w": 1}', '"text"']
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("w", T.DoubleType())])
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, p string")
    got = {r.id: tuple(r)[1:] for r in io.json_findings(rows, "p", schema, keep=["id"]).collect()}
    assert got[0] == (1, 2.5, False, "", "", "")
    assert got[1] == (7, None, False, "w", "also; extra", "")
    for i in (2, 3, 8):
        assert got[i] == (None, None, True, "k; w", "", "")
    assert got[4] == (None, None, False, "k; w", "", "")
    assert got[5] == (None, None, False, "k", "", "w")
    assert got[6] == (None, None, False, "k; w", "", "")
    assert got[7] == (None, 1.0, False, "", "", "k")
    drifted = io.payload_schema(rows.filter("id in (0, 1)"), "p")
    assert "extra" in drifted and drifted != io.payload_schema(rows.filter("id = 0"), "p")


def test_cross_validation_keeps_null_times(spark):
    """Rows without a time come last: they are tested in the last fold."""
    rows = spark.createDataFrame(labelled(300), SCHEMA)
    cv = training.cross_validate(rows, ["x", "c"], ["c"], param_space={"maxIter": [2]}, n_draws=1, n_splits=3)
    assert [(r.fold, r.n_train, r.n_test) for r in cv.folds.orderBy("fold").collect()] == [(0, 75, 75), (1, 150, 75), (2, 225, 75)]
    assert cv.scored.count() == 225
    assert cv.per_draw.first().best
