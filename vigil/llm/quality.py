"""Ordinal quality classifier: cumulative-link regression on hashed text.

Grades are ordered (0 worst). One weight vector over hashed word features gives
a document a score s, and ordered thresholds t turn it into
P(grade <= k) = sigmoid(t_k - s). The expected grade and the probability of the
top grade select documents.

The model is fitted on a bounded sample of labelled rows (``sample_rows``, the
lowest hashes of the ids); every document is scored.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm import textkit
from vigil.llm.common import every, materialize, small_batches, trim_memory
from vigil.session import ship_package

#: Hashed feature space; its weights are all that is sent to the executors.
FEATURE_BITS = 18
#: Labelled rows the fit may use.
SAMPLE_ROWS = 12_000
#: Rows of the sample that must hold a feature, however large the sample.
LEAST_ROWS = 3
#: Squared standard deviations from its share of some grade at which a feature has half its rarity's weight.
HALF_EVIDENCE = 10
#: Least probability of the top grade that is accepted.
LEAST = 0.6

_CORE = np.zeros(256, dtype=bool)
_CORE[48:58] = _CORE[65:91] = _CORE[97:123] = _CORE[128:] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, feature, value) of a batch: words without edge marks, edge marks, shouted and repeated words."""
    lowered = textkit.LOWER[data]
    starts, ends, owner = textkit.words(data, bounds)
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    at = np.arange(len(data))
    core = _CORE[data]
    first = np.minimum.accumulate(np.where(core, at, len(data))[::-1])[::-1][starts]
    last = np.maximum.accumulate(np.where(core, at, -1))[ends - 1] + 1
    marks_only = first >= ends
    first, last = np.where(marks_only, starts, first), np.where(marks_only, ends, last)
    word = textkit.span_hashes(lowered, first, last)
    tail = textkit.span_hashes(data, last, ends) ^ np.uint64(0x5851F42D4C957F2D)
    upper = np.concatenate([[0], np.cumsum(_UPPER[data])])
    shouted = (upper[last] - upper[first] >= 2) & (upper[last] - upper[first] == last - first)
    again = np.concatenate([[False], (word[1:] == word[:-1]) & (owner[1:] == owner[:-1])])
    marked = last < ends
    texts = np.concatenate([owner, owner[marked], owner[shouted], owner[again]])
    hashes = np.concatenate(
        [word, tail[marked], np.full(shouted.sum(), 11, np.uint64), np.full(again.sum(), 13, np.uint64)]
    )
    place = (textkit.mix(hashes) >> np.uint64(64 - FEATURE_BITS)).astype(np.int64)
    pairs, counts = np.unique((texts << FEATURE_BITS) | place, return_counts=True)
    return pairs >> FEATURE_BITS, pairs & ((1 << FEATURE_BITS) - 1), np.log1p(counts)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Ordinal:
    """Rarity and weight of each feature, and the ordered thresholds."""

    rarity: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray

    def scores(self, texts: np.ndarray, places: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
        """Weights on the length-normalised vectors of ``n`` texts; 0 where no feature is known."""
        weighed = values * self.rarity[places]
        norm = np.sqrt(np.bincount(texts, weighed**2, n))
        return np.bincount(texts, weighed * self.weights[places], n) / np.maximum(norm, 1e-9)


def _normalised(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int) -> tuple[np.ndarray, list]:
    """Rarities and the rows weighed by them.

    A feature's rarity is its log inverse document frequency, the smaller the
    less its rows differ from all rows in their grades: words of one grade
    count however rare that grade is, and the many rare words that stand for
    none don't blur a text.
    """
    held = np.zeros((grades, 1 << FEATURE_BITS))
    for places, _, grade in rows:
        held[grade, places] += 1  # a row has a feature once
    found = held.sum(axis=0)
    share = np.bincount([g for *_, g in rows], minlength=grades)[:, None] / len(rows)
    evidence = ((held - found * share) ** 2 / (found * share * (1 - share) + 1)).max(axis=0)
    rarity = np.where(
        found >= LEAST_ROWS, np.log(len(rows) / np.maximum(found, 1)) * evidence / (evidence + HALF_EVIDENCE), 0.0
    )
    out = []
    for places, values, grade in rows:
        weighed = values * rarity[places]
        known = weighed > 0
        out.append((places[known], weighed[known] / max(np.linalg.norm(weighed), 1e-9), grade))
    return rarity.astype(np.float32), out


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray, int]], grades: int, epochs: int = 30, rate: float = 0.5, decay: float = 1e-5) -> Ordinal:
    """Cumulative-link regression by Adagrad on (features, values, grade) rows."""
    rarity, rows = _normalised(rows, grades)
    weights = np.zeros(1 << FEATURE_BITS)
    counts = np.bincount([g for *_, g in rows], minlength=grades).astype(float) + 1
    upto = np.cumsum(counts)[:-1] / counts.sum()
    base = np.log(upto / (1 - upto))
    steps = np.log(np.maximum(np.diff(base), 1e-3))
    first = base[0]
    seen, seen_t = np.full(len(weights), 1e-6), np.full(grades - 1, 1e-6)
    order = np.random.default_rng(5)
    for _ in range(epochs):
        for batch in np.array_split(order.permutation(len(rows)), max(40, len(rows) // 64)):
            if not len(batch):
                continue
            thresholds = np.concatenate([[first], first + np.cumsum(np.exp(steps))])
            places = np.concatenate([rows[i][0] for i in batch])
            if not len(places):
                continue
            values = np.concatenate([rows[i][1] for i in batch])
            owner = np.repeat(np.arange(len(batch)), [len(rows[i][0]) for i in batch])
            y = np.array([rows[i][2] for i in batch])
            score = np.bincount(owner, weights[places] * values, len(batch))
            bounded = np.concatenate([[-np.inf], thresholds, [np.inf]])
            above, below = _sigmoid(bounded[y + 1] - score), _sigmoid(bounded[y] - score)
            above, below = np.where(y == grades - 1, 1.0, above), np.where(y == 0, 0.0, below)
            p = np.maximum(above - below, 1e-9)
            da, db = above * (1 - above) / p, below * (1 - below) / p
            slope = (da - db) / len(batch)
            spots, inverse = np.unique(places, return_inverse=True)
            grad = np.bincount(inverse, slope[owner] * values) + decay * weights[spots]
            seen[spots] += grad**2
            weights[spots] -= rate * grad / np.sqrt(seen[spots])
            grad_t = np.zeros(grades + 1)
            np.add.at(grad_t, y + 1, -da / len(batch))
            np.add.at(grad_t, y, db / len(batch))
            grad_t = grad_t[1:-1]
            # first threshold moves all of them, each step those above it
            flow = np.cumsum(grad_t[::-1])[::-1]
            pull = np.concatenate([[flow[0]], flow[1:] * np.exp(steps)])
            seen_t += pull**2
            move = rate * pull / np.sqrt(seen_t)
            first -= move[0]
            steps -= move[1:]
    return Ordinal(rarity, weights.astype(np.float32), np.concatenate([[first], first + np.cumsum(np.exp(steps))]))


def grade_column(labels: DataFrame) -> DataFrame:
    """``(doc_id, grade)``: toxic 0, else low quality 1, else 2; the worst of several; rows without a grade go."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") == 1, 2)
    return (
        labels.select("doc_id", grade.alias("grade"))
        .filter("grade is not null and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.min("grade").alias("grade"))
    )


def _sample_features(batches):
    for part in textkit.slices(batches, "text"):
        texts, places, values = features(*textkit.text_bytes(part.column("text")))
        n = part.num_rows
        ends = np.searchsorted(texts, np.arange(n), side="right")
        bounds = np.concatenate([[0], ends]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("grade"),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(places.astype(np.int32))),
                pa.ListArray.from_arrays(pa.array(bounds), pa.array(values.astype(np.float32))),
            ],
            names=["grade", "places", "values"],
        )


def fit(docs: DataFrame, graded: DataFrame, *, grades: int = 3, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Ordinal | None:
    """Fit on the ``sample_rows`` graded ids with the lowest hashes; None without any."""
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    sample = materialize(graded.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "labelled")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(
        F.broadcast(sample), "doc_id"  # sample_rows rows at most
    )
    # a repeated id adds rows; the sample stays bounded
    got = (
        rows.select("grade", "text")
        .mapInArrow(_sample_features, "grade int, places array<int>, values array<float>")
        .limit(2 * sample_rows)
        .toArrow()
        .combine_chunks()
    )
    if not got.num_rows:
        return None
    examples = _examples(got)
    del got
    model = fit_ordinal(examples, grades)
    del examples
    trim_memory(spark)
    return model


def _examples(sample: pa.Table) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """Feature places, values and grade of each row, views of the Arrow buffers, in an order of their content."""
    lists = [sample.column(c).chunk(0) for c in ("places", "values")]
    ends = lists[0].offsets.to_numpy()
    places, values = (x.values.to_numpy() for x in lists)
    grades = sample.column("grade").to_numpy()
    rows = [(places[a:b], values[a:b], int(g)) for a, b, g in zip(ends[:-1], ends[1:], grades, strict=True)]
    return sorted(rows, key=lambda r: (r[2], len(r[0]), zlib.crc32(r[0].tobytes()), zlib.crc32(r[1].tobytes())))


def score_column(spark, model: Ordinal, text: Column) -> Column:
    shared = spark.sparkContext.broadcast(model)  # of fixed size

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        out = []
        for part in textkit.slices(iter([pa.RecordBatch.from_arrays([column], names=["text"])]), "text"):
            texts, places, values = features(*textkit.text_bytes(part.column("text")))
            out.append(shared.value.scores(texts, places, values, part.num_rows))
        return pa.array(np.concatenate(out) if out else np.zeros(0))

    return score(text)


def judge(docs: DataFrame, model: Ordinal | None, *, text_col: str = "text", least: float = LEAST, prefix: str = "") -> DataFrame:
    """Add ``score``, ``expected_grade``, ``p_top`` and ``accepted`` to every row (names after ``prefix``).

    Null and empty texts score 0 and get the prior's grade. Without a model
    nothing is rejected. Repeated rows get equal values; an empty table gives
    no rows.
    """
    spark = docs.sparkSession
    if model is None:
        nothing = F.lit(None).cast("double")
        return docs.withColumns(
            {f"{prefix}score": nothing, f"{prefix}expected_grade": nothing, f"{prefix}p_top": nothing, f"{prefix}accepted": F.lit(True)}
        )
    ship_package(spark)
    small_batches(spark)
    scored = docs.withColumn(f"{prefix}score", score_column(spark, model, F.col(text_col)))
    s = F.col(f"{prefix}score")
    tails = [F.lit(1.0) / (F.lit(1.0) + F.exp(F.lit(float(t)) - s)) for t in model.thresholds]
    expected = tails[0]
    for tail in tails[1:]:
        expected = expected + tail
    return scored.withColumns({f"{prefix}expected_grade": expected, f"{prefix}p_top": tails[-1]}).withColumn(
        f"{prefix}accepted", F.col(f"{prefix}p_top") >= least
    )


def keep_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The accepted rows of ``docs``, all columns as they were."""
    judged = judge(docs, fit(docs, grade_column(labels)), prefix="_quality_")
    return judged.filter(F.col("_quality_accepted")).select(*every(docs))


def query(docs: DataFrame, labels: DataFrame) -> DataFrame:
    model = fit(docs, grade_column(labels))
    return judge(docs.select("doc_id", "text"), model).select("doc_id", "score", "expected_grade", "p_top", "accepted")
