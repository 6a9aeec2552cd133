"""Embedding near-deduplication by iterative quantisation.

A rotation of the principal axes is learned so that the signs of a vector's
coordinates form a balanced 64-bit code close to the vector (ITQ). Codes are
cut into 16-bit chunks; multi-index Hamming tables find the pairs that agree in
some chunk but for one bit. Every pair found is reranked by the cosine of the
original vectors in double precision. Tables with rotations learned from
different starts make misses at the threshold rare: where vectors have a common
direction, the angle about their mean is wider than the one between them, so
tables are added until pairs made at the threshold from the sample are found.
Each vector length has its own models; without a sample, or if no number of
tables is enough, these are random rotations about the origin, where the angle
is the threshold's own.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize
from vigil.llm.graph import components
from vigil.session import ship_package

TABLES, CHUNKS, CHUNK_BITS = 2, 4, 16
BITS = CHUNKS * CHUNK_BITS
#: Most tables, and the share of pairs at the threshold that they must find.
MOST_TABLES, RECALL = 48, 0.98
#: Least number of sampled vectors of a length that rotations are learned from.
LEAST_SAMPLE = 256
#: Vectors the rotations are learned on (the lowest hashes of the ids).
SAMPLE_ROWS = 10_000


def learn(sample: np.ndarray, seed: int, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """(mean, projection): signs of (x - mean) @ projection are the code's bits."""
    mean = sample.mean(axis=0)
    _, axes = np.linalg.eigh((sample - mean).T @ (sample - mean))  # by rising variance
    axes = axes[:, ::-1][:, :BITS]
    low = (sample - mean) @ axes
    turns = []
    for part in range(-(-BITS // low.shape[1])):  # vectors of few components get several rotations: all bits are learned
        turn = np.linalg.qr(np.random.default_rng([seed, part]).standard_normal((low.shape[1], low.shape[1])))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(low.T @ np.where(low @ turn >= 0, 1.0, -1.0))
            turn = u @ v
        turns.append(axes @ turn)
    return mean, np.concatenate(turns, axis=1)[:, :BITS]


def codes(unit: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    mean, projection = model
    bits = (unit - mean) @ projection >= 0
    return np.packbits(bits, axis=1, bitorder="little").view("<i8")[:, 0]


def about_origin(dim: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """A model that needs no sample: signs of random rotations, as many as fill a code."""
    turns = [np.linalg.qr(np.random.default_rng([dim, seed, part]).standard_normal((dim, dim)))[0] for part in range(-(-BITS // dim))]
    return np.zeros(dim), np.concatenate(turns, axis=1)[:, :BITS]


def tables_about_origin(least: float) -> int:
    """Tables of random rotations that find RECALL of the pairs at cosine ``least`` in expectation."""
    q = math.acos(least) / math.pi
    miss = 1 - (1 - q) ** CHUNK_BITS - CHUNK_BITS * q * (1 - q) ** (CHUNK_BITS - 1)
    return max(TABLES, math.ceil(math.log(1 - RECALL) / math.log(max(miss, 1e-9)) / CHUNKS))


def made_pairs(sample: np.ndarray, least: float, rows: int = 1000) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at cosine ``least``: moved at random, and along the differences of the sample."""
    rng = np.random.default_rng(0)
    x = sample[:rows]
    out = []
    for step in (rng.standard_normal(x.shape), sample[rng.integers(0, len(sample), len(x))] - sample[rng.integers(0, len(sample), len(x))]):
        aside = step - (step * x).sum(axis=1, keepdims=True) * x
        size = np.linalg.norm(aside, axis=1, keepdims=True)
        good = size[:, 0] > 1e-9
        out.append((x[good], least * x[good] + np.sqrt(1 - least**2) * aside[good] / size[good]))
    return out


def finds(a: np.ndarray, b: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Whether some chunk of the codes differs in one bit at most."""
    differ = (codes(a, model) ^ codes(b, model)).view(np.uint16).reshape(len(a), CHUNKS)
    return (np.bitwise_count(differ) <= 1).any(axis=1)


def learn_tables(sample: np.ndarray, least: float) -> list[tuple[np.ndarray, np.ndarray]] | None:
    """Models of as many tables as find RECALL of the made pairs; None if MOST_TABLES don't."""
    pairs = made_pairs(sample, least)
    hits = [np.zeros(len(a), dtype=bool) for a, _ in pairs]
    models: list = []
    while len(models) < MOST_TABLES:
        models.append(learn(sample, len(models)))
        hits = [h | finds(a, b, models[-1]) for h, (a, b) in zip(hits, pairs, strict=True)]
        if len(models) >= TABLES and all(h.mean() >= RECALL for h in hits if len(h)):
            return models
    return None


def _encode(learned: dict[int, list], tables: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = dict(learned)
        for batch in batches:
            vectors = batch.column("v").to_pylist()
            labels = batch.column("label").to_pylist()
            keys: list = [None] * len(vectors)
            scaled: list = [None] * len(vectors)
            out: list = [None] * len(vectors)
            good: dict[int, list[int]] = {}
            for i, v in enumerate(vectors):
                if v and labels[i] is not None and None not in v:
                    x = np.asarray(v, dtype=np.float64)
                    if np.isfinite(x).all() and x.any():
                        good.setdefault(len(v), []).append(i)
            for dim, rows in good.items():
                own = models.get(dim) or [about_origin(dim, t) for t in range(tables)]
                if len(models) < 16:  # a few lengths' models are remembered
                    models[dim] = own
                x = np.array([vectors[i] for i in rows], dtype=np.float64)
                unit = x / np.abs(x).max(axis=1, keepdims=True)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                each = np.stack([codes(unit, m) for m in own], axis=1)
                # by a power of two, which is exact, so that no square overflows or vanishes
                near_one = np.ldexp(x, -np.clip(np.frexp(np.abs(x).max(axis=1))[1], -1000, 1000)[:, None])
                for j, i in enumerate(rows):
                    scaled[i] = near_one[j].tolist()
                    keys[i] = hashlib.blake2b(repr(labels[i]).encode() + x[j].tobytes(), digest_size=16).digest()
                    out[i] = each[j].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(scaled, pa.list_(pa.float64())), pa.array(keys, pa.binary()), pa.array(out, pa.list_(pa.int64()))],
                names=["id", "label", "v", "key", "codes"],
            )

    return run


def _dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def near_vectors(
    vectors: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least: float = 0.93,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """One row per input row: ``id, n_links, component_id, kept``.

    Rows link when their labels are equal and not null, their vectors of equal
    length, and the cosine is ``least`` or more. Vectors that are null, zero, or
    that hold nulls or non-finite numbers link with nothing. Equal vectors form one class and count as linked. Repeated
    ids tie; the component's id is its smallest id. Empty tables give no rows.
    Other columns aren't read.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(label_col).cast("string").alias("label"),
        F.col(vector_col).cast("array<double>").alias("v"),
    )
    usable = rows.filter("v is not null and label is not null and size(v) > 0 and exists(v, x -> x <> 0)").filter(
        "forall(v, x -> x is not null and abs(x) < double('Infinity') and not isnan(x))"
    )
    got = usable.orderBy(F.xxhash64("id"), "id").limit(sample_rows).select("v").toArrow().column("v").combine_chunks()
    learned: dict[int, list] = {}
    if len(got):
        sizes = pc.list_value_length(got)
        for dim, count in zip(*np.unique(sizes.to_numpy(), return_counts=True), strict=True):
            if count < LEAST_SAMPLE:
                continue
            x = pc.list_flatten(got.filter(pc.equal(sizes, dim))).to_numpy().reshape(-1, dim).copy()
            x /= np.abs(x).max(axis=1, keepdims=True)
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            models = learn_tables(x, least)
            if models:
                learned[int(dim)] = models
    # all lengths have as many tables as the one that needs most
    tables = max([tables_about_origin(least), *(len(m) for m in learned.values())])
    for dim, models in learned.items():
        models += [about_origin(dim, t) for t in range(len(models), tables)]
    coded = materialize(
        rows.mapInArrow(_encode(learned, tables), "id long, label string, v array<double>, key binary, codes array<bigint>"), "codes"
    )
    classes = materialize(
        coded.filter("key is not null")
        .groupBy("key")
        .agg(F.first("label").alias("label"), F.first("v").alias("v"), F.first("codes").alias("codes"), F.count(F.lit(1)).alias("m")),
        "vector-classes",
    )
    spots = [(t, c) for t in range(tables) for c in range(CHUNKS)]
    mask = (1 << CHUNK_BITS) - 1
    chunk = lambda t, c: f"(shiftrightunsigned(codes[{t}], {c * CHUNK_BITS}) & {mask}L)"
    indexed = classes.selectExpr(
        "label", "size(v) as dim", "key as a", "codes as ca", "posexplode(array(" + ", ".join(chunk(t, c) for t, c in spots) + ")) as (spot, value)"
    )
    flips = "concat(array(0L), transform(sequence(0, %d), i -> shiftleft(1L, i)))" % (CHUNK_BITS - 1)
    probes = classes.selectExpr(
        "label", "size(v) as dim", "key as b", "codes as cb", "posexplode(array(" + ", ".join(chunk(t, c) for t, c in spots) + ")) as (spot, own)"
    ).selectExpr("label", "dim", "b", "cb", "spot", f"explode(transform({flips}, f -> f ^ own)) as value")
    # a pair is taken at the first chunk that finds it, so it comes once
    first = "case " + " ".join(
        f"when bit_count(shiftrightunsigned(ca[{t}] ^ cb[{t}], {c * CHUNK_BITS}) & {mask}L) <= 1 then {i}"
        for i, (t, c) in enumerate(spots)
    ) + " end"
    pairs = materialize(
        indexed.join(probes, ["label", "dim", "spot", "value"]).filter(F.col("a") < F.col("b")).filter(f"spot = {first}").select("a", "b"),
        "vector-pairs",
    )
    side = lambda x: classes.select(F.col("key").alias(x), F.col("v").alias(f"v{x}"), F.col("m").alias(f"m{x}"))
    cosine = _dot("va", "vb") / F.sqrt(_dot("va", "va")) / F.sqrt(_dot("vb", "vb"))
    links = materialize(
        pairs.join(side("a"), "a").join(side("b"), "b").filter(cosine >= least).select("a", "b", "ma", "mb"), "vector-links"
    )
    degree = (
        links.select(F.col("a").alias("key"), F.col("mb").alias("n"))
        .union(links.select("b", "ma"))
        .groupBy("key")
        .agg(F.sum("n").alias("n"))
    )
    found = components(links.select("a", "b"))
    placed = materialize(
        classes.select("key", "m").join(degree, "key", "left").join(found.withColumnRenamed("v", "key"), "key", "left").select(
            "key", F.coalesce("root", "key").alias("root"), (F.col("m") - 1 + F.coalesce("n", F.lit(0))).alias("n_links")
        ),
        "vector-places",
    )
    rooted = materialize(coded.select("id", "key").join(placed, "key", "left"), "vector-rooted")
    least_id = materialize(rooted.filter("root is not null").groupBy("root").agg(F.min("id").alias("component_id")), "vector-least")
    return rooted.join(least_id, "root", "left").select(
        "id",
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        F.coalesce("component_id", "id").alias("component_id"),
        F.col("id").eqNullSafe(F.coalesce("component_id", "id")).alias("kept"),
    )


def query(vectors: DataFrame) -> DataFrame:
    return near_vectors(vectors).withColumnRenamed("id", "vec_id")


ORACLE_SQL = """
WITH e AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), walk AS (
  WITH RECURSIVE r AS (
    SELECT a AS vec_id, a AS seen FROM links UNION SELECT r.vec_id, l.b FROM r JOIN links l ON r.seen = l.a
  ) SELECT vec_id, min(seen) AS component_id FROM r GROUP BY 1
), degree AS (
  SELECT a AS vec_id, count(*) AS n FROM links GROUP BY 1
)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN walk USING (vec_id) LEFT JOIN degree USING (vec_id)
"""
