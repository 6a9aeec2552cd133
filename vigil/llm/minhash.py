"""MinHash near-deduplication verified by odd sketches and full sets.

Every text becomes its set of five-word shingles. Equal sets form one class.
Per class, MinHash samples give band keys for retrieval and are folded into a
parity bitmap (odd sketch); the XOR population count of two bitmaps estimates
high similarities closely, so it drops most candidates before the exact check
on full shingle sets.

A band bucket is never expanded into all its pairs. First every member is
compared with one pivot. Members that this joins need no further comparison
among themselves. After that, in every group of classes connected by buckets,
those outside the group's largest component are compared exactly with the
members of other components, in blocks of bounded size. A block returns a tree
of links for the components that it joins, not all of its links.
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

from vigil.llm import textkit
from vigil.llm.common import drop_tables, every, located, materialize, release, small_batches
from vigil.llm.graph import components
from vigil.session import ship_package

#: Most rows per band, and bands then: at similarity 0.85 a pair shares no band with probability 5e-6.
ROWS, BANDS = 6, 26
#: The greatest such probability at the threshold; lower thresholds have fewer rows per band.
MISS = 1e-5
SKETCH_BITS = 1024
#: How far below a threshold of 0.85 the sketch's estimate may lie: five standard errors.
SLACK = 0.15
#: Keys of the hash that candidates are found by, and of the one that links are checked with.
RETRIEVE, VERIFY = 0, 1
#: Classes on either side of a block of exact comparisons.
BLOCK = 128


def _functions(count: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = textkit.mix(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return seeds[:count] | np.uint64(1), seeds[count:]


def minhash(values: np.ndarray, firsts: np.ndarray, count: int) -> np.ndarray:
    """(sets, count) minima of ``count`` hash functions over the sets that start at ``firsts``."""
    mult, add = _functions(count)
    out = np.empty((count, len(firsts)), dtype=np.uint64)
    for k in range(count):
        out[k] = np.minimum.reduceat(values * mult[k] + add[k], firsts)
    return out.T


def band_shape(similarity: float) -> tuple[int, int]:
    """Rows per band and bands, out of ROWS * BANDS samples, that miss a pair at ``similarity`` with MISS at most."""
    for rows in range(ROWS, 1, -1):
        bands = ROWS * BANDS // rows
        if (1 - similarity**rows) ** bands <= MISS:
            return rows, bands
    return 1, ROWS * BANDS


def band_keys(samples: np.ndarray, rows: int = ROWS, bands: int = BANDS) -> np.ndarray:
    key = np.zeros((len(samples), bands), dtype=np.uint64) + np.arange(bands, dtype=np.uint64)
    parts = samples[:, : rows * bands].reshape(len(samples), bands, rows)
    for r in range(rows):
        key = textkit.mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """(sets, words) bitmaps: bit p is the parity of the samples hashed to p."""
    n, count = samples.shape
    place = textkit.mix(samples + np.arange(count, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    place = (place >> np.uint64(64 - int(math.log2(SKETCH_BITS)))).astype(np.int64)
    flat = np.bincount((place + np.arange(n)[:, None] * SKETCH_BITS).ravel(), minlength=n * SKETCH_BITS) & 1
    return np.packbits(flat.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1).view(np.int64)


def sketch_limit(similarity: float) -> int:
    """The XOR population count expected of two sketches at ``similarity``."""
    return math.ceil(SKETCH_BITS / 2 * (1 - math.exp(-4 * ROWS * BANDS * (1 - similarity) / SKETCH_BITS)))


def _fingerprint(retrieved: np.ndarray, verified: np.ndarray) -> bytes:
    """Of a set as two independent hashes see it."""
    return hashlib.blake2b(retrieved.tobytes() + verified.tobytes(), digest_size=16).digest()


def _both_sets(part: pa.RecordBatch, size: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Shingle sets under the retrieving and under the verifying hash."""
    data, bounds = textkit.text_bytes(part.column("text"))
    return textkit.shingles(data, bounds, size, RETRIEVE), textkit.shingles(data, bounds, size, VERIFY)


def _signatures(size: int, percent: int):
    shape = band_shape(percent / 100)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textkit.slices(batches, "text"):
            sets, verified = _both_sets(part, size)
            lengths = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(lengths)
            bands: list = [None] * len(sets)
            sketches: list = [None] * len(sets)
            prints: list = [None] * len(sets)
            if len(full):
                firsts = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
                samples = minhash(np.concatenate([sets[i] for i in full]), firsts, ROWS * BANDS)
                keys, odd = band_keys(samples, *shape), odd_sketch(samples)
                for j, i in enumerate(full):
                    bands[i], sketches[i], prints[i] = keys[j], odd[j], _fingerprint(sets[i], verified[i])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    part.column("_file"),
                    part.column("_row"),
                    pa.array(lengths),
                    pa.array(prints, pa.binary()),
                    pa.array(bands, pa.list_(pa.int64())),
                    pa.array(sketches, pa.list_(pa.int64())),
                ],
                names=["id", "_file", "_row", "n", "fp", "bands", "sketch"],
            )

    return run


def _full_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textkit.slices(batches, "text"):
            sets, verified = _both_sets(part, size)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([_fingerprint(s, v) for s, v in zip(sets, verified, strict=True)], pa.binary()),
                    pa.array([v.view(np.int64) for v in verified], pa.list_(pa.int64())),
                ],
                names=["fp", "items"],
            )

    return run


def _incidence(values: np.ndarray, owner: np.ndarray, n: int, vocabulary: np.ndarray) -> np.ndarray:
    place = np.minimum(np.searchsorted(vocabulary, values), len(vocabulary) - 1)
    known = vocabulary[place] == values
    out = np.zeros((n, len(vocabulary)), dtype=np.float32)
    out[owner[known], place[known]] = 1
    return out


def _forest(ends: np.ndarray) -> list[tuple[int, int]]:
    """Of the pairs of nodes those that join what no pair before has joined."""
    top: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := top.get(x, x)) != x:
            top[x] = x = top.get(up, up)
        return x

    out = []
    for a, b in ends.tolist():
        if (x := find(a)) != (y := find(b)):
            top[x] = y
            out.append((a, b))
    return out


def _compare(percent: int):
    """Components that exact links join, between the outsiders and the members of one block.

    Returned are pairs of the components' roots, fewer than the block has rows.
    """

    def run(block: pa.Table) -> pa.Table:
        sides = [block.filter(block.column("out")), block.filter(pc.invert(block.column("out")))]
        sizes, values, owners = [], [], []
        for side in sides:
            items = side.column("items").combine_chunks()
            sizes.append(pc.list_value_length(items).to_numpy(zero_copy_only=False).astype(np.int64))
            values.append(pc.list_flatten(items).to_numpy(zero_copy_only=False))
            owners.append(np.repeat(np.arange(len(items)), sizes[-1]))
        shared = np.intersect1d(values[0], values[1])
        common = np.zeros((len(sizes[0]), len(sizes[1])), dtype=np.float64)
        for at in range(0, len(shared), 1 << 14):
            part = shared[at : at + (1 << 14)]
            common += _incidence(values[0], owners[0], len(sizes[0]), part) @ _incidence(values[1], owners[1], len(sizes[1]), part).T
        union = sizes[0][:, None] + sizes[1][None, :] - common
        names, flat = np.unique(np.array([r for s in sides for r in s.column("root").to_pylist()], dtype=object), return_inverse=True)
        roots = flat[: len(sizes[0])], flat[len(sizes[0]) :]
        i, j = np.nonzero((common * 100 >= union * percent) & (roots[0][:, None] != roots[1][None, :]))
        pairs = _forest(np.unique(np.stack([roots[0][i], roots[1][j]], axis=1), axis=0))
        return pa.table({"a": pa.array([names[x] for x, _ in pairs], pa.binary()), "b": pa.array([names[y] for _, y in pairs], pa.binary())})

    return run


def _distance(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x
    )


class _Verifier:
    """Sketch filter, then the exact check, for pairs ``(a, b)`` of class prints."""

    def __init__(self, docs: DataFrame, reps: DataFrame, size: int, percent: int) -> None:
        self.docs, self.reps, self.size, self.percent = docs, reps, size, percent
        least = percent / 100
        self.limit = sketch_limit(least - SLACK * math.sqrt(least * (1 - least) / (0.85 * 0.15)))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``(fp, items)`` of the texts whose locator hashes are ``wanted (at)``."""
        texts = self.docs.join(wanted.hint("merge"), F.xxhash64("_file", "_row") == F.col("at"), "left_semi").select("text")
        return materialize(texts.mapInArrow(_full_sets(self.size), "fp binary, items array<bigint>"), "near-sets")

    def blocks(self, split: DataFrame) -> DataFrame:
        """Linked components' roots within groups: blocks of outsiders against blocks of all members."""
        wanted = materialize(split.join(self.reps.select("fp", "at"), "fp").select("at").distinct(), "split-texts")
        sets = self.sets(wanted)
        rows = split.join(sets, "fp")
        spread = lambda n, salt: F.pmod(F.xxhash64("fp", F.lit(salt)), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        outside = rows.filter("root <> top").withColumn("o", spread("outside", 1)).withColumn("m", every("blocks"))
        members = rows.withColumn("m", spread("blocks", 2)).withColumn("o", every("outside"))
        columns = ["near", "o", "m", "out", "fp", "root", "items"]
        both = outside.withColumn("out", F.lit(True)).select(columns).union(members.withColumn("out", F.lit(False)).select(columns))
        found = both.groupBy("near", "o", "m").applyInArrow(_compare(self.percent), "a binary, b binary")
        links = materialize(found, "more-links")
        drop_tables(wanted, sets)
        return links.distinct()

    def links(self, pairs: DataFrame) -> DataFrame:
        side = lambda x: self.reps.select(
            F.col("fp").alias(x), F.col("n").alias(f"n{x}"), F.col("sketch").alias(f"s{x}"), F.col("at").alias(f"at{x}")
        )
        # min/max of the set sizes bounds the similarity from above
        near = (
            pairs.join(side("a"), "a")
            .join(side("b"), "b")
            .filter(
                (F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent)
                & (_distance(F.col("sa"), F.col("sb")) <= self.limit)
            )
            .select("a", "b", "ata", "atb")
        )
        near = materialize(near, "near-pairs")
        wanted = materialize(near.select("ata").union(near.select("atb")).toDF("at").distinct(), "near-texts")
        sets = self.sets(wanted)
        both = (
            near.select("a", "b")
            .join(sets.select(F.col("fp").alias("a"), F.col("items").alias("ia")), "a")
            .join(sets.select(F.col("fp").alias("b"), F.col("items").alias("ib")), "b")
            .withColumn("common", F.size(F.array_intersect("ia", "ib")))
            .withColumn("union", F.size("ia") + F.size("ib") - F.col("common"))
        )
        links = materialize(both.filter(F.col("common") * 100 >= F.col("union") * self.percent).select("a", "b"), "links")
        drop_tables(near, wanted, sets)
        return links.distinct()


def near_dedup(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 85,
) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, kept, _file, _row``.

    Texts whose shingle sets have a Jaccard similarity of ``percent``/100 or
    more are linked; a component's id is its smallest id. Null texts and texts
    without words have an empty set and link with nothing. Null ids count as
    larger than any other; rows that repeat an id in one component tie and the
    first by locator is kept. An empty table gives no rows. Other columns
    aren't read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    source = located(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "near-docs")
    signed = materialize(
        source.mapInArrow(
            _signatures(size, percent),
            "id long, _file string, _row long, n long, fp binary, bands array<bigint>, sketch array<bigint>",
        ),
        "signatures",
    )
    reps = materialize(
        signed.filter("fp is not null")
        .groupBy("fp")
        .agg(F.first("n").alias("n"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.min(F.xxhash64("_file", "_row")).alias("at")),
        "classes",
    )
    members = reps.select("fp", F.explode("bands").alias("key"))
    buckets = materialize(
        members.groupBy("key").agg(F.min("fp").alias("pivot"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "buckets"
    )
    verify = _Verifier(source, reps, size, percent)

    star = materialize(
        members.join(buckets, "key").filter("fp <> pivot").select(F.col("pivot").alias("a"), F.col("fp").alias("b")).distinct(),
        "star",
    )
    links = verify.links(star)
    release(spark)
    found = components(links)
    release(spark)

    # what the pivots left apart: in a group of classes that share buckets,
    # those outside its largest component against the other components' classes
    near = components(star).withColumnRenamed("v", "fp").withColumnRenamed("root", "near")
    placed = materialize(
        near.join(found.withColumnRenamed("v", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "placed"
    )
    counts = placed.groupBy("near", "root").agg(F.count(F.lit(1)).alias("m"))
    groups = materialize(
        counts.groupBy("near")
        .agg(F.max(F.struct("m", "root")).alias("top"), F.sum("m").alias("n"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1 and n > 2")
        .select("near", F.col("top.root").alias("top"), F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"),
                F.ceil((F.col("n") - F.col("top.m")) / BLOCK).cast("int").alias("outside")),
        "split-groups",
    )
    split = materialize(placed.join(groups, "near"), "split")
    if not split.isEmpty():
        more = verify.blocks(split)
        if not more.isEmpty():
            higher = components(more).select(F.col("v").alias("root"), F.col("root").alias("higher"))
            found = materialize(
                placed.join(higher, "root", "left").select(F.col("fp").alias("v"), F.coalesce("higher", "root").alias("root")), "found"
            )

    drop_tables(reps, buckets, star, placed, groups, split)
    rooted = materialize(
        signed.select("id", "_file", "_row", "n", "fp")
        .join(found.select(F.col("v").alias("fp"), "root"), "fp", "left")
        .withColumn("root", F.coalesce("root", "fp", F.concat(F.lit("row "), F.col("_file"), F.col("_row")).cast("binary"))),
        "rooted",
    )
    drop_tables(signed)
    least = materialize(
        rooted.groupBy("root").agg(
            F.min("id").alias("component_id"),
            F.min(F.struct(F.col("id").isNull().alias("o"), "id", "_file", "_row")).alias("keep"),
        ),
        "least",
    )
    return rooted.join(least, "root").select(
        "id",
        F.col("n").alias("n_shingles"),
        "component_id",
        ((F.col("_file") == F.col("keep._file")) & (F.col("_row") == F.col("keep._row"))).alias("kept"),
        "_file",
        "_row",
    )


def keep_rows(docs: DataFrame, *, percent: int = 80, **options) -> DataFrame:
    """``docs`` with one row of each near-duplicate component, all columns as they were."""
    try:
        docs.select("_metadata.file_path")
    except Exception:  # not a scan of files: give its rows a place first
        docs = materialize(docs, "near-input")
    dropped = near_dedup(docs, percent=percent, **options).filter(~F.col("kept")).select("_file", "_row")
    rows = docs.select(
        *every(docs), F.col("_metadata.file_path").alias("__file"), F.col("_metadata.row_index").alias("__row")
    )
    return rows.join(
        dropped, (rows["__file"] == dropped["_file"]) & (rows["__row"] == dropped["_row"]), "left_anti"
    ).select(*every(docs))


def query(docs: DataFrame) -> DataFrame:
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return near_dedup(docs, percent=85).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


#: A join over all shingles and a walk over the links: for small tables.
ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i+4], ' ') END AS s
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 3, 2))) AS i) WHERE len(ws) > 0
), n AS (
  SELECT doc_id, count(*) AS n FROM sh GROUP BY 1
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY 1, 2 HAVING 100 * count(*) >= 85 * (any_value(na.n) + any_value(nb.n) - count(*))
), walk AS (
  WITH RECURSIVE r AS (
    SELECT a AS doc_id, a AS seen FROM links UNION SELECT r.doc_id, l.b FROM r JOIN links l ON r.seen = l.a
  ) SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component_id, doc_id) AS component_id, coalesce(component_id, doc_id) = doc_id AS kept
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN walk USING (doc_id)
"""
