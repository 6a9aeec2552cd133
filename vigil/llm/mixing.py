"""Mixing sources to target weights with hash-threshold histograms.

Token sums by source and hash bucket give, per source, the bucket in which its
budget ends; only that bucket is refined, level by level, until one hash value
is left. Documents are then filtered by their hash alone, without a sort, and
the documents under a smaller budget are always a subset of those under a
larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil.llm.common import WORD, every, materialize, running_rank

#: Bits of the document hash, and bits resolved per histogram level.
HASH_BITS, LEVEL_BITS = 60, 12


def document_hash(doc_id: Column) -> Column:
    """60 bits of the md5 of the id's text; a null id hashes as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long")


def source_targets(sources: DataFrame, weights: tuple[float, ...], ratio: float, cap: float) -> DataFrame:
    """Add ``target`` to ``(s_null, s, source_size)``: weighted shares of ``ratio`` x all, capped.

    Sources are ordered by code point, null last, and weigh ``weights`` in
    turn. What exceeds ``cap`` x a source's own size is shared again among the
    others by weight until none is above. Only scalars reach the driver.
    """
    ranked = running_rank(sources, ["s_null", "s"], "rank")
    pick = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("w", pick).withColumn("cap", F.col("source_size") * float(cap)), "mix-sources")
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    budget, level, capped = total * float(ratio), 0.0, -1
    while True:
        above = F.col("cap") < F.col("w") * level if capped >= 0 else F.lit(False)
        row = ranked.agg(
            F.count_if(above).alias("n"),
            F.coalesce(F.sum(F.when(above, F.col("cap"))), F.lit(0.0)).alias("used"),
            F.coalesce(F.sum(F.when(~above, F.col("w"))), F.lit(0.0)).alias("free"),
        ).first()
        if row["n"] == capped or not row["free"]:
            break
        capped, level = row["n"], (budget - row["used"]) / row["free"]
    share = F.col("w") * level
    return ranked.withColumn("target", F.when(F.col("cap") < share, F.col("cap")).otherwise(share))


def _boundaries(hist: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source, the bucket in which ``rest`` ends, and what is before it."""
    up = Window.partitionBy("s_null", "s").orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    ends = hist.withColumn("upto", F.sum("words").over(up)).join(targets.select("s_null", "s", "rest"), ["s_null", "s"])
    first = ends.filter("upto >= rest").groupBy("s_null", "s").agg(
        F.min(F.struct("b", (F.col("upto") - F.col("words")).alias("before"))).alias("e"),
        F.first("rest").alias("rest"),
    )
    return first.select("s_null", "s", F.col("e.b").alias("b"), (F.col("rest") - F.col("e.before")).alias("rest"))


def mix_thresholds(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Per source: ``full`` takes of every document and ``below``, the hash under which one more is taken."""
    rest = targets.withColumn(
        "full", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    ).withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    rest = materialize(rest.select("s_null", "s", "source_size", "target", "full", "rest"), "mix-rest")
    rows, wanted = sizes.select("s_null", "s", "h", "size"), rest.filter("rest > 0").select("s_null", "s", "rest")
    shift = HASH_BITS
    while shift > 0:
        shift -= LEVEL_BITS
        hist = rows.withColumn("b", F.expr(f"h >> {shift}")).groupBy("s_null", "s", "b").agg(F.sum("size").alias("words"))
        wanted = materialize(_boundaries(hist, wanted), "mix-boundary")
        inside = rows.withColumn("b", F.expr(f"h >> {shift}")).join(wanted.select("s_null", "s", "b"), ["s_null", "s", "b"])
        rows = materialize(
            inside.groupBy("s_null", "s", "h").agg(F.sum("size").alias("size")), "mix-inside"
        )
        counted = rows.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("s_null", "s").alias("k")).first()
        if counted["n"] == counted["k"]:
            break
    # one hash value is left per source: take it if that comes nearer the target
    last = rows.join(wanted.select("s_null", "s", "rest"), ["s_null", "s"])
    below = last.select(
        "s_null", "s", (F.col("h") + F.when(F.col("size") - F.col("rest") < F.col("rest"), 1).otherwise(0)).alias("below")
    )
    return rest.join(below, ["s_null", "s"], "left").withColumn("below", F.coalesce("below", F.lit(0)))


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> list[Column]:
    return [
        F.col(source_col).isNull().alias("s_null"),
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("s"),
        F.regexp_count(F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD)).cast("long").alias("size"),
        document_hash(F.col(id_col)).alias("h"),
    ]


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    ratio: float = 1.5,
    cap: float = 2.0,
) -> DataFrame:
    """One row per document: ``id, size, source_size, target, times``.

    ``times`` is how often the mix takes the document, 0 up to ``cap``. Null
    texts have size 0, null sources are a source of their own, documents that
    share an id share their fate. An empty table gives no rows; other columns
    aren't read.
    """
    sizes = materialize(docs.select(F.col(id_col).alias("id"), *_keyed(docs, id_col, text_col, source_col)), "mix-sizes")
    sources = sizes.groupBy("s_null", "s").agg(F.sum("size").alias("source_size"))
    limits = materialize(mix_thresholds(sizes, source_targets(sources, weights, ratio, cap)), "mix-limits")
    return (
        sizes.join(limits, ["s_null", "s"])
        .withColumn("times", F.col("full") + F.when(F.col("h") < F.col("below"), 1).otherwise(0))
        .select("id", "s_null", "s", "h", "size", "source_size", "target", "times", "full", "below")
    )


def mixed_rows(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every row repeated as often as the mix takes it (0 times: gone)."""
    names = {"id_col": "doc_id", "text_col": "text", "source_col": "source"}
    names |= {k: v for k, v in options.items() if k in names}
    limits = materialize(mix(docs, **options).select("s_null", "s", "full", "below").distinct(), "mix-applied")
    keyed = docs.select(
        F.struct(*every(docs)).alias("row"),
        F.col(names["source_col"]).isNull().alias("s_null"),
        F.coalesce(F.col(names["source_col"]).cast("string"), F.lit("")).alias("s"),
        document_hash(F.col(names["id_col"])).alias("h"),
    )
    times = F.col("full") + F.when(F.col("h") < F.col("below"), 1).otherwise(0)
    return (
        keyed.join(limits, ["s_null", "s"])
        .withColumn("times", times)
        .filter("times > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
        .select("row.*")
    )


def query(docs: DataFrame) -> DataFrame:
    return mix(docs).select(
        F.col("id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("times")).cast("long").alias("taken"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS s_null, coalesce(source, '') AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15))::BIGINT AS h
  FROM documents
), src AS (
  SELECT s_null, s, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL
), weighed AS (
  SELECT *, CAST([5, 2, 1][((row_number() OVER (ORDER BY s_null, s) - 1) % 3 + 1)::INT] AS DOUBLE) AS w,
         source_size * CAST(2 AS DOUBLE) AS cap, sum(source_size) OVER () * CAST(1.5 AS DOUBLE) AS budget
  FROM src
), filled AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, s_null, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(w) OVER (ORDER BY cap / w, s_null, s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) AS level
  FROM weighed
), lv AS (
  SELECT min(level) AS level FROM filled
  WHERE cap / w >= level AND NOT EXISTS (SELECT 1 FROM filled f WHERE f.cap / f.w >= f.level AND f.cap / f.w < filled.cap / filled.w)
), targets AS (
  SELECT s_null, s, source_size,
         CASE WHEN cap < w * (SELECT level FROM lv) OR (SELECT level FROM lv) IS NULL THEN cap ELSE w * (SELECT level FROM lv) END AS target
  FROM weighed
), rests AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS f,
         target - (CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END)::BIGINT * source_size AS rest
  FROM targets
), sums AS (
  SELECT s_null, s, h, sum(size) AS words FROM d GROUP BY ALL
), upto AS (
  SELECT *, sum(words) OVER (PARTITION BY s_null, s ORDER BY h) AS upto FROM sums
), ends AS (
  SELECT s_null, s, arg_min(h, h) AS h, arg_min(words, h) AS words, arg_min(rest - (upto - words), h) AS rest
  FROM upto JOIN rests USING (s_null, s) WHERE rest > 0 AND upto >= rest GROUP BY ALL
), below AS (
  SELECT s_null, s, h + CASE WHEN words - rest < rest THEN 1 ELSE 0 END AS below FROM ends
)
SELECT doc_id, size, source_size, target,
       (size * (f + CASE WHEN h < coalesce(below, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN rests USING (s_null, s) LEFT JOIN below USING (s_null, s)
"""
