"""Spelling variants by a frequency-vector trie.

A word is filed by its length and then by how often it uses each of a few
groups of letters. One inserted, deleted or replaced letter raises at most one
of these counts by one and lowers at most one by one, so a depth-first search
down the trie with a budget of one surplus and one deficit meets every word
that is one edit away; the words at the leaves are verified letter by letter.

The trie is dealt out by its upper levels: a node with too many words is split
by the next count, and a word is sent, with what is left of its budget, to
every node it can reach. Within a task the search carries all words sent to a
node down the node's subtree at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.llm.common import materialize
from vigil.session import ship_package

#: Letter groups in the order of the trie's levels; other letters by code point.
GROUPS = ("e", "a", "n", "i", "r", "o", "t", "s", "lqz", "uwx", "dky", "cvj", "mfg", "hpb")
#: Words filed in one task, and words searched for in one task.
NODE_WORDS, CHUNK_WORDS = 50_000, 400_000
#: Pairs that are verified rather than searched further down.
LEAF_PAIRS = 1 << 12

_group = np.arange(256) % len(GROUPS)
for _g, _letters in enumerate(GROUPS):
    _group[[ord(c) for c in _letters]] = _g


def word_counts(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", divisor: int = 97, least_length: int = 5, least_n: int = 3) -> DataFrame:
    """``word, n``: the distinct words of the texts and how often they occur.

    A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]`` with A-Z lower-cased.
    Where ``divisor`` divides the crc32 of ``<id>:<run>``, the run loses the code
    point at crc32 modulo its length. A null id reads as the empty string.
    """
    run = F.explode(F.regexp_extract_all(text_col, F.lit("[A-Za-zÀ-ÿ]{%d,}" % least_length), F.lit(0)))
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), run.alias("run"))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    # lower() is faster than translate(), and differs on U+00C0 to U+00DE only
    low = runs.select(
        "id", F.when(F.col("run").rlike("[À-Þ]"), F.translate("run", upper, lower)).otherwise(F.lower("run")).alias("run")
    )
    hashed = low.select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"), F.length("run").alias("l"))
    at = F.col("h") % F.col("l")
    cut = F.concat(F.col("run").substr(F.lit(1), at.cast("int")), F.col("run").substr((at + 2).cast("int"), F.col("l")))
    words = hashed.select(F.when(F.col("h") % divisor == 0, cut).otherwise(F.col("run")).alias("word"))
    return (
        words.filter(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") >= least_n)
    )


def _uses(level: int) -> Column:
    """How often ``word`` uses the letters of a level's group."""
    letters = "".join(chr(c) for c in [*range(97, 123), *range(0xC0, 0x100)] if _group[c] == level)
    return F.length("word") - F.length(F.translate("word", letters, ""))


def _filed(words: DataFrame, most: int) -> tuple[DataFrame, DataFrame]:
    """``(stored, probes)``: words by the node that files them, and by each node they are looked up in.

    Both carry ``path``; a node holds at most ``most`` words unless its words
    agree in all counts.
    """
    stored = words.select("word", "n", F.length("word").cast("string").alias("path"))
    probes = words.select(
        "word",
        "n",
        F.explode(
            F.array(*[F.struct((F.length("word") + d).cast("string").alias("path"), F.lit(int(d >= 0)).alias("up"), F.lit(int(d <= 0)).alias("down")) for d in (-1, 0, 1)])
        ).alias("x"),
    ).select("word", "n", "x.*")
    done: list[tuple[DataFrame, DataFrame]] = []
    for level in range(len(GROUPS) + 1):
        sizes = materialize(stored.groupBy("path").agg(F.count(F.lit(1)).alias("size")), "trie-nodes")
        full = level < len(GROUPS) and sizes.agg(F.max("size")).first()[0] or 0
        stored, probes = stored.join(sizes, "path"), probes.join(sizes, "path")
        if full <= most:
            done.append((stored, probes))
            break
        stored, probes = materialize(stored, "trie-words"), materialize(probes, "trie-probes")
        done.append((stored.filter(F.col("size") <= most), probes.filter(F.col("size") <= most)))
        uses = _uses(level)
        stored = stored.filter(F.col("size") > most).select("word", "n", F.concat_ws(".", "path", uses.cast("string")).alias("path"))
        step = lambda by, up, down: F.struct((uses + by).alias("c"), (F.col("up") - up).alias("up"), (F.col("down") - down).alias("down"))
        steps = F.filter(F.array(step(0, 0, 0), step(1, 1, 0), step(-1, 0, 1)), lambda x: (x["c"] >= 0) & (x["up"] >= 0) & (x["down"] >= 0))
        probes = (
            probes.filter(F.col("size") > most)
            .select("word", "n", "path", F.explode(steps).alias("x"))
            .select("word", "n", F.concat_ws(".", "path", F.col("x.c").cast("string")).alias("path"), "x.up", "x.down")
        )
    columns = ["word", "n", "path", "size"]
    left, right = done[0][0].select(columns), done[0][1].select(columns)
    for a, b in done[1:]:
        left, right = left.union(a.select(columns)), right.union(b.select(columns))
    return left, right


def letters(words: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All words' code points end to end (they are below 256) and the bounds between them."""
    texts = words.to_pylist()
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    return np.frombuffer("".join(texts).encode("latin-1"), dtype=np.uint8), bounds


def counts(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Per word the uses of each letter group."""
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    cells = owner * len(GROUPS) + _group[flat]
    return np.bincount(cells, minlength=(len(bounds) - 1) * len(GROUPS)).reshape(-1, len(GROUPS)).astype(np.int32)


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of ``a`` and ``b`` (code points of words, one length each) differ by exactly one edit."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] > b.shape[1]:
        a, b = b, a
    width = a.shape[1]
    parted = a != b[:, :width]
    head = np.where(parted.any(axis=1), parted.argmax(axis=1), width)
    parted = (a != b[:, 1:])[:, ::-1]
    tail = np.where(parted.any(axis=1), parted.argmax(axis=1), width)
    return head + tail >= width


def search(stored: pa.Table, probes: pa.Table, leaf_pairs: int = LEAF_PAIRS) -> pa.Table:
    """Per probe with near words among ``stored``: their number, and the one of largest n (ties: least).

    All stored words have one length; probes are one letter shorter to one
    letter longer.
    """
    stored = stored.sort_by([("n", "descending"), ("word", "ascending")])
    flat, bounds = letters(stored.column("word"))
    length = int(bounds[1])
    grid, filed = flat.reshape(-1, length), counts(flat, bounds)
    order = np.lexsort(filed.T[::-1])
    filed = filed[order]
    flat, bounds = letters(probes.column("word"))
    wanted, sizes = counts(flat, bounds), np.diff(bounds)
    near = np.zeros(len(sizes), dtype=np.int64)
    best = np.full(len(sizes), len(grid), dtype=np.int64)  # places in the stored order

    def verify(low: int, high: int, alive: np.ndarray, size: int) -> None:
        theirs = flat[bounds[alive][:, None] + np.arange(size)]
        block = max(1, (1 << 22) // (length * (high - low)))
        for at in range(0, len(alive), block):
            part = alive[at : at + block]
            a = np.repeat(theirs[at : at + block], high - low, axis=0)
            own = np.tile(order[low:high], len(part))
            hit = np.flatnonzero(one_edit(a, grid[own]))
            who = part[hit // (high - low)]
            np.add.at(near, who, 1)
            np.minimum.at(best, who, own[hit])

    for size in (length - 1, length, length + 1):
        alive = np.flatnonzero(sizes == size)
        up, down = int(length >= size), int(length <= size)
        # a trie node: its words, its level, the probes that reach it and their budgets
        todo = [(0, len(grid), 0, alive, np.full(len(alive), up, np.int8), np.full(len(alive), down, np.int8))]
        while todo:
            low, high, level, alive, up, down = todo.pop()
            if not len(alive):
                continue
            if level == len(GROUPS) or (high - low) * len(alive) <= leaf_pairs:
                # a leaf may hold many words: they are taken in blocks
                for at in range(low, high, 1 << 10):
                    verify(at, min(high, at + (1 << 10)), alive, size)
                continue
            here = filed[low:high, level]
            edges = np.concatenate([[0], np.flatnonzero(here[1:] != here[:-1]) + 1, [high - low]])
            mine = wanted[alive, level]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                surplus = here[a] - mine
                more, less = up - np.maximum(surplus, 0), down + np.minimum(surplus, 0)
                go = np.flatnonzero((more >= 0) & (less >= 0))
                if len(go):
                    todo.append((low + int(a), low + int(b), level + 1, alive[go], more[go].astype(np.int8), less[go].astype(np.int8)))
    hit = np.flatnonzero(near)
    chosen = stored.take(pa.array(best[hit]))
    return pa.table(
        {"word": probes.column("word").take(pa.array(hit)), "near": pa.array(near[hit]), "best_n": chosen.column("n"), "best": chosen.column("word")}
    )


def near_words(words: DataFrame, *, node_words: int = NODE_WORDS, chunk_words: int = CHUNK_WORDS) -> DataFrame:
    """``word, near, best_n, best`` of each word with near words; ``words`` has distinct ``word`` and ``n``.

    A task holds at most ``node_words`` filed words and about ``chunk_words``
    searched ones: nodes with more of either are dealt out in blocks.
    """
    ship_package(words.sparkSession)
    stored, probes = _filed(words, node_words)
    probes = materialize(probes, "trie-probes")
    asked = probes.groupBy("path").agg(F.count(F.lit(1)).alias("asked"))
    blocks = lambda rows, most: F.ceil(F.col(rows) / most).cast("int")
    dealt = lambda rows, most: F.pmod(F.xxhash64("word"), blocks(rows, most)).cast("int")
    every = lambda rows, most: F.explode(F.sequence(F.lit(0), blocks(rows, most) - 1))
    stored = stored.join(asked, "path").select("word", "n", "path", dealt("size", node_words).alias("a"), every("asked", chunk_words).alias("b"))
    probes = probes.join(asked, "path").select("word", "path", "size", dealt("asked", chunk_words).alias("b"))
    probes = probes.select("word", "path", every("size", node_words).alias("a"), "b")
    key = ["path", "a", "b"]

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"word": pa.array([], pa.string()), "near": pa.array([], pa.int64()), "best_n": pa.array([], pa.int64()), "best": pa.array([], pa.string())})
        return search(left, right)

    found = stored.groupBy(key).cogroup(probes.groupBy(key)).applyInArrow(run, "word string, near long, best_n long, best string")
    return (
        found.groupBy("word")
        .agg(F.sum("near").alias("near"), F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("x"))
        .select("word", "near", (-F.col("x.m")).alias("best_n"), "x.best")
    )


def variants(words: DataFrame, **sizes: int) -> DataFrame:
    """One row per word of ``words (word, n)``: ``word, form, root, n, n_near, form_n``.

    The form is the near word of largest n, ties to the least word, if that n is
    at least twice the word's; root follows forms to the last. Counts at least
    double along the way, so the pointer jumping ends after a few rounds.
    """
    near = near_words(words, **sizes)
    chosen = F.col("best_n") >= 2 * F.col("n")
    told = materialize(
        words.join(near, "word", "left").select(
            "word",
            F.when(chosen, F.col("best")).alias("form"),
            "n",
            F.coalesce("near", F.lit(0)).cast("long").alias("n_near"),
            F.when(chosen, F.col("best_n")).alias("form_n"),
        ),
        "spelling",
    )
    up = told.filter("form is not null").select("word", F.col("form").alias("root"))
    while True:
        above = up.select(F.col("word").alias("root"), F.col("root").alias("higher"))
        moved = materialize(up.join(above, "root", "left").select("word", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")), "roots")
        up = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            break
    return told.join(up, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_variants(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **sizes: int) -> DataFrame:
    """Words of ``docs`` with their spelling groups; columns as in ``variants``.

    Null, empty and letterless texts have no words; a null id counts as the empty
    string; repeated rows count again. Long texts and long words are whole. An
    empty table gives no rows. Other columns aren't read.
    """
    words = materialize(word_counts(docs, id_col=id_col, text_col=text_col), "words")
    return variants(words, **sizes)


def query(docs: DataFrame) -> DataFrame:
    return spelling_variants(docs)


ORACLE_SQL = """
WITH crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]{5,}')) AS run
  FROM documents
), counted AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' || run AS s, run, count(*) AS m FROM runs GROUP BY doc_id, run
), hexed AS (
  SELECT run, m, hex(encode(s)) AS x FROM counted
), hashed AS (
  SELECT run, m, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(len(x) // 2), lambda i: ('0x' || substr(x, 2 * i + 1, 2))::BIGINT)),
    lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295) AS h
  FROM hexed, crc
), results AS (
  SELECT m, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run) + 2)::BIGINT) ELSE run END AS word
  FROM hashed
), w AS (
  SELECT word, sum(m)::BIGINT AS n FROM results WHERE length(word) >= 5 GROUP BY word HAVING sum(m) >= 3
), cuts AS (
  SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM w
), pat AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS s FROM cuts
), pairs AS (
  SELECT a.word, a.n, b.word AS other, b.n AS m FROM pat a JOIN pat b ON a.p = b.p AND a.s = b.s AND a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM pat a JOIN w b ON a.s = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM pat a JOIN w b ON a.s = b.word
), best AS (
  SELECT word, count(*) AS n_near, max(m) AS m, min(other) FILTER (WHERE m = top) AS other
  FROM (SELECT *, max(m) OVER (PARTITION BY word) AS top FROM pairs) GROUP BY word
), told AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 2 * w.n THEN other END AS form, CASE WHEN m >= 2 * w.n THEN m END AS form_n
  FROM w LEFT JOIN best USING (word)
), walk AS (
  WITH RECURSIVE r AS (
    SELECT word, form AS f, 1 AS k FROM told WHERE form IS NOT NULL
    UNION ALL SELECT r.word, t.form, k + 1 FROM r JOIN told t ON t.word = r.f WHERE t.form IS NOT NULL
  ) SELECT word, max_by(f, k) AS root FROM r GROUP BY word
)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM told LEFT JOIN walk USING (word)
"""
