"""Benchmark decontamination by a generalised suffix automaton.

The normalised test items are entered into one automaton over words, whose
states stand for all passages of any item. A text's words are streamed through
it, tracking the longest passage that ends at each word. Where that is at least
a window long, the state says which items hold the window, and its words are hit.

Words that aren't of any item, or that follow a word they never follow in an
item, end every match; they are sorted out by vectorised hashing before the
automaton, which reads the words themselves, sees the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigil.llm import textkit
from vigil.llm.common import every, located, materialize, small_batches
from vigil.session import ship_package

#: Words of a window.
WINDOW = 10
#: Bytes of item texts in one automaton; every further automaton reads all texts once more.
AUTOMATON_BYTES = 4 << 20

#: Characters outside words (a fixed value of the contract; capitals are lowered first).
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_WORDS = re.compile(rb"[0-9a-z\x80-\xff]+")
_TEXT_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")

_OUTSIDE = np.ones(256, dtype=bool)
_OUTSIDE[48:58] = _OUTSIDE[97:123] = _OUTSIDE[128:] = False


def words_of(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode("utf-8", "surrogatepass").translate(textkit.LOWER.tobytes()))


class Automaton:
    """Suffix automaton of several word sequences, with the items of each window."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int):
        self.window = window
        self.words: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        coded = [(i, [self.words.setdefault(w, len(self.words)) for w in ws]) for i, ws in items if ws]
        for _, sequence in coded:
            last = 0
            for c in sequence:
                last = self._extend(last, c)
        #: (state, window length) -> items whose window of that length the state holds
        self.marks: dict[tuple[int, int], set] = {}
        self.lengths = sorted({min(window, len(s)) for _, s in coded})
        for i, sequence in coded:
            size, state = min(window, len(sequence)), 0
            for n, c in enumerate(sequence, 1):
                state = self.next[state][c]
                if n >= size:
                    state = self._shortened(state, size)
                    self.marks.setdefault((state, size), set()).add(i)
        self._found: dict[int, list[tuple[int, tuple]]] = {}
        hashes = textkit.span_hashes(*_joined(list(self.words)))
        pairs = np.array(sorted({p for _, s in coded for p in zip(s, s[1:])}), dtype=np.int64).reshape(-1, 2)
        self.known = _table(hashes)
        self.pairs = _table(_pair(hashes[pairs[:, 0]], hashes[pairs[:, 1]]))

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, c: int) -> int:
        """The state that ``c`` leads to from ``state``, holding nothing longer than that."""
        to = self.next[state][c]
        if self.length[to] == self.length[state] + 1:
            return to
        own = self._new(self.length[state] + 1, self.link[to], dict(self.next[to]))
        self.link[to] = own
        while state >= 0 and self.next[state].get(c) == to:
            self.next[state][c] = own
            state = self.link[state]
        return own

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        state = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and c not in self.next[last]:
            self.next[last][c] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, c)
        return state

    def _shortened(self, state: int, size: int) -> int:
        """The state of the last ``size`` words of what ``state`` holds."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def windows(self, state: int) -> list[tuple[int, tuple]]:
        """Windows that end where ``state`` does: (length, items), remembered."""
        found = self._found.get(state)
        if found is None:
            found = []
            for size in self.lengths:
                if size <= self.length[state]:
                    items = self.marks.get((self._shortened(state, size), size))
                    if items:
                        found.append((size, tuple(items)))
            self._found[state] = found
        return found

    def matches(self, text_words: list[bytes]) -> Iterator[tuple[int, int, tuple]]:
        """(first word, word after the last, items) of every window that occurs, by its end."""
        state = longest = 0
        for n, word in enumerate(text_words, 1):
            c = self.words.get(word, -1)
            while state and c not in self.next[state]:
                state = self.link[state]
                longest = self.length[state]
            to = self.next[state].get(c)
            if to is None:
                longest = 0
                continue
            state, longest = to, longest + 1
            for size, items in self.windows(state):
                if size <= longest:
                    yield n - size, n, items


def _joined(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ends = np.cumsum([len(w) for w in words], dtype=np.int64)
    return np.frombuffer(b"".join(words), dtype=np.uint8), ends - [len(w) for w in words] if words else ends, ends


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return textkit.mix(a * np.uint64(0xD6E8FEB86659FD93) + b)


def _table(hashes: np.ndarray) -> np.ndarray:
    """Marks of the hashes' low bits; at most one in 16 is set."""
    bits = max(10, int(16 * max(1, len(hashes))).bit_length())
    marks = np.zeros(1 << bits, dtype=bool)
    marks[hashes & np.uint64(len(marks) - 1)] = True
    return marks


def _among(marks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return marks[hashes & np.uint64(len(marks) - 1)]


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[dict] = []
    for a, b in sorted(spans):
        if out and a <= out[-1]["start"] + out[-1]["words"]:
            out[-1]["words"] = max(out[-1]["words"], b - out[-1]["start"])
        else:
            out.append({"start": a, "words": b - a})
    return out


SPANS = "array<struct<start: bigint, words: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("words", pa.int64())]))


def _scan(held, carried: pa.Schema, only_hits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton: Automaton = held.value
        shortest = automaton.lengths[0] if automaton.lengths else 1
        for batch in textkit.slices(batches, "text"):
            data, bounds = textkit.text_bytes(batch.column("text"))
            data = textkit.LOWER[data]
            starts, ends, owner = textkit.words(data, bounds, _OUTSIDE)
            hashes = textkit.span_hashes(data, starts, ends)
            follows = (owner[1:] == owner[:-1]) & _among(automaton.pairs, _pair(hashes[:-1], hashes[1:]))
            # runs of words in which each may follow the one before
            edge = np.flatnonzero(~np.concatenate([[False], follows, [False]])) if len(starts) else np.zeros(1, np.int64)
            long = np.flatnonzero(np.diff(edge) >= shortest)
            if shortest == 1:
                long = long[(np.diff(edge)[long] > 1) | _among(automaton.known, hashes[edge[long]])]
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            first = np.searchsorted(owner, np.arange(batch.num_rows))
            for a, b in zip(edge[long].tolist(), edge[long + 1].tolist(), strict=True):
                row = int(owner[a])
                own = [data[s:e].tobytes() for s, e in zip(starts[a:b], ends[a:b], strict=True)]
                at = a - int(first[row])
                for start, end, those in automaton.matches(own):
                    mine = spans.setdefault(row, [])
                    if mine and mine[-1][1] >= at + start:
                        mine[-1] = (min(mine[-1][0], at + start), at + end)
                    else:
                        mine.append((at + start, at + end))
                    items.setdefault(row, set()).update(x for x in those if x is not None)
            count = np.bincount(owner, minlength=batch.num_rows)
            rows = sorted(spans) if only_hits else range(batch.num_rows)
            kept = batch.take(pa.array(list(rows), pa.int64())) if only_hits else batch
            yield pa.RecordBatch.from_arrays(
                [
                    *[kept.column(c) for c in carried.names],
                    pa.array(count[list(rows)] if only_hits else count, pa.int64()),
                    pa.array([_merged(spans.get(r, [])) for r in rows], _SPANS),
                    pa.array([sorted(items.get(r, ())) for r in rows], pa.list_(pa.string())),
                ],
                names=[*carried.names, "n_words", "spans", "items"],
            )

    return run


def _automata(items: DataFrame, id_col: str, text_col: str, window: int, most_bytes: int) -> Iterator[Automaton]:
    """The items' automata, one after the other, each of about ``most_bytes`` of text."""
    texts = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = texts.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16)).first()[0] or 0
    parts = max(1, -(-size // most_bytes))
    for part in range(parts):
        mine = texts.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).toArrow()
        rows = zip(mine.column("item").to_pylist(), mine.column("text").to_pylist(), strict=True)
        yield Automaton([(i, words_of(t)) for i, t in rows], window)


def _union(spans: Column) -> Column:
    """Spans put in order and joined where they meet."""
    empty = F.array().cast(SPANS)

    def add(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        until = F.greatest(last["start"] + last["words"], x["start"] + x["words"])
        joined = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["start"].alias("start"), (until - last["start"]).alias("words"))))
        return F.when((F.size(done) > 0) & (x["start"] <= F.try_element_at(done, F.lit(-1))["start"] + F.try_element_at(done, F.lit(-1))["words"]), joined).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), empty, add)


def scan(
    docs: DataFrame,
    items: DataFrame,
    *,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``_doc`` (the row of ``docs``), ``n_words``, ``spans`` of hit words, ``items`` with windows in the text.

    A window is ``window`` consecutive words of an item, or the whole of an item
    with fewer. Null, empty and wordless texts hit nothing, and such items have
    no windows. Rows of one item id are one item; windows of rows with a null id
    hit, and aren't listed. Repeated documents are judged each. An empty table of
    documents gives no rows, one of items no hits.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    whole = F.struct(*every(docs)).alias("_doc")
    parts = _automata(items, item_id_col, item_text_col, window, automaton_bytes)
    held = next(parts)
    text = F.col(f"`{text_col}`").cast("string").alias("text")
    second = next(parts, None)
    if second is None:
        source = docs.select(whole, text)
        carried = pa.schema([("_doc", pa.null())])
        found = spark.createDataFrame([], f"n_words long, spans {SPANS}, items array<string>").schema
        out = T.StructType([source.schema["_doc"], *found])
        return source.mapInArrow(_scan(spark.sparkContext.broadcast(held), carried, False), out)
    # several automata: their findings are joined by the documents' places
    placed = located(docs.select(whole), "documents")
    narrow = placed.select("_file", "_row", F.col("_doc").getField(text_col).cast("string").alias("text"))
    carried = pa.schema([("_file", pa.null()), ("_row", pa.null())])
    out = f"_file string, _row long, n_words long, spans {SPANS}, items array<string>"
    found = []
    for automaton in [held, second]:
        found.append(materialize(narrow.mapInArrow(_scan(spark.sparkContext.broadcast(automaton), carried, bool(found)), out), "matches"))
    for automaton in parts:
        found.append(materialize(narrow.mapInArrow(_scan(spark.sparkContext.broadcast(automaton), carried, True), out), "matches"))
    all_found = found[0]
    for more in found[1:]:
        all_found = all_found.union(more)
    merged = all_found.groupBy("_file", "_row").agg(
        F.max("n_words").alias("n_words"),
        _union(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return placed.join(merged, ["_file", "_row"]).select("_doc", "n_words", "spans", "items")


def n_hit() -> Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda s, x: s + x["words"])


def _without(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    """Texts without the words of their spans, and without what lies between these."""
    for texts, starts, sizes in batches:
        out = []
        for text, first, many in zip(texts.to_pylist(), starts.to_pylist(), sizes.to_pylist(), strict=True):
            if text is not None and first:
                found, kept, at = [m.span() for m in _TEXT_WORDS.finditer(text)], [], 0
                for a, n in zip(first, many, strict=True):
                    kept.append(text[at : found[a][0]])
                    at = found[a + n - 1][1]
                text = "".join([*kept, text[at:]])
            out.append(text)
        yield pa.array(out, pa.string())


def keep_rows(docs: DataFrame, items: DataFrame, *, text_col: str = "text", most_coverage: float = 0.5, **how) -> DataFrame:
    """``docs`` without hit spans; documents with more than ``most_coverage`` of their words hit go."""
    judged = scan(docs, items, text_col=text_col, **how).filter(n_hit() <= F.lit(most_coverage) * F.col("n_words"))
    old = F.col("_doc").getField(text_col)
    cut = F.arrow_udf(_without, "string")(old.cast("string"), F.col("spans.start"), F.col("spans.words"))
    return judged.select(*[(cut.cast(docs.schema[c].dataType) if c == text_col else F.col("_doc").getField(c)).alias(c) for c in docs.columns])


def query(docs: DataFrame, items: DataFrame) -> DataFrame:
    judged = scan(docs.select("doc_id", "text"), items)
    return judged.select(
        F.col("_doc.doc_id").alias("doc_id"),
        "n_words",
        n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (n_hit() > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), s AS (
  SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item_id, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS t FROM s
), g AS (
  SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k
), hits AS (
  SELECT r, p, k, item_id FROM (SELECT r, p, k, array_to_string(list_slice(w, p, p + k - 1), ' ') AS t FROM g) JOIN windows USING (k, t)
), covered AS (
  SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + k)) AS q FROM hits) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT r, item_id::VARCHAR AS id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""
