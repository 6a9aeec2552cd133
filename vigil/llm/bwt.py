"""Repeated substrings by merging Burrows-Wheeler transforms of shards.

A byte is removed if some ``length``-byte string that covers it starts earlier
too (smaller id, or earlier in the same document).

1. Seeds. Of the ``SEED``-byte strings of every ``length``-byte window the one
   with the least hash is the window's seed; equal windows have equal seeds at
   equal places. A window whose seed occurs once cannot repeat.
2. Collapse. An occurrence of a seed with the bytes of all its windows is a
   snippet. Of equal snippets all but the earliest are repeats as a whole, so
   what is left per seed are its distinct snippets.
3. Split. The windows of a snippet are dealt to halves by their distance from
   the seed. All windows of a half share a longer core, which takes the seed's
   place, and the halves are collapsed again; what no longer recurs drops out.
   This is repeated for cores with more than ``GROUP`` distinct snippets, down
   to single windows, so no task meets a group that grows with the data.
4. Merge. Distinct snippets that share a core are laid out in shards. Every
   shard's suffixes are sorted once into its BWT. The BWTs are merged by
   refining their interleave: scanning it and dealing the shard numbers to the
   BWT's symbols sorts it by one symbol more. The round in which two neighbours
   part gives their longest common prefix, and runs that never part in
   ``length`` rounds are the repeated intervals. No suffix is sorted again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import textkit
from vigil.llm.common import drop_tables, located, materialize, release, small_batches
from vigil.session import ship_package

LENGTH, SEED = 100, 32
#: Distinct snippets of a core that one task merges; beyond, they are split further.
GROUP = 256
#: Bytes of texts searched for seeds at once (a longer text is searched whole).
ANCHOR_BYTES = 1 << 17
#: Bytes of snippets merged at once, and bytes of one shard.
MERGE_BYTES, SHARD_BYTES = 1 << 16, 1 << 13


def rolling(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every ``size``-byte string of ``data``."""
    if len(data) < size:
        return np.zeros(0, np.uint64)
    starts = np.arange(len(data) - size + 1)
    return textkit.span_hashes(data, starts, starts + size)


def seed_spans(data: np.ndarray, bounds: np.ndarray, length: int, seed: int) -> tuple[np.ndarray, ...]:
    """(text, seed position, first window, last window) of every seed of texts laid end to end."""
    n = len(data) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(4))
    # a window's least seed: hash above, place below, so that ties go to the leftmost place
    low = np.uint64(32)
    best = (rolling(data, seed) >> low << low) | np.arange(len(data) - seed + 1, dtype=np.uint64)
    width, span = 1, length - seed + 1
    while width < span:
        step = min(width, span - width)
        best = np.minimum(best[: len(best) - step], best[step:])
        width += step
    spot = (best & np.uint64((1 << 32) - 1)).astype(np.int64)
    text = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))[:n]
    whole = np.arange(n) + length <= bounds[text + 1]
    same = np.zeros(n, bool)  # the window before has the same seed
    same[1:] = (spot[1:] == spot[:-1]) & whole[:-1]
    first = np.flatnonzero(whole & ~same)
    more = np.ones(n + 1, bool)
    more[:n] = ~(same & whole)
    last = np.flatnonzero(more)
    last = last[np.searchsorted(last, first, side="right")] - 1
    return text[first], spot[first], first, last


def _anchors(length: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textkit.slices(batches, "text", ANCHOR_BYTES):
            data, bounds = textkit.text_bytes(part.column("text"))
            row, spot, first, last = seed_spans(data, bounds, length, seed)
            # a snippet is its bytes and where its seed lies in them
            content = textkit.span_hashes(data, first, last + length)
            snippet = textkit.mix(content ^ textkit.mix((spot - first).astype(np.uint64) + np.uint64(77)))
            take = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(textkit.span_hashes(data, spot, spot + seed).view(np.int64)),
                    pa.array(snippet.view(np.int64)),
                    part.column("id").take(take),
                    part.column("rid").take(take),
                    pa.array(pack_place(first - bounds[row], last - first, spot - first)),
                ],
                names=["seed", "snippet", "id", "rid", "at"],
            )

    return run


ANCHOR = "seed long, snippet long, id long, rid long, at long"


def pack_place(start, more, lead):
    """Start, number of further windows and distance to the seed in one number, ordered by start."""
    return (start << 16) | (more << 8) | lead


def unpack_place(at):
    return at >> 16, (at >> 8) & 255, at & 255


SNIPPET = "key binary, snippet binary, id long, rid long, at long, bytes binary"


def _snippets(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [[]] * 6
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["key", "snippet", "id", "rid", "at", "bytes"]
    )


def _halves(key: bytes, id_, rid: int, at: int, raw: bytes, width: int, length: int) -> list[tuple]:
    """The snippet's windows by ``width`` distances from the seed: their core's key and own snippet."""
    start, more, lead = unpack_place(at)
    out = []
    for half in range((lead - more) // width, lead // width + 1):
        near, far = half * width, (half + 1) * width - 1  # distances of this half
        w0, w1 = max(0, lead - far), min(more, lead - near)
        core = raw[lead - near : lead - far + length]
        own = raw[w0 : w1 + length]
        out.append(
            (
                hashlib.blake2b(core, digest_size=16, key=key, salt=half.to_bytes(2, "little")).digest(),
                hashlib.blake2b(own, digest_size=16, salt=(lead - w0).to_bytes(2, "little")).digest(),
                id_, rid, pack_place(start + w0, w1 - w0, lead - w0), own,
            )
        )
    return out


def _cut(length: int, width: int):
    """The wanted snippets of each text, in halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textkit.slices(batches, "text", 4 << 20):
            out: list[tuple] = []
            for text, id_, rid, wanted in zip(*(part.column(c).to_pylist() for c in ("text", "id", "rid", "wanted")), strict=True):
                raw = (text or "").encode()
                for w in wanted:
                    start, more, _ = unpack_place(w["at"])
                    seed = w["seed"].to_bytes(8, "little", signed=True)
                    out += _halves(seed, id_, rid, w["at"], raw[start : start + more + length], width, length)
            yield _snippets(out)

    return run


def _split(length: int, width: int):
    """Snippets in smaller halves."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in textkit.slices(batches, "bytes", MERGE_BYTES):
            out: list[tuple] = []
            for row in zip(*(part.column(c).to_pylist() for c in ("key", "id", "rid", "at", "bytes")), strict=True):
                out += _halves(*row, width, length)
            yield _snippets(out)

    return run


def stable_order(keys: np.ndarray, top: int) -> np.ndarray:
    """``np.argsort(keys, kind="stable")`` of integers up to ``top``, 16 bits at a time."""
    order = np.argsort(keys.astype(np.uint16), kind="stable")
    if top >= 1 << 16:
        order = order[np.argsort((keys >> 16).astype(np.uint16)[order], kind="stable")]
    return order


def shard_bwt(symbols: np.ndarray, ends: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(suffix order, BWT) of one shard: strings of ``symbols`` closed by 0, string numbers break ties.

    ``ends[i]`` is the place of the 0 that closes the string of symbol i.
    Suffixes are sorted to ``depth`` symbols by doubling.
    """
    n = len(symbols)
    here = np.arange(n)
    rank = np.unique(symbols, return_inverse=True)[1].astype(np.int64)
    width = 1
    while width < depth and rank.max(initial=0) < n - 1:
        ahead = here + width
        second = np.where(ahead <= ends, rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = stable_order(second, n)
        order = order[stable_order(rank[order], n)]
        one, two = rank[order], second[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum((one[1:] != one[:-1]) | (two[1:] != two[:-1]))])
        width *= 2
    order = stable_order(rank, n)
    before = np.where(order > 0, symbols[order - 1], 0)
    return order, before


def merge_bwts(bwts: list[np.ndarray], strings: list[int], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(interleave, lcp) of the shards' suffixes, sorted to ``depth`` symbols.

    ``interleave[p]`` is the shard of the suffix at merged rank p, and
    ``lcp[p]`` the common prefix with the suffix before it, at most ``depth``.

    A round sorts by one symbol more: the suffixes one symbol longer than those
    of a block that parted in the round before are dealt again to their ranks,
    in the interleave's order. Where no block parted, nothing can change, so
    the work follows the blocks that do and ends when none does.
    """
    sizes = np.array([len(b) for b in bwts])
    base = np.concatenate([[0], np.cumsum(sizes)])
    symbols = np.concatenate(bwts).astype(np.uint16)
    n, closers = len(symbols), int(sum(strings))
    # the place of the suffix one symbol longer, in the same shard
    longer = np.empty(n, np.int64)
    for b, at in zip(bwts, base, strict=False):
        longer[np.argsort(b.astype(np.uint16), kind="stable") + at] = np.arange(at, at + len(b))
    # round 0: sorted by the first symbol; suffixes at a closing 0 differ from each other
    first = np.concatenate([np.sort(b.astype(np.uint16)) for b in bwts])
    rank = np.argsort(first, kind="stable")  # of each rank, the suffix's place in the shards' orders laid end to end
    part = np.concatenate([[True], np.diff(first[rank]) != 0])
    part[: min(closers + 1, n)] = True
    lcp = np.where(part, 0, depth).astype(np.int64)
    head = np.maximum.accumulate(np.where(part, np.arange(n), 0))  # of each rank, where its block begins
    block = np.empty(n, np.int64)  # the same, of each suffix
    block[rank] = head
    active = np.arange(n)
    for h in range(1, depth):
        members = rank[active]
        members, origin = members[symbols[members] > 0], head[active][symbols[members] > 0]
        moved = longer[members]
        order = stable_order(block[moved], n)
        moved, origin = moved[order], origin[order]
        start = block[moved]
        new = np.concatenate([[True], start[1:] != start[:-1]])[: len(start)]
        within = np.arange(len(start)) - np.maximum.accumulate(np.where(new, np.arange(len(start)), 0))
        place = start + within
        rank[place] = moved
        parts = np.concatenate([[False], origin[1:] != origin[:-1]])[: len(start)] & ~new
        if not parts.any():
            break
        lcp[place[parts]] = h
        begins = np.maximum.accumulate(np.where(new | parts, place, 0))
        head[place] = begins
        block[moved] = begins
        # blocks that parted, whole
        number = np.cumsum(new) - 1
        active = place[np.bincount(number, parts)[number] > 0]
    return np.searchsorted(base, rank, side="right") - 1, lcp


def repeats(strings: list[bytes], depth: int) -> np.ndarray:
    """Marks, over all suffixes laid end to end (a 0 closes each string), with the group of equal ``depth``-prefixes.

    Groups of two or more have a number from 1; other suffixes have 0.
    """
    shards: list[list[int]] = [[]]
    held = 0
    for i, s in enumerate(strings):
        if held and held + len(s) > SHARD_BYTES:
            shards.append([])
            held = 0
        shards[-1].append(i)
        held += len(s) + 1
    bwts, orders, base = [], [], 0
    for members in shards:
        parts = [np.frombuffer(strings[i] + b"\0", np.uint8).astype(np.uint16) + 1 for i in members]
        for p in parts:
            p[-1] = 0
        lengths = np.array([len(p) for p in parts])
        close = np.cumsum(lengths) - 1
        order, before = shard_bwt(np.concatenate(parts), np.repeat(close, lengths), depth)
        orders.append(order + base)
        bwts.append(before)
        base += int(lengths.sum())
    interleave, lcp = merge_bwts(bwts, [len(m) for m in shards], depth)
    place = np.empty(len(interleave), np.int64)
    place[np.argsort(interleave, kind="stable")] = np.concatenate(orders)
    group = np.cumsum(lcp < depth)
    sizes = np.bincount(group)
    out = np.zeros(len(group), np.int64)
    out[place] = np.where(sizes[group] > 1, group, 0)
    return out


def _runs(known: np.ndarray, id_: np.ndarray, rid: np.ndarray, at: np.ndarray, length: int) -> pa.RecordBatch:
    """``id, rid, start, end`` of windows of ``length``, those that touch joined; ids not ``known`` are null."""
    order = np.lexsort((at, rid, id_, known))
    known, id_, rid, at = (x[order] for x in (known, id_, rid, at))
    new = np.ones(len(at), bool)
    new[1:] = (known[1:] != known[:-1]) | (id_[1:] != id_[:-1]) | (rid[1:] != rid[:-1]) | (at[1:] > at[:-1] + length)
    starts = np.flatnonzero(new)
    ends = np.concatenate([starts[1:], [len(at)]])[: len(starts)] - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(id_[starts], mask=~known[starts]), pa.array(rid[starts]), pa.array(at[starts]), pa.array(at[ends] + length)],
        names=["id", "rid", "start", "end"],
    )


def _merged(length: int):
    """Repeated windows of whole groups (rows come ordered by key)."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        group = repeats([r[4] for r in rows], length)
        first = np.concatenate([[0], np.cumsum([len(r[4]) + 1 for r in rows])])
        spots = np.flatnonzero(group)
        owner = np.searchsorted(first, spots, side="right") - 1
        known = np.array([r[1] is not None for r in rows])[owner]
        id_ = np.array([r[1] or 0 for r in rows], np.int64)[owner]
        rid = np.array([r[2] for r in rows], np.int64)[owner]
        at = np.array([r[3] >> 16 for r in rows], np.int64)[owner] + spots - first[owner]
        group = group[spots]
        order = np.lexsort((at, rid, id_, known, group))
        known, id_, rid, at, group = (x[order] for x in (known, id_, rid, at, group))
        head = np.searchsorted(group, group)  # the earliest of each group
        later = (known != known[head]) | (id_ != id_[head]) | (rid != rid[head]) | (at != at[head])
        return _runs(*(x[later] for x in (known, id_, rid, at)), length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for part in textkit.slices(batches, "bytes", MERGE_BYTES):
            for row in zip(*(part.column(c).to_pylist() for c in ("key", "id", "rid", "at", "bytes")), strict=True):
                if size > MERGE_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[4])
        if held:
            yield solve(held)

    return run


def _removed(keep_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "rid", "spans", "kept"]
        span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
        types = [pa.int64()] * 4 + [pa.string(), pa.int64(), pa.list_(span), pa.string()]
        for part in textkit.slices(batches, "text", 4 << 20):
            out: list[tuple] = []
            for text, id_, rid, spans in zip(*(part.column(c).to_pylist() for c in ("text", "id", "rid", "spans")), strict=True):
                raw = (text or "").encode()
                joined: list[list[int]] = []
                for s in sorted(spans or [], key=lambda s: s["start"]):
                    if joined and s["start"] <= joined[-1][1]:
                        joined[-1][1] = max(joined[-1][1], s["end"])
                    else:
                        joined.append([s["start"], s["end"]])
                at, kept = 0, []
                for a, b in joined:
                    kept.append(raw[at:a])
                    at = b
                kept.append(raw[at:])
                rest = b"".join(kept)
                out.append(
                    (
                        id_, len(raw), len(raw) - len(rest), len(joined), hashlib.sha256(rest).hexdigest(), rid,
                        [{"start": a, "end": b} for a, b in joined], rest.decode(errors="ignore") if keep_text else None,
                    )
                )
            columns = list(zip(*out, strict=True)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return run


RESULT = (
    "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, rid long, "
    "spans array<struct<start: bigint, end: bigint>>, kept string"
)


def _with_rows(source: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``source`` with what was found in its rows; id and locator hash together tell rows apart."""
    found = found.withColumnRenamed("id", "_id").withColumnRenamed("rid", "_rid")
    return source.join(found, (source["rid"] == found["_rid"]) & source["id"].eqNullSafe(found["_id"]), how)


def remove_repeats(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    seed: int = SEED,
    group: int = GROUP,
    keep_text: bool = True,
) -> DataFrame:
    """One row per input row: ``id, n_bytes, n_removed, n_spans, kept_sha256, rid, spans, kept``.

    ``spans`` are the maximal removed byte runs and ``kept`` the rest (bytes of
    a character cut in two are left out there; the digest has all bytes). Null
    texts are empty. A null id comes before all others, and rows that share an
    id are ordered by their locator's hash. An empty table gives no rows; other
    columns aren't read.
    """
    if length - seed > 255:
        raise ValueError(f"length {length} and seed {seed} may differ by 255 at most")
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    source = located(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")), "repeat-docs").select(
        "id", "text", F.xxhash64("_file", "_row").alias("rid")
    )
    anchors = materialize(source.mapInArrow(_anchors(length, seed), ANCHOR), "anchors")
    repeated = materialize(anchors.groupBy("seed").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("seed"), "repeated-seeds")
    release(spark)
    hits = materialize(anchors.join(repeated, "seed"), "repeated-anchors")
    drop_tables(anchors, repeated)
    release(spark)
    place = F.struct("id", "rid", "at")

    def span(rows: DataFrame) -> DataFrame:
        start = F.shiftright("at", 16)
        more = F.shiftright("at", 8).bitwiseAND(255)
        return rows.select("id", "rid", start.alias("start"), (start + more + length).alias("end"))

    first = materialize(hits.groupBy("seed", "snippet").agg(F.min(place).alias("first")), "first-snippets")
    later = hits.join(first, ["seed", "snippet"]).filter(F.col("first") != place)
    found = [materialize(span(later), "repeat-spans")]
    varied = first.groupBy("seed").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    wanted = (
        first.join(varied, "seed", "left_semi")
        .select("seed", "first.*")
        .groupBy("id", "rid")
        .agg(F.collect_list(F.struct("seed", "at")).alias("wanted"))  # bounded by the document
    )
    width = -(-(length - seed + 1) // 2)
    parts = materialize(
        _with_rows(source, wanted, "inner").select("text", "id", "rid", "wanted").mapInArrow(_cut(length, width), SNIPPET), "snippets"
    )
    drop_tables(hits, first)
    release(spark)
    while True:
        kinds = materialize(parts.groupBy("key", "snippet").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("c")), "kinds")
        cores = kinds.groupBy("key").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("k")).filter("n > 1").drop("n")
        decided = materialize(kinds.join(cores, "key"), "cores")
        placed = parts.join(decided, ["key", "snippet"]).withColumn("own", F.col("first") == place)
        old = (parts, kinds, decided)
        placed = materialize(placed.filter("not own or k > 1").select("key", "id", "rid", "at", "k", "own", F.when(F.col("own"), F.col("bytes")).alias("bytes")), "placed")
        drop_tables(*old)
        found.append(span(placed.filter("not own")))
        few = placed.filter((F.col("k") <= group) & F.col("own")).repartition("key").sortWithinPartitions("key", "id", "rid", "at")
        found.append(
            materialize(
                few.select("key", "id", "rid", "at", "bytes").mapInArrow(_merged(length), "id long, rid long, start long, end long"),
                "merged-spans",
            )
        )
        many = placed.filter((F.col("k") > group) & F.col("own"))
        if width == 1 or many.isEmpty():
            break
        width = -(-width // 2)
        parts = materialize(many.mapInArrow(_split(length, width), SNIPPET), "snippets")
    spans = found[0]
    for more in found[1:]:
        spans = spans.union(more)
    release(spark)
    per_doc = spans.groupBy("id", "rid").agg(F.collect_set(F.struct("start", "end")).alias("spans"))  # bounded by the document
    return (
        _with_rows(source, per_doc, "left").select("text", "id", "rid", "spans").mapInArrow(_removed(keep_text), RESULT)
    )


def query(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs, keep_text=False).select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
