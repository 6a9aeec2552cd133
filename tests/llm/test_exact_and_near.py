"""Exact, near and substring deduplication against brute force."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vigil.llm import bwt, exact_dedup, graph, minhash, textkit

from .conftest import prose


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_exact_groups(docs):
    got = exact_dedup.exact_dedup(docs).toPandas()
    rows = docs.toPandas()
    assert len(got) == len(rows)
    groups = {}
    for i, t in zip(rows.doc_id, rows.text, strict=True):
        groups.setdefault(lower(t), []).append(-1 if i != i else int(i))
    want = sorted((i, max(g), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g)
    have = sorted(
        (-1 if r.id != r.id else int(r.id), -1 if r.keep_id != r.keep_id else int(r.keep_id), r.group_size, bytes(r.digest).hex())
        for r in got.itertuples()
    )
    assert have == want
    # one row of each group stays, also among rows repeated whole
    assert got.kept.sum() == len(groups)


def test_exact_full_bytes_beat_digest_clashes(docs):
    """With a digest of two values the byte check still keeps different texts apart."""
    got = exact_dedup.exact_dedup(docs, digest=lambda t: F.unhex(F.lpad((F.length(t) % 2).cast("string"), 2, "0")))
    assert got.filter("kept").count() == exact_dedup.exact_dedup(docs).filter("kept").count()


def test_exact_keeps_columns_and_empty_tables(docs, no_docs):
    kept = exact_dedup.keep_rows(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.select(F.lower(F.coalesce("text", F.lit("")))).distinct().count()
    assert exact_dedup.exact_dedup(no_docs).count() == 0


def shingles(text, size=5):
    words = [w for w in lower(text).replace("\r", " ").replace("\n", " ").replace("\t", " ").split(" ") if w]
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def test_shingle_sets(docs):
    texts = [r.text for r in docs.select("text").collect()]
    import pyarrow as pa

    sets = textkit.shingles(*textkit.text_bytes(pa.array(texts)), 5)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]


def test_near_components(spark):
    """Chains, a big bucket of variants, and pairs just around the threshold, against brute force."""
    base = prose(5, 200).split()
    rows = []
    for i in range(60):
        words = list(base)
        for j in range(i % 9):
            words[(17 * i + 23 * j) % 200] = f"edit{i}x{j}"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, prose(50 + i, 30)) for i in range(20)] + [(200, None), (201, ""), (202, "a b"), (203, "A  b"), (204, " ".join(base))]
    got = {r.id: r for r in minhash.near_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert {i: r.component_id for i, r in got.items()} == {i: root(i) for i in sets}
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (i == r.component_id) for i, r in got.items())


def test_near_awkward_rows(docs, no_docs):
    got = minhash.near_dedup(docs)
    assert got.count() == docs.count()
    kept = minhash.keep_rows(docs)
    assert kept.columns == docs.columns
    assert sorted(r[0] for r in kept.filter("doc_id in (0, 4, 5, 6, 8, 10)").select("doc_id").collect()) == [0, 4, 10]
    assert minhash.near_dedup(no_docs).count() == 0


def test_pairs_at_082_are_near_but_not_to_the_query(spark):
    """40 pairs with 163 of 198 shingles in common: linked from 0.8, op3's own threshold is 0.85."""
    rows = []
    for i in range(40):
        words = prose(300 + i, 190).split()
        other = list(words)
        for at in (20, 80, 140):
            other[at] = f"changed{at}"
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other + ["more", "of", "it", "here", "now"]))]
    ratios = [len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2], strict=True)]
    assert 0.81 < min(ratios) and max(ratios) < 0.84
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    import corpus_pipeline

    kept = corpus_pipeline.near_duplicates(spark, frame, "")
    assert sorted(r.doc_id for r in kept.collect()) == list(range(0, 80, 2))
    assert minhash.query(frame).filter("kept").count() == 80


def test_bands_miss_few_pairs_at_any_threshold():
    assert minhash.band_shape(0.85) == (6, 26) and minhash.band_shape(0.8) == (5, 31)
    for percent in range(50, 100):
        rows, bands = minhash.band_shape(percent / 100)
        assert (1 - (percent / 100) ** rows) ** bands <= minhash.MISS and rows * bands <= 156


def test_odd_sketch_estimates_similarity():
    rng = np.random.default_rng(0)
    for similarity in (0.8, 0.9, 0.97):
        common = rng.integers(0, 2**63, int(4000 * similarity), dtype=np.uint64)
        only = rng.integers(0, 2**63, 4000 - len(common), dtype=np.uint64)
        half = len(only) // 2
        sets = [np.concatenate([common, only[:half]]), np.concatenate([common, only[half:]])]
        samples = minhash.minhash(np.concatenate(sets), np.array([0, len(sets[0])]), minhash.ROWS * minhash.BANDS)
        a, b = minhash.odd_sketch(samples)
        m = sum(bin(int(x) & (2**64 - 1)).count("1") for x in a ^ b)
        estimate = 1 + minhash.SKETCH_BITS / (4 * minhash.ROWS * minhash.BANDS) * np.log(1 - 2 * m / minhash.SKETCH_BITS)
        assert abs(estimate - similarity) < 0.1


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = {r.v: r.root for r in graph.components(edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}


def brute_repeats(rows, length):
    seen, out = set(), {}
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        raw = (text or "").encode()
        cover = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            s = raw[p : p + length]
            if s in seen:
                cover[p : p + length] = True
            seen.add(s)
        kept = np.frombuffer(raw, np.uint8)[~cover].tobytes()
        out[i] = (len(raw), int(cover.sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [256, 1])
def test_repeats_against_brute_force(spark, group):
    """Shared passages, self-overlap and runs of one byte, merged or dealt out singly."""
    passage = prose(9, 60)
    rows = [(i, prose(20 + i, 30) + " " + passage[i * 7 :] + " " + prose(60 + i, 10)) for i in range(12)]
    rows += [(50, "ab" * 300), (51, "x" * 450), (52, None), (53, ""), (54, passage + passage), (55, "é" * 120), (None, passage)]
    got = bwt.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), group=group).collect()
    assert {r.id: (r.n_bytes, r.n_removed, r.kept_sha256) for r in got} == brute_repeats(rows, 100)
    assert all(r.n_spans == len(r.spans) for r in got)


def test_repeats_awkward_rows(docs, no_docs):
    assert bwt.remove_repeats(docs).count() == docs.count()
    assert bwt.remove_repeats(no_docs).count() == 0


def test_merged_interleave_gives_sorted_suffixes_and_prefixes():
    rng = np.random.default_rng(3)
    strings = [bytes(rng.integers(0, 2, rng.integers(1, 40)).astype(np.uint8)) for _ in range(9)]
    shards = [strings[:3], strings[3:7], strings[7:]]
    bwts, orders, suffixes = [], [], []
    for members in shards:
        parts = [np.frombuffer(s + b"\0", np.uint8).astype(np.uint16) + 1 for s in members]
        for p in parts:
            p[-1] = 0
        lengths = np.array([len(p) for p in parts])
        order, before = bwt.shard_bwt(np.concatenate(parts), np.repeat(np.cumsum(lengths) - 1, lengths), 12)
        own = [s[i:] for s in members for i in range(len(s) + 1)]
        suffixes.append([own[i] for i in order])
        bwts.append(before)
        orders.append(order)
    z, lcp = bwt.merge_bwts(bwts, [len(m) for m in shards], 12)
    taken = [0] * len(shards)
    merged = []
    for k in z:
        merged.append(suffixes[k][taken[k]])
        taken[k] += 1
    assert [m[:12] for m in merged] == sorted(m[:12] for m in merged)
    for p in range(1, len(merged)):
        a, b = merged[p - 1], merged[p]
        common = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert lcp[p] == min(common, 12)


def test_component_rounds_carry_fewer_edges(spark, monkeypatch):
    sizes = []
    own = graph.materialize

    def counted(df, name):
        kept = own(df, name)
        if name == "edges":
            sizes.append(kept.count())
        return kept

    monkeypatch.setattr(graph, "materialize", counted)
    clique = [(a, b) for a in range(40) for b in range(a)]
    chain = [(a, a + 1) for a in range(100, 160)]
    edges = spark.createDataFrame(clique + chain + [(7, 7), (500, 500), (None, 3)], "a long, b long")
    got = {r.v: r.root for r in graph.components(edges).collect()}
    assert got == {**{a: 0 for a in range(40)}, **{a: 100 for a in range(100, 161)}}
    assert len(sizes) == 2 and sum(sizes) < len(clique) + 2 * len(chain)


def test_a_block_returns_a_tree_of_components():
    import pyarrow as pa

    names = [bytes([i]) for i in range(60)]
    block = pa.table(
        {
            "out": [True] * 30 + [False] * 30,
            "root": pa.array(names, pa.binary()),
            "fp": pa.array(names, pa.binary()),
            "items": pa.array([[*range(100), 1000 + i] for i in range(60)], pa.list_(pa.int64())),
        }
    )
    found = minhash._compare(85)(block).to_pylist()
    assert len(found) == 59  # of 900 links
    parent = {n: n for n in names}

    def top(x):
        return x if parent[x] == x else top(parent[x])

    for r in found:
        parent[top(r["a"])] = top(r["b"])
    assert len({top(n) for n in names}) == 1
    far = block.set_column(3, "items", pa.array([[i] for i in range(60)], pa.list_(pa.int64())))
    assert minhash._compare(85)(far).num_rows == 0
