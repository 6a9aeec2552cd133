"""Spelling variants, hard negatives and decontamination against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vigil.llm import decontaminate, negatives, spelling


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


# spelling variants


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(rows):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    told = {}
    for w in n:
        others = sorted((v for v in n if near(w, v)), key=lambda v: (-n[v], v))
        form = others[0] if others and n[others[0]] >= 2 * n[w] else None
        told[w] = [form, w, n[w], len(others), n[form] if form else None]
    for row in told.values():
        while told[row[1]][0]:
            row[1] = told[row[1]][0]
    return sorted((w, *r) for w, r in told.items())


def a_text(rng, words):
    return " ".join("".join(rng.choices("eeaaÉT", k=rng.choice([5, 5, 5, 6, 6, 7]))) + rng.choice(["", ",", "1", "-"]) for _ in range(words))


@pytest.mark.parametrize("sizes", [{}, {"node_words": 15, "chunk_words": 40}])
def test_spelling_matches_brute_force(spark, sizes):
    rng = random.Random(4)
    rows = [(i if i % 9 else None, a_text(rng, 150) if i % 7 else None) for i in range(80)]
    rows += [(3, "x" * 5000 + " " + "x" * 5001), (3, "x" * 5000 + " y" + "x" * 5000), (4, "x" * 5000 + "Ā" + "x" * 5001), (5, ""), (6, "÷×÷×÷ ÷×÷×÷ ÷×÷×÷")]
    rows += rows[:10]
    docs = spark.createDataFrame([(i, t, "n", "w") for i, t in rows], "doc_id long, text string, n string, word string")
    got = spelling.spelling_variants(docs, **sizes)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = spelled(rows)
    assert len(want) > 300 and any(r[2] not in (r[0], r[1]) and r[1] for r in want)
    assert sorted(map(tuple, got.collect())) == want


def test_spelling_search_takes_small_leaves(spark):
    """The trie is walked to the last level when leaves are one pair."""
    rng = np.random.default_rng(2)
    words = sorted({"".join(rng.choice(list("eanr"), 6)) for _ in range(300)})
    five = sorted({w[:5] for w in words})
    n = {w: int(rng.integers(3, 9)) for w in [*words, *five]}
    stored = pa.table({"word": words, "n": pa.array([n[w] for w in words], pa.int64())})
    probes = pa.table({"word": [*words, *five]})
    want = {}
    for w in [*words, *five]:
        others = sorted((v for v in words if near(w, v)), key=lambda v: (-n[v], v))
        if others:
            want[w] = (len(others), n[others[0]], others[0])
    for leaf in (1, 1 << 12):
        got = spelling.search(stored, probes, leaf).to_pylist()
        assert {r["word"]: (r["near"], r["best_n"], r["best"]) for r in got} == want


def test_spelling_of_nothing(spark, no_docs):
    assert spelling.spelling_variants(no_docs).count() == 0
    assert spelling.spelling_variants(spark.createDataFrame([(1, "one two")], "doc_id long, text string")).count() == 0


# hard negatives


def mined(rows):
    rows = [(i, str(l), [math.floor(256 * x) for x in v]) for i, l, v in rows if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    rows = [r for r in rows if sum(x * x for x in r[2]) <= 2**62]
    anchors = {}
    for i, l, v in sorted(rows):
        if i % 4 == 0:
            anchors.setdefault(i, (l, v))
    out = []
    for a, (label, q) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(q, v, strict=True)), i, l) for i, l, v in rows if len(v) == len(q))
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:5]:
            inside = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:10]
            out += [(a, p, k, i, -s, -t) for k, (t, i, _) in enumerate(inside, 1)]
    return sorted(out)


def vectors(seed=0, n=150, dim=6):
    rng = np.random.default_rng(seed)
    rows = [(i, int(rng.integers(3)), (rng.integers(-3, 5, dim) / 4).tolist()) for i in range(n)]
    rows += [(200, None, [1.0] * dim), (201, 1, None), (None, 1, [1.0] * dim), (202, 1, [None] + [1.0] * (dim - 1)), (203, 1, [math.nan] * dim), (204, 1, [math.inf] * dim)]
    rows += [(208, 1, [0.0] * dim), (209, 1, []), (212, 2, []), (213, 2, []), (216, 0, [2.0, 1.0]), (217, 0, [1.0, 1.0]), (218, 1, [1.0, 0.5]), (219, 1, [1e30, 1.0])]
    rows += [(220, 0, [1e5] * dim), (221, 0, [1e5] * dim), (222, 1, [6e4] * dim), (224, 2, [3e6] * dim), (225, 2, [3e6] * dim), (226, 1, [2e6] * dim)]
    return rows + rows[:20] + [(4, 2, [1.0] * dim), (5, 2, [1.0] * dim)]


@pytest.mark.parametrize("block", [1 << 23, 800])
def test_negatives_match_brute_force(spark, block):
    rows = vectors()
    frame = spark.createDataFrame([(i, l, v, "k", 1) for i, l, v in rows], "vec_id long, label int, embedding array<double>, key string, anchor int")
    got = negatives.hard_negatives(frame.repartition(5), F.col("vec_id") % 4 == 0, block_bytes=block)
    want = mined(rows)
    assert len(want) > 500
    assert sorted(map(tuple, got.collect())) == want


def test_negatives_with_hot_copies(spark):
    """A third of the rows is one vector: ties go to the smaller id."""
    rows = [(i, i % 2, [1.0, 0.5]) for i in range(0, 3000, 3)] + [(i, i % 3, [1.0, (i % 7) / 10]) for i in range(3000) if i % 3]
    got = negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), F.col("vec_id") % 500 == 0)
    rows = [(i, l, np.float32(v).tolist()) for i, l, v in rows]
    assert sorted(map(tuple, got.collect())) == [r for r in mined(rows) if r[0] % 500 == 0]


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert negatives.query(none).count() == 0
    assert negatives.query(none).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    alone = spark.createDataFrame([(100, 1, [1.0]), (101, 2, [0.5])], "vec_id long, label int, embedding array<float>")
    assert negatives.query(alone).count() == 0


def test_packed_keys_sort_as_numbers():
    rng = np.random.default_rng(1)
    a, s, i = rng.integers(-5, 5, 500), rng.integers(-(2**62), 2**62, 500), rng.integers(-(2**40), 2**40, 500)
    s[:200] = rng.integers(-2, 3, 200)
    keys = negatives.pack(a, s, 1, i).to_pylist()
    assert [negatives.unpack(k) for k in keys] == list(zip(a.tolist(), s.tolist(), [1] * 500, i.tolist(), strict=True))
    assert [negatives.unpack(k)[:2] + (negatives.unpack(k)[3],) for k in sorted(keys)] == sorted(zip(a.tolist(), s.tolist(), i.tolist(), strict=True), key=lambda x: (x[0], -x[1], x[2]))


def test_window_bounds():
    for p in range(-40, 40):
        low, high = negatives.bounds(p, 30, 90)
        assert [s for s in range(-60, 60) if 30 * p <= 100 * s <= 90 * p] == list(range(low, high + 1))


# decontamination

ITEM_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def judged(docs, items, window=10):
    found = []
    for i, text in items:
        w = re.findall(ITEM_WORD, lower(text))
        k = min(window, len(w))
        found += [(i, w[p : p + k]) for p in range(len(w) - k + 1) if k]
    out = []
    for d, text in docs:
        w = re.findall(ITEM_WORD, lower(text))
        hit, ids = set(), set()
        for i, t in found:
            for p in range(len(w) - len(t) + 1):
                if w[p : p + len(t)] == t:
                    hit.update(range(p, p + len(t)))
                    ids.add(i)
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((-1 if d is None else d, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def passages(seed, short=True):
    rng = random.Random(seed)
    sentence = lambda n: " ".join(rng.choice(["a", "Be", "é", "d2"]) for _ in range(n))
    items = [(i, sentence(rng.choice([12, 14, 30]))) for i in range(12)] + [(7, sentence(13)), (None, sentence(15)), (20, None), (21, ""), (22, " .,")]
    items += [(30, items[0][1]), (31, items[0][1] + " more")]
    if short:
        items += [(23, "zq zq a"), (24, "solo"), (25, "be be be be be d2")]
    docs = [(i, sentence(rng.choice([0, 3, 9, 60, 200]))) for i in range(30)]
    docs += [(40 + i, f"{sentence(4)}; {t}!{sentence(2)}") for i, t in items if t and i is not None]
    docs += [(90, None), (91, ""), (92, "..."), (93, "a zq Zq-A solo"), (94, "one Solo"), (95, "solos"), (None, "solo"), (96, sentence(30_000)), (90, "solo")]
    return docs, items


@pytest.mark.parametrize("size", [1 << 22, 200])
@pytest.mark.parametrize("short", [True, False])
def test_decontamination_matches_brute_force(spark, size, short):
    docs, items = passages(int(short), short)
    frame = spark.createDataFrame([(i, t, "s", 1) for i, t in docs], "doc_id long, text string, `spans: a, b` string, _row int")
    tests = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, n_words int")
    got = decontaminate.scan(frame, tests, automaton_bytes=size).select(
        "_doc.doc_id", "n_words", decontaminate.n_hit(), F.size("items"), F.sha2(F.concat_ws(",", "items"), 256), F.size("spans") > 0
    )
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in got.collect()) == judged(docs, items)
    thin = decontaminate.query(frame.select("doc_id", "text"), tests.select("item_id", "text"))
    assert sorted((-1 if r[0] is None else r[0], *r[1:]) for r in thin.collect()) == judged(docs, items)


def test_spans_are_removed_and_covered_documents_go(spark):
    passage = "the Quick brown fox jumps over 1 lazy dog again, and again"
    docs = spark.createDataFrame(
        [(1, f"Before it all, as we know here: {passage} - after it some more words follow", "x"), (2, passage, "y"), (3, "clean text", None), (4, None, "z")],
        "doc_id long, text string, source string",
    )
    items = spark.createDataFrame([("q", passage)], "item_id string, text string")
    kept = decontaminate.keep_rows(docs, items)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [(1, "Before it all, as we know here:  - after it some more words follow", "x"), (3, "clean text", None), (4, None, "z")]


def test_decontamination_of_nothing(spark, no_docs, docs):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert decontaminate.query(no_docs, items).count() == 0
    none = decontaminate.query(docs, items.limit(0))
    assert none.count() == docs.count() and none.filter("contaminated or n_hit > 0 or n_items > 0").count() == 0


def test_automaton_tracks_longest_matches():
    """Every state of a random automaton ends where its words end in some item."""
    rng = random.Random(8)
    items = [(str(i), [rng.choice([b"x", b"y"]) for _ in range(rng.randint(1, 12))]) for i in range(20)]
    automaton = decontaminate.Automaton(items, 4)
    text = [rng.choice([b"x", b"y", b"x", b"z"]) for _ in range(400)]
    want = set()
    for i, ws in items:
        k = min(4, len(ws))
        for p in range(len(ws) - k + 1):
            want |= {(n, n + k, i) for n in range(len(text) - k + 1) if text[n : n + k] == ws[p : p + k]}
    assert {(a, b, i) for a, b, those in automaton.matches(text) for i in those} == want
