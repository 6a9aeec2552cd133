"""The pipeline end to end, the classifier and the secret scan against plain re-computations."""

from __future__ import annotations

import bisect
import collections
import hashlib
import math
import random
import re

import corpus_pipeline
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq

from vigil.llm import bwt, quality, secret_scan

from .conftest import DOCUMENT, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# ---- pipeline


def corpus():
    """Graded documents with exact and near copies, awkward rows and clashing columns."""
    rows, labels = [], []
    for i in range(240):
        words = prose(5000 + i, 60).split() + ["the", "and", "of"]
        grade = 2 if i % 4 else i // 4 % 2
        if grade == 0:
            words[3::7] = ["vile"] * len(words[3::7])
        if grade == 1:
            words = [w + "%%%" if j % 2 else w for j, w in enumerate(words)]
        rows.append((i, " ".join(words), "abc"[i % 3] if i % 5 else None))
        labels.append((i, int(grade == 2), int(grade == 0)))
    good = [r for r in rows if r[0] % 4]
    for k, (i, text, source) in enumerate(good[:40]):
        words = text.split()
        words[30] = "changed"
        rows.append((1000 + i, text.upper() if k % 2 else text, source))  # exact copies
        rows.append((2000 + i, " ".join(words), "a"))  # near copies
    rows += [good[7], (None, good[8][1], "b"), (3000, None, "a"), (3001, "", None), (3002, "one two", "c"), (3003, " \n", "c")]
    rows.append((3004, " ".join(prose(9000, 4000).split() + ["the"]), "a"))
    return [(i, t, "en", s, None if t is None else len(t), "clash", "f", 7) for i, t, s in rows], labels


def write(folder, rows, labels):
    names = [c.split()[0] for c in DOCUMENT.split(", ")]
    types = [pa.int64() if c.split()[1] == "long" else pa.int32() if c.split()[1] == "int" else pa.string() for c in DOCUMENT.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[]] * len(names)
    pq.write_table(pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names), folder / "documents.parquet")
    columns = list(zip(*labels, strict=True)) or [[]] * 3
    marks = pa.table([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "quality", "toxic"])
    pq.write_table(marks, folder / "labels.parquet")


def exact(rows):
    """Of rows with equal texts one with the largest id, nulls below all."""
    best = {}
    for i, text, source in rows:
        at = lower(text)
        if at not in best or (i is not None and (best[at][0] is None or i > best[at][0])):
            best[at] = (i, text, source)
    return list(best.values())


def near(rows, percent=80):
    """Of each component of similar texts the row with the smallest id."""
    sets = []
    for _, text, _ in rows:
        words = WORD.findall(lower(text))
        sets.append({tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and both * 100 >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    best = {}
    for k, row in enumerate(rows):
        order = (row[0] is None, row[0] or 0)
        if find(k) not in best or order < best[find(k)][0]:
            best[find(k)] = (order, row)
    return [row for _, row in best.values()]


def targets(sizes):
    """Words wanted of each source: weights 5, 2, 1 in turn share 150 %, none above twice its size."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, out, free = 1.5 * sum(sizes.values()), {}, set(names)
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out


def test_pipeline_against_brute_force(spark, tmp_path):
    rows, labels = corpus()
    write(tmp_path, rows, labels)
    got = corpus_pipeline.run(spark, str(tmp_path)).toPandas()

    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    accepted = corpus_pipeline.quality_classifier(spark, docs, str(tmp_path))
    assert accepted.columns == docs.columns
    kept = [(r.doc_id, r.text, r.source) for r in accepted.collect()]
    clean = {i for i, q, _ in labels if q == 1}
    assert len(clean & {k[0] for k in kept}) > 0.95 * len(clean) and len({k[0] for k in kept} & {i for i, q, _ in labels if q == 0}) < 6
    left = near(exact(kept))
    assert len(left) < len(kept)

    tokens = {-1 if i is None else i: None for i, *_ in left}
    sizes = collections.Counter()
    for _, text, source in left:
        sizes[source] += len(WORD.findall(text or ""))
    want = targets(sizes)
    got["doc_id"] = got.doc_id.fillna(-1).astype(int)
    assert set(got.doc_id) <= set(tokens)
    times = {i: g.length.sum() / g.doc_tokens.iloc[0] for i, g in got.groupby("doc_id")}
    taken, hashes, largest = collections.Counter(), collections.defaultdict(list), collections.Counter()
    for i, text, source in left:
        n, size = times.get(-1 if i is None else i, 0), len(WORD.findall(text or ""))
        assert n in (0, 1, 2)
        taken[source] += n * size
        largest[source] = max(largest[source], size)
        hashes[source].append((int(hashlib.md5(str("" if i is None else i).encode()).hexdigest()[:15], 16), n))
    for source, wanted in want.items():
        assert abs(taken[source] - wanted) <= largest[source], source
        order = [n for _, n in sorted(hashes[source])]
        assert order == sorted(order, reverse=True)  # one threshold on the hash
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all()
        assert g.length.sum() == 2048 or g.length.sum() & (g.length.sum() - 1) == 0


def test_pipeline_of_nothing(spark, tmp_path):
    write(tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


# ---- classifier


def plain_features(text):
    """Feature keys and counts of one text, word by word."""
    out, before = collections.Counter(), None
    core = lambda b: 48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128
    for m in WORD.finditer(text):
        raw = m[0].encode()
        spots = [k for k, b in enumerate(raw) if core(b)]
        first, last = (spots[0], spots[-1] + 1) if spots else (0, len(raw))
        word = raw[first:last]
        out["word", lower(word.decode())] += 1
        if last < len(raw):
            out["tail", raw[last:]] += 1
        if len(word) >= 2 and all(65 <= b <= 90 for b in word):
            out["shout", b""] += 1
        if before == lower(word.decode()):
            out["again", b""] += 1
        before = lower(word.decode())
    return out


def test_features_against_word_by_word_counts():
    texts = ["Vile, vile THING! ok ok ok...", "", "*** --- a", "É é x1% \t\n WOW WOW", "(brackets) A BB-CC 'q' q"]
    bounds = np.concatenate([[0], np.cumsum([len(t.encode()) for t in texts])])
    rows, places, values = quality.features(np.frombuffer("".join(texts).encode(), np.uint8), bounds)
    for k, text in enumerate(texts):
        want = sorted(math.log1p(c) for c in plain_features(text).values())
        assert np.allclose(np.sort(values[rows == k]), want)
        assert len(set(places[rows == k].tolist())) == len(want)


def test_fit_reaches_the_likelihood_of_a_numeric_optimum():
    """Against steepest descent on numeric derivatives of the cumulative-link likelihood."""
    rng = np.random.default_rng(4)
    rows = []
    for _ in range(400):
        places = np.flatnonzero(rng.random(3) < 0.6)
        lean = float(np.isin(0, places)) * -1.5 + float(np.isin(1, places)) * 1.5
        grade = int(np.clip(np.round(1 + lean * 0.6 + rng.normal(0, 0.8)), 0, 2))
        rows.append((places, np.ones(len(places)), grade))
    model = quality.fit_ordinal(rows, 3, epochs=120)
    x = np.zeros((len(rows), 3))
    for k, (places, values, _) in enumerate(rows):
        weighed = values * model.rarity[places]
        x[k, places] = weighed / max(math.sqrt(float((weighed**2).sum())), 1e-9)
    y = np.array([g for *_, g in rows])

    def loss(p):
        score, t = x @ p[:3], (p[3], p[3] + math.exp(p[4]))
        upto = [1 / (1 + np.exp(score - b)) for b in t]
        chance = np.choose(y, [upto[0], upto[1] - upto[0], 1 - upto[1]])
        return -np.log(np.maximum(chance, 1e-12)).mean()

    p = np.zeros(5)
    for _ in range(3000):
        p -= 0.5 * np.array([(loss(p + d) - loss(p - d)) / 2e-5 for d in np.eye(5) * 1e-5])
    t = model.thresholds
    fitted = np.array([*model.weights[:3], t[0], math.log(t[1] - t[0])])
    assert loss(p) - 1e-6 <= loss(fitted) < loss(p) + 0.01


# ---- secret scan


def plain_base(text):
    """Base spans by walking the text, without patterns."""
    hexes, caps = set("0123456789abcdef"), set("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
    value = caps | set("abcdefghijklmnopqrstuvwxyz+/_.=-")
    out, low = [], lower(text)
    at = 0
    while at < len(text):
        name = next((w for w in ("password", "passwd", "secret", "token", "api_key", "apikey") if low.startswith(w, at)), None)
        if not name:
            at += 1
            continue
        k = at + len(name)
        k += text[k : k + 1] in ('"', "'") and k < len(text)
        while text[k : k + 1] == " ":
            k += 1
        if text[k : k + 1] not in (":", "="):
            at += 1
            continue
        k += 1
        while text[k : k + 1] == " ":
            k += 1
        k += text[k : k + 1] in ('"', "'") and k < len(text)
        end = k
        while end < len(text) and text[end] in value:
            end += 1
        if end == k:
            at += 1
            continue
        if end - k >= 8:
            out.append((at, 0, end))
        at = end
    for kind, head, letters, least in ((1, "AKIA", caps, 16), (2, "", hexes, 32)):
        at = 0
        while at < len(text):
            end = at + len(head)
            if not text.startswith(head, at):
                at += 1
                continue
            while end < len(text) and text[end] in letters:
                end += 1
            if end == at + len(head):
                at += 1
                continue
            if end - at >= least:
                out.append((at, kind, end))
            at = end
    return sorted(out)


def test_base_spans_against_a_walk():
    rng = random.Random(6)
    bits = ["password", "Passwd", "SECRET", "token", "api_key", "apikey", "'", '"', " ", "  ", ":", "=", "==", "AKIA", "AKI", "ABCDEF0123456789",
            "0123456789abcdef", "deadbeef", "xyz", ".", "é", "\n", "Q7-_", "A" * 12, "f" * 20]
    found = 0
    for _ in range(8000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        assert secret_scan.base_spans(text) == plain_base(text), text
        found += len(plain_base(text))
    assert found > 1000


def plain_battery(token):
    """Combined p of the three tests of one token, symbol by symbol."""
    alphabet = next(a for a in secret_scan.ALPHABETS if set(token) <= set(a))
    n, size = len(token), len(alphabet)
    ranks = [alphabet.index(c) for c in token]
    share = collections.Counter(r * 8 // size for r in range(size))
    seen = collections.Counter(r * 8 // size for r in ranks)
    chi = sum((seen[b] - n * share[b] / size) ** 2 / (n * share[b] / size) for b in range(8))
    tail = lambda z: math.erfc(z / math.sqrt(2))
    p_chi = tail(((chi / 7) ** (1 / 3) - (1 - 2 / 63)) / math.sqrt(2 / 63)) / 2
    u = [(r + 0.5) / size for r in ranks]
    high = [x >= 0.5 for x in u]
    n1, n2 = sum(high), n - sum(high)
    if n1 and n2:
        mean = 2 * n1 * n2 / n + 1
        spread = math.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-9))
        p_runs = tail(abs(1 + sum(a != b for a, b in zip(high, high[1:], strict=False)) - mean) / spread)
    else:
        p_runs = 1e-12
    middle = sum(u) / n
    total = sum((x - middle) ** 2 for x in u)
    r = sum((a - middle) * (b - middle) for a, b in zip(u, u[1:], strict=False)) / max(total, 1e-12)
    p_serial = 1e-12 if total < 1e-12 else tail(abs(r) * math.sqrt(n))
    x = -sum(math.log(max(p, 1e-30)) for p in (p_chi, p_runs, p_serial))
    return math.exp(-x) * (1 + x + x * x / 2)  # Fisher's chi-squared tail with six degrees


def test_battery_against_symbol_by_symbol():
    rng = random.Random(7)
    tokens = ["".join(rng.choices(a, k=rng.randint(20, 140))) for a in secret_scan.ALPHABETS for _ in range(6)]
    tokens += ["a" * 20, "ab" * 20, "0" * 64, "correcthorsebatterystaple", "Z" * 19 + "a"]
    _, p = secret_scan.battery(tokens)
    assert np.allclose(p, [plain_battery(t) for t in tokens], rtol=1e-7, atol=1e-300)


def test_discoveries_against_a_step_up_over_single_tokens(spark):
    """Benjamini-Hochberg token by token; p is a token's rank among the ordinary pieces."""
    rng = random.Random(8)
    tokens = [(rng.choice((0, 1, 2)), min(200, int(rng.expovariate(1 / 40))), rng.random() < 0.3) for _ in range(400)]
    ordinary = [(k, rng.randint(0, 200), rng.randint(1, 400)) for k in (0, 1, 2) for _ in range(60)]
    got = secret_scan.discovery_levels(
        spark.createDataFrame(tokens, "length_class int, level int, word boolean"),
        spark.createDataFrame(ordinary, "length_class int, level int, n long"),
        0.2,
    )
    text = secret_scan.ORDINARY.replace(" ", "")
    for k in range(3):
        size = secret_scan.CLASSES[k]
        pieces = [text[i : i + size] for i in range(len(text) - size + 1)]
        null = sorted(min(200, math.floor(-10 * math.log10(max(plain_battery(t), 1e-25)))) for t in pieces)
        null = sorted(null + [level for c, level, n in ordinary if c == k for _ in range(n)])
        for word in (False, True):
            own = sorted(level for c, level, w in tokens if c == k and w == word)
            p = [(1 + bisect.bisect_right(null, level)) / (1 + len(null)) for level in own]
            good = [level for i, (level, x) in enumerate(zip(own, p, strict=True), 1) if x * len(own) <= 0.2 * i]
            assert got[2 * k + word] == max(good, default=-1)


def test_walked_spans_of_a_table(spark, docs):
    got = {(r.doc_id, r.base_sha256) for r in secret_scan.query(docs).select("doc_id", "base_sha256").collect()}
    names = secret_scan.KINDS
    want = set()
    for r in docs.select("doc_id", "text").collect():
        joined = ",".join(f"{names[k]}:{s}:{e}" for s, k, e in plain_base(r.text or ""))
        want.add((r.doc_id, hashlib.sha256(joined.encode()).hexdigest()))
    assert got == want


# ---- repeats


def test_repeated_prefixes_of_random_strings(monkeypatch):
    """Every suffix of strings of few letters that borrow from each other, over shards of any size."""
    rng = random.Random(3)
    for _ in range(150):
        letters = rng.choice([b"a", b"ab", b"abcd\0", bytes(range(256))])
        strings: list[bytes] = []
        for _ in range(rng.randint(1, 12)):
            new = bytes(rng.choices(letters, k=rng.randint(0, 60)))
            if strings and rng.random() < 0.6:
                old = rng.choice(strings)
                new = old[rng.randint(0, len(old)) :] + new
            strings.append(new)
        depth = rng.choice([1, 2, 3, 7, 16, 20])
        monkeypatch.setattr(bwt, "SHARD_BYTES", rng.choice([10, 30, 100]))
        got = bwt.repeats(strings, depth).tolist()
        heads = [s[i : i + depth] if i + depth <= len(s) else None for s in strings for i in range(len(s) + 1)]
        counts = collections.Counter(h for h in heads if h is not None)
        assert [g > 0 for g in got] == [h is not None and counts[h] > 1 for h in heads]
        assert len({(g, h) for g, h in zip(got, heads, strict=True) if g}) == len({g for g in got if g}) == sum(c > 1 for c in counts.values())


def test_seeds_of_joined_texts_are_least_hashes():
    rng = random.Random(5)
    texts = [bytes(rng.choices(b"ab", k=rng.randint(0, 40))) for _ in range(200)]
    data = np.frombuffer(b"".join(texts), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    hashes = bwt.rolling(data, 4) >> np.uint64(32)
    want: list[list[int]] = []
    for i, text in enumerate(texts):
        for p in range(bounds[i], bounds[i] + len(text) - 8):
            seed = min(range(p, p + 6), key=lambda q: (int(hashes[q]), q))
            if want and want[-1][:2] == [i, seed]:
                want[-1][3] = p
            else:
                want.append([i, seed, p, p])
    assert [[int(x) for x in r] for r in zip(*bwt.seed_spans(data, bounds, 9, 4), strict=True)] == want
