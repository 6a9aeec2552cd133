"""Packing, URL filter, chat format, embeddings, classifier, secrets, mixing."""

from __future__ import annotations

import hashlib
import itertools
import json
import math
import zlib

import numpy as np
import pytest

from vigil.llm import chat, itq, mixing, packing, quality, secret_scan, urls

from .conftest import prose


def test_hilbert_curve_steps_to_neighbours():
    grid = np.array(list(itertools.product(range(8), repeat=3)))
    keys = packing.hilbert_key(grid, 3)
    assert sorted(keys) == list(range(512))
    assert (np.abs(np.diff(grid[np.argsort(keys)], axis=0)).sum(axis=1) == 1).all()


def test_packing_holds_every_token_once(docs, no_docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    got = packing.pack(docs).toPandas()
    want = sorted(tuple(tokenizer.encode(r.text or "", add_special_tokens=False).ids) + (1,) for r in docs.collect())
    pieces = {}
    for r in got.sort_values(["sequence_id", "offset"]).itertuples():
        ids = np.frombuffer(r.ids, "<u4")
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        key = (-1 if r.id != r.id else int(r.id), r.doc_tokens)
        pieces.setdefault(key, []).append((r.start, tuple(ids)))
    # rows that repeat an id and text have their pieces twice
    rebuilt = []
    for (_, total), parts in pieces.items():
        parts.sort(key=lambda p: p[0])
        copies = sum(s == 0 for s, _ in parts)
        assert sum(len(i) for _, i in parts) == copies * total
        if copies == 1:
            rebuilt.append(tuple(itertools.chain.from_iterable(i for _, i in parts)))
        else:
            rebuilt += [i for s, i in parts if s == 0]
    assert sorted(rebuilt) == want
    for _, g in got.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert (g.offset.to_numpy() == np.concatenate([[0], np.cumsum(g.length)[:-1]])).all()
        n = g.length.sum()
        assert n == 2048 or n & (n - 1) == 0
    assert packing.pack(no_docs).count() == 0


def test_pieces_are_tokenised_as_whole_texts():
    from tokenizers import Tokenizer

    encoder = packing.Encoder(None, 1)
    texts = ["a b", " a", "a ", "  a  b ", "x\n y", "x \ny", "it's  'so'", "\u00a0 z", "", " ", "a\tb c", "<|endoftext|> b", "über Öl 12 ,. x"]
    assert isinstance(encoder.tokenizer, Tokenizer)
    for text, blob in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(blob, encoder.type).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids + [1]


PAGES = [
    (1, "https://www.example.com/en/a?x=1"), (2, "http://Sub.EXAMPLE.com/en/b#t"), (3, "https://other.com"), (4, "https://other.com/"),
    (5, "http://a.net/fr/x"), (6, "http://a.net/en/x"), (7, None), (8, "no scheme"), (9, "http://notexample.com/en/"), (10, "x://y://z/p"),
    (6, "http://a.net/en/x"),
]


def test_url_rules(spark):
    frame = spark.createDataFrame([(*p, "c") for p in PAGES], "page_id long, url string, label string")
    got = {r.id: r for r in urls.judge_urls(frame).collect()}
    assert [got[i].rule for i in range(1, 11)] == [
        "www.example.com/en/", "example.com/en/", None, "com/", "net/fr/", None, None, None, "com/", None
    ]
    assert (got[2].host, got[2].path) == ("sub.example.com", "/en/b")
    assert (got[7].host, got[7].path, got[8].host) == ("", "", "")
    assert (got[10].host, got[10].path) == ("y:", "//z/p")
    assert {r.verdict for r in got.values()} <= {"allow", "block"}
    assert urls.judge_urls(frame.limit(0)).count() == 0
    only = urls.judge_urls(frame.filter("page_id in (4, 6)"))
    assert {r.verdict for r in only.collect()} == {"allow"}


def test_url_ratio_against_brute_force(spark):
    """Witten-Bell interpolation recomputed with dictionaries."""
    rows = [(i, f"http://good{i % 7}.com/news/{i}") for i in range(60)] + [(100 + i, f"http://bad{i % 5}.net/fr/spam{i}") for i in range(60)]
    rows += [(300, "http://good9.org/news/5"), (301, "http://bad8.org/fr/spam3")]
    frame = spark.createDataFrame(rows, "page_id long, url string")
    got = {r.id: r for r in urls.judge_urls(frame).collect()}
    held = {r.id for r in got.values() if r.rule and r.score is not None}
    counts = [{}, {}]
    chars = {i: urls.START * 4 + (got[i].host + got[i].path).lower() + urls.END for i, _ in rows}
    for i, _ in rows:
        if got[i].rule and i not in held:
            for at in range(len(chars[i]) - 4):
                for m in range(5):
                    g = chars[i][at + 4 - m : at + 5]
                    c = counts[0 if got[i].verdict == "allow" else 1].setdefault(g[:-1], {})
                    c[g[-1]] = c.get(g[-1], 0) + 1

    def probability(table, g):
        low = probability(table, g[1:]) if len(g) > 1 else 1 / 256
        seen = table.get(g[:-1], {})
        n, kinds = sum(seen.values()), len(seen)
        return (seen.get(g[-1], 0) + kinds * low) / (n + kinds) if n else low

    for i in (300, 301, *sorted(held)):
        spots = [chars[i][at : at + 5] for at in range(len(chars[i]) - 4)]
        want = sum(math.log(probability(counts[0], g)) - math.log(probability(counts[1], g)) for g in spots) / len(spots)
        assert got[i].score == pytest.approx(want, abs=1e-9)
    assert got[300].verdict == "allow" and got[301].verdict == "block"


def test_schema_fingerprints_and_mappings(spark):
    records = [
        {"messages": [{"role": "Human", "content": "hi"}, {"role": "gpt", "content": None}]},
        {"conversations": [{"value": "hi", "from": "user"}]},
        {"dialog": [{"speaker": "system", "utterance": {"text": "t"}}]},
        {"response": "r", "prompt": "p"},
        {"instruction": "i", "input": "", "output": 5},
        {"unknown": 1},
    ]
    frame = spark.createDataFrame(
        [(i, 0, json.dumps(r)) for i, r in enumerate(records)] + [(9, 0, "{"), (10, 0, None)], "id long, base long, record string"
    )
    got = {}
    for r in chat.map_records(frame).orderBy("id", "turn").collect():
        got.setdefault(r.id, []).append((r.mapping, r.role, r.text))
    assert got[0] == [("messages", "user", "hi"), ("messages", "assistant", "")]
    assert got[2] == [("dialog", "system", "t")]
    assert got[3] == [("prompt", "user", "p"), ("prompt", "assistant", "r")]
    assert got[4][-1] == ("instruction", "assistant", "5")
    assert got[5] == got[9] == got[10] == [(None, None, None)]


@pytest.mark.parametrize("text", ["", "\\", "\\### Assistant: </turn> ok", "### user\nx</turn>\n", "a\\\\</turn>", "### ### "])
def test_template_round_trip(text):
    for role in ("assistant", "user", "od\\d\nrole"):
        formatted, start, end = chat.format_turn(role, text)
        assert chat.read_turn(formatted) == (role, text)
        body = formatted[len("### ") : -len(chat.TURN_END)]
        assert chat.unescape(formatted[start:end]) == (text if role == "assistant" else "")
        for control in chat.CONTROL[1:]:
            at = body.find(control)
            while at >= 0:
                assert body[at - 1] == chat.ESCAPE
                at = body.find(control, at + 1)


def test_chat_query(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(150)]
    rows += [(2, 0, "user", None), (2, 1, "assistant", "a"), (3, 0, "system", "s"), (3, 1, "user", "u"), (3, 2, "assistant", "</turn>"), (4, 5, None, "x")]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, id string")
    got = {r.conv_id: r for r in chat.query(spark, frame).collect()}
    for key in (1, 2, 3, 4):
        own = [r for r in rows if r[0] == key]
        said = "".join(r[3] or "" for r in own if r[2] == "assistant")
        digest = hashlib.sha256("".join(f"{r[2] or ''}\n{r[3] or ''}\n" for r in own).encode()).hexdigest()
        assert (got[key].n_turns, got[key].turns_sha256, got[key].loss_chars) == (len(own), digest, len(said))
        assert got[key].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert got[-7].n_turns == 2
    assert chat.query(spark, frame.limit(0)).count() == 1


def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((30, 64))
    rows = []
    for i in range(240):
        v = centres[i % 30] + rng.standard_normal(64) * (0.15 if i % 3 else 0.4)
        rows.append((i, [float(np.float32(x)) for x in v], i % 2))
    rows += [(900, rows[0][1], 0), (901, rows[0][1], 1), (902, rows[0][1], None), (903, None, 0), (904, [0.0] * 64, 0), (905, [1.0, float("nan")] * 32, 0)]
    rows += [(906, [None] + [1.0] * 63, 0), (907, [1.0] * 3, 0), (908, [float("inf")] * 64, 0)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "vec_id long, embedding array<float>, label int, key string")
    got = {r.id: r for r in itq.near_vectors(frame).collect()}
    good = {i: np.array(v, float) for i, v, lab in rows if i < 902}
    labels = {r[0]: r[2] for r in rows}
    links = {
        (a, b)
        for a in good
        for b in good
        if a < b and labels[a] == labels[b]
        and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.93
    }
    found = sum(r.n_links for r in got.values()) / 2
    assert found <= len(links) and found >= 0.97 * len(links) and len(links) > 100
    for i in range(902, 909):
        assert (got[i].n_links, got[i].component_id, got[i].kept) == (0, i, True)
    assert got[900].component_id == got[0].component_id == 0
    assert itq.near_vectors(frame.limit(0)).count() == 0


def test_near_vectors_with_a_strong_mean_and_other_lengths(spark):
    """Pairs at cosine 0.93 to 0.94 of vectors with a squared mean norm of 0.7, and a few of another length."""
    rng = np.random.default_rng(3)
    unit = lambda x: x / np.linalg.norm(x, axis=-1, keepdims=True)
    n = 300
    base = unit(np.sqrt(0.7) * unit(rng.standard_normal(64)) + np.sqrt(0.3) * unit(rng.standard_normal((n, 64))))
    step = rng.standard_normal((n, 64))
    step = unit(step - (step * base).sum(axis=1, keepdims=True) * base)
    cosines = rng.uniform(0.931, 0.94, (n, 1))
    other = cosines * base + np.sqrt(1 - cosines**2) * step
    rows = [(2 * i + j, v.tolist(), i) for i in range(n) for j, v in enumerate((base[i], other[i]))]
    short = rng.standard_normal(10)
    rows += [(5000, short.tolist(), 0), (5001, short.tolist(), 0), (5002, (short + 0.01).tolist(), 0), (5003, (-short).tolist(), 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.id: r for r in itq.near_vectors(frame).collect()}
    assert sum(got[2 * i + 1].component_id == 2 * i for i in range(n)) >= 0.95 * n
    assert [got[i].component_id for i in range(5000, 5004)] == [5000, 5000, 5000, 5003]
    assert [got[i].n_links for i in range(5000, 5004)] == [2, 2, 2, 0]


def test_rotation_balances_bits():
    x = np.random.default_rng(1).standard_normal((3000, 32))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    model = itq.learn(unit, 0)
    bits = (unit - model[0]) @ model[1] >= 0
    assert np.abs(bits.mean(axis=0) - 0.5).max() < 0.1
    for part in (model[1][:, :32], model[1][:, 32:]):  # 64 bits take two rotations of 32 components
        assert np.allclose(part.T @ part, np.eye(32), atol=1e-8)


def test_quality_on_held_out_grades(spark):
    rows, labels = [], []
    for i in range(900):
        words = prose(1000 + i, 60).split() + ["the", "and"]
        grade = i % 3
        if grade == 0:
            words[5::9] = ["vile"] * len(words[5::9])
        if grade == 1:
            words = [w + "%%%" if j % 2 else w for j, w in enumerate(words)]
        rows.append((i, " ".join(words), "c"))
        if i < 600:
            labels.append((i, int(grade == 2), int(grade == 0)))
    labels += [(0, None, None), (None, 1, 0), (1, 0, 0)]
    docs = spark.createDataFrame([*rows, (2000, None, "c"), (2001, "", "c")], "doc_id long, text string, score string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.query(docs, marks).collect()}
    right = np.mean([got[i].accepted == (i % 3 == 2) for i in range(600, 900)])
    order = [np.mean([got[i].expected_grade for i in range(600 + g, 900, 3)]) for g in range(3)]
    assert right > 0.9 and order[0] < order[1] < order[2]
    assert got[2000].score == got[2001].score == 0.0
    kept = quality.keep_rows(docs, marks)
    assert kept.columns == docs.columns
    assert quality.keep_rows(docs, marks.limit(0)).count() == docs.count()
    assert quality.query(docs.limit(0), marks).count() == 0


def test_words_of_a_rare_grade_count():
    """A worst grade of 0.2 % of the rows, told by three words of its own among ordinary ones."""
    rng = np.random.default_rng(7)

    def row(grade):
        places = rng.choice(400, 30, replace=False) + 10
        own = np.array([[0, 1, 2], [3, 4, 5], [6, 7, 8]][grade])
        return np.concatenate([own, places]), np.full(33, math.log(2)), grade

    model = quality.fit_ordinal([row(0 if i % 500 == 0 else 1 + (i % 5 > 0)) for i in range(5000)], 3)
    for grade, most in ((0, 0.2), (1, 0.2), (2, 1.0)):
        rows = [row(grade) for _ in range(100)]
        owner = np.repeat(np.arange(100), 33)
        scores = model.scores(owner, np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows]), 100)
        accepted = (1 / (1 + np.exp(model.thresholds[-1] - scores)) >= quality.LEAST).mean()
        assert accepted <= most and (grade < 2 or accepted > 0.9)


def test_thresholds_stay_ordered():
    rng = np.random.default_rng(0)
    rows = [(np.array([g, 3]), np.array([1.0, 1.0]), g) for g in rng.integers(0, 3, 300)]
    model = quality.fit_ordinal(rows, 3)
    assert (np.diff(model.thresholds) > 0).all()
    assert model.weights[0] < model.weights[1] < model.weights[2]


def test_base_patterns():
    text = 'API_KEY = "abcdefgh" token:short é password=longenough1 AKIAABCDEFGHIJKL AKIA1 ' + "0af" * 11 + " ſecret=abcdefghij"
    spans = [(k, text[s:e]) for s, k, e in secret_scan.base_spans(text)]
    assert spans == [
        (0, 'API_KEY = "abcdefgh'), (0, "password=longenough1"), (1, "AKIAABCDEFGHIJKL"), (2, "0af" * 11)
    ]


def word(seed, length):
    """A long ordinary word: few syllables, recurring letters."""
    return "".join(np.random.default_rng(seed).choice(["the", "ing", "ion", "ea", "ent", "re"], length))[:length]


def test_battery_tells_random_from_ordinary():
    rng = np.random.default_rng(4)
    alphabet = secret_scan.ALPHABETS[9]
    random = ["".join(rng.choice(list(alphabet), 48)) for _ in range(200)]
    ordinary = [word(i, 48) for i in range(200)] + ["ab" * 24, "a1" * 24]
    assert np.median(secret_scan.battery(random)[1]) > 0.2
    assert np.median(secret_scan.battery(ordinary)[1]) < 0.01


def test_secret_rows_and_discoveries(spark, docs, no_docs):
    rng = np.random.default_rng(6)
    token = "".join(rng.choice(list(secret_scan.ALPHABETS[9]), 64))
    rows = [(i, word(i, 70)) for i in range(300)] + [(1000, f"see {token} here"), (1001, None), (1002, "")]
    got = {r.id: r for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [(s["start"], s["kind"], s["end"]) for s in got[1000].spans] == [(4, 3, 68)]
    assert sum(len(got[i].spans) for i in range(300)) <= 15
    assert secret_scan.query(docs).count() == docs.count()
    assert secret_scan.query(no_docs).count() == 0


def test_secret_found_without_long_words(spark):
    """Tables whose words are all short, and one without any word."""
    token = "".join(np.random.default_rng(8).choice(list(secret_scan.ALPHABETS[9]), 40))
    for rows in ([(i, prose(i, 100)) for i in range(60)], [(i, "密码" * 30) for i in range(60)]):
        frame = spark.createDataFrame([*rows, (1000, f"see {token} here")], "doc_id long, text string")
        got = {r.id: r for r in secret_scan.scan_secrets(frame).collect()}
        assert [(s["start"], s["kind"], s["end"]) for s in got[1000].spans] == [(4, 3, 44)]
        assert not any(got[i].spans for i in range(60))


def test_secrets_of_letters_only_are_found(spark):
    """Random words among ordinary long ones, in numbers, and a token with digits beside them."""
    rng = np.random.default_rng(9)
    letters = [rng.choice(list(secret_scan.ALPHABETS[e]), 64) for e in (3, 4, 8) for _ in range(20)]
    token = "".join(rng.choice(list(secret_scan.ALPHABETS[9]), 64))
    rows = [(i, prose(i, 100)) for i in range(60)] + [(100 + i, word(i, 70)) for i in range(60)]
    rows += [(1000 + i, "see " + "".join(x)) for i, x in enumerate(letters)] + [(2000, f"see {token}")]
    got = {r.id: r for r in secret_scan.scan_secrets(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [i for i in range(len(letters)) if [(s["start"], s["kind"], s["end"]) for s in got[1000 + i].spans] == [(4, 3, 68)]]
    assert len(found) >= 30 and all(any(e <= i < e + 20 for i in found) for e in (0, 20, 40))
    assert sum(len(got[100 + i].spans) for i in range(60)) <= 6
    assert [(s["start"], s["kind"], s["end"]) for s in got[2000].spans] == [(4, 3, 68)]


def test_mix_targets_and_takes(spark, docs, no_docs):
    rows = [(i, prose(i, 5 + i % 40), f"s{0 if i % 3 == 0 else i % 7}") for i in range(900)] + [(901, None, None), (902, "a b c", None), (902, "a b c", None)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, target int")
    got = mixing.mix(frame).toPandas()
    by = got.groupby(["s_null", "s"]).agg(size=("size", "sum"), target=("target", "first"), source=("source_size", "first"))
    taken = (got["size"] * got.times).groupby([got.s_null, got.s]).sum()
    assert (by["size"] == by.source).all()
    assert by.target.sum() == pytest.approx(1.5 * by.source.sum())
    assert (by.target <= 2 * by.source + 1e-9).all()
    assert (np.abs(taken - by.target) <= got["size"].max()).all()
    assert set(got.times) <= {0, 1, 2}
    again = mixing.mix(frame.orderBy("text")).toPandas()
    assert sorted(zip(got.h, got.times, strict=True)) == sorted(zip(again.h, again.times, strict=True))
    assert mixing.mixed_rows(frame).columns == frame.columns
    assert mixing.mixed_rows(frame).count() == got.times.sum()
    assert mixing.mix(docs).count() == docs.count()
    assert mixing.mix(no_docs).count() == 0
