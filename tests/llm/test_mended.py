"""Crafted words, own roles, short and extreme vectors: inputs that once gave wrong answers."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from vigil.llm import chat, common, itq, minhash, packing, textkit

from .conftest import prose


def test_words_made_to_cancel_in_polynomials_stay_apart(spark):
    signs = [bin(i).count("1") % 2 for i in range(1024)]
    a, b = ("".join("ab"[s ^ flip] for s in signs) for flip in (0, 1))
    sets = textkit.shingles(*textkit.text_bytes(pa.array([a, b])), 5)
    assert sets[0][0] != sets[1][0]
    docs = spark.createDataFrame([(0, a), (1, b), (2, f"{a} w x y z"), (3, f"{b} w x y z")], "doc_id long, text string")
    got = {r.doc_id: (r.component_id, r.kept) for r in minhash.query(docs).collect()}
    assert got == {i: (i, True) for i in range(4)}


def test_keyed_hashes_tell_spans_by_content_and_length():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 4000).astype(np.uint8)
    starts = rng.integers(0, 3900, 3000)
    ends = starts + rng.integers(0, 20, 3000)
    for key in (0, 1):
        h = textkit.keyed_hashes(data, starts, ends, key)
        spans = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
        seen = {}
        for s, v in zip(spans, h.tolist(), strict=True):
            assert seen.setdefault(s, v) == v
        assert len(set(seen.values())) == len(seen)
    assert (textkit.keyed_hashes(data, starts, ends, 0) != textkit.keyed_hashes(data, starts, ends, 1)).all()
    # at the end of the data, and zero bytes
    tail = np.frombuffer(b"abc\0\0xyz", np.uint8)
    h = textkit.keyed_hashes(tail, np.array([0, 0, 0, 5]), np.array([3, 4, 5, 8]), 0)
    assert len(set(h.tolist())) == 4


def test_kept_is_the_smallest_id_also_for_repeated_ids(spark):
    text = prose(4, 60)
    docs = spark.createDataFrame([(7, text), (7, text), (9, text), (None, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in minhash.query(docs).collect())
    assert got == [(0, 7, False), (7, 7, True), (7, 7, True), (9, 7, False)]
    assert minhash.keep_rows(docs).count() == 1


def read_back(rows):
    """The digests by plain Python, rows by turn (null first), role, text."""
    out = {}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] is not None, r[2] or "", r[3] or ""))
    for conv, _, role, text in order:
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        c: (len(t), hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in t).encode()).hexdigest(),
            sum(len(x) for r, x in t if r == "assistant"), hashlib.sha256("".join(x for r, x in t if r == "assistant").encode()).hexdigest())
        for c, t in out.items()
    }


def test_roles_are_read_back_as_they_were(spark):
    rows = [(1, 0, "human", "hi"), (1, 1, "GPT", "### hello </turn>"), (1, 2, "assistant", "yes"), (2, 0, None, "no role"), (2, 1, "Assistant", "cased")]
    rows += [(3, 0, "user", "a"), (3, 1, "assistant", None), (4, 0, "system", ""), (4, 1, "user", "b"), (4, 2, "assistant", "c\\n\\")]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "x"), (5, None, "assistant", "null turn"), (5, None, "user", "null turn"), (5, 3, "bot", "y")]
    rows += [(6, 7, "assistant", f"{i:03}") for i in range(200)] + [(7, i, "user", str(i)) for i in range(-70, 150)] + [(8, 0, "a\nb", "role with a line")]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    want = read_back([*rows, (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")])
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.query(spark, frame).collect()}
    assert got == want
    sizes = [len(r.record) for r in chat.as_records(frame.filter("conv_id = 6")).collect()]
    assert len(sizes) == 4  # 200 rows of one turn number, 64 to a record


@pytest.mark.parametrize("dim", [2, 8, 32, 48, 64])
def test_short_vectors_are_indexed_by_learned_bits(spark, dim):
    """Pairs found stay far below all pairs, and those at the threshold are found."""
    rng = np.random.default_rng(dim)
    sample = rng.standard_normal((1500, dim))
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    models = itq.learn_tables(sample, 0.93) or [itq.about_origin(dim, t) for t in range(itq.tables_about_origin(0.93))]
    assert all(m[1].shape == (dim, itq.BITS) for m in models)
    found = np.zeros(len(sample) - 1, dtype=bool)
    for m in models:
        found |= itq.finds(sample[:-1], sample[1:], m)
    cosine = (sample[:-1] * sample[1:]).sum(axis=1)
    if dim >= 8:
        assert found[cosine < 0.5].mean() < 0.1
    for a, b in itq.made_pairs(sample, 0.93):
        hit = np.zeros(len(a), dtype=bool)
        for m in models:
            hit |= itq.finds(a, b, m)
        assert hit.mean() >= 0.9


def test_components_of_any_size_compare(spark):
    rows = [(0, [1e200, 2e200], 1), (1, [-1e200, 2e200], 1), (2, [1e200, 2.1e200], 1), (3, [1e-200, 2e-200], 1), (4, [5e-324, 0.0], 1), (5, [1e308, -1e-308], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.query(frame).collect()}
    assert got == {0: (2, 0), 2: (2, 0), 3: (2, 0), 1: (0, 1), 4: (1, 4), 5: (1, 4)}


def test_memory_can_be_trimmed(spark):
    common.trim_memory(spark)


def test_signs_and_line_breaks_make_no_new_pieces():
    words, signs = sorted(set(prose(5, 40).split())), [",", ".", "!", "?", ";", ":", "12", ").", "\n", "\nNext"]
    encoder = packing.Encoder(None, 1)
    texts = [f"{b} {a}{s}" for s in signs for a, b in zip(words, reversed(words), strict=True)]
    want = [t.ids + [1] for t in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(b, encoder.type).tolist() for b in encoder.encode(texts)] == want
    assert len(encoder.seen) <= 2 * len(words) + 2 * len(signs)


def test_ids_of_any_text_are_the_tokenizers():
    rng = random.Random(11)
    signs = [*"abZ01.,!'\n\t\r\x00\x1c\x7f", *"\x85\xa0\xd7\xf7\xdf\xe9\xaa\u02b0\u0416\u4e2d\u2014\u2009\u3000\u0301\u0663\U0001f600", "'s", "'re", "<|endoftext|>"]
    texts = ["".join(rng.choices([*signs, *" " * 9, "\n"], k=rng.randint(0, 25))) for _ in range(5000)]
    texts += [None, "", " ", "\n", "x" * 300]
    encoder = packing.Encoder(None, 1)
    want = [t.ids + [1] for t in encoder.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]
    for _ in range(2):  # pieces new, then remembered
        assert [np.frombuffer(b, encoder.type).tolist() for b in encoder.encode(texts)] == want
    assert encoder.encode([]) == [] and encoder.encode([None, ""]) == [encoder.end] * 2


def test_tokenizers_that_split_otherwise_get_whole_texts(tmp_path):
    from tokenizers import AddedToken, Tokenizer, normalizers, pre_tokenizers

    texts = ["one, two\nthree", "a.b c", "", "x  y\n\nz!", "it's 12ab, and more"]
    plain = packing.Encoder(None, 1)
    for change in (
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=True)),
        lambda t: setattr(t, "pre_tokenizer", pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)),
        lambda t: setattr(t, "normalizer", normalizers.Replace("two\n", "2 ")),
        lambda t: t.add_tokens([AddedToken("o, t", normalized=False)]),
    ):
        other = Tokenizer.from_str(plain.tokenizer.to_str())
        change(other)
        path = str(tmp_path / "other.json")
        other.save(path)
        encoder = packing.Encoder(path, 1)
        want = [t.ids + [1] for t in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert plain.splits and not encoder.splits
        assert [np.frombuffer(b, encoder.type).tolist() for b in encoder.encode(texts)] == want
