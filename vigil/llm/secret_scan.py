"""Secret scan: fixed patterns, and a randomness test battery on long tokens.

Every long token gets an inferred encoding (an alphabet), and three tests of
"its symbols are independent and uniform": chi-squared over the alphabet, runs
about the middle, lag-one serial correlation. Fisher's method combines them.
The ordinary population is ordinary text: each document's words too short to be
tokens, joined and cut to the length classes. What share of it, in the token's
class, looks as random as a token is that token's p-value, and
Benjamini-Hochberg in each length class keeps the share of false discoveries
below ``rate``, for tokens of letters only and for the others by themselves: long
ordinary words, which are many, don't raise the bar for the others. The
histograms behind it are over all documents.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import textkit
from vigil.llm.common import materialize, small_batches
from vigil.session import ship_package

#: Fixed patterns of the base kinds, in the order spans are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "random")

#: Tokens the battery looks at, and the length classes' lower bounds.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
CLASSES = (20, 28, 40, 64, 128)
#: Ordinary words: letters only, too short to be a token, no part of one.
WORD = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z]{1,19}(?![A-Za-z0-9+/_=-])")
#: Its pieces from every place are counted besides the documents', for tables with few or no such words.
ORDINARY = (
    "the harbour lay quiet under a grey morning sky and the first boats came in before anyone on the quay had lit a "
    "lamp their crews spoke little as they carried baskets of fish up the worn steps where old women sorted the catch "
    "by size and kind later when the market opened people from the hills brought cheese wool and apples and stayed to "
    "hear news of the war which had moved further north during the winter nobody knew what it would bring them but "
    "most agreed that prices could not rise much longer without some help from the town"
)

_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Alphabets, from the narrowest; a token's encoding is the first that holds all its symbols.
ALPHABETS = (
    _DIGITS,
    _DIGITS + "abcdef",
    _DIGITS + "ABCDEF",
    _LOWER,
    _UPPER,
    _UPPER + "234567",
    _DIGITS + _LOWER,
    _DIGITS + _UPPER,
    _UPPER + _LOWER,
    _UPPER + _LOWER + _DIGITS,
    _UPPER + _LOWER + _DIGITS + "+/=",
    _UPPER + _LOWER + _DIGITS + "+/=-_",
)
LETTERS_ONLY = {3, 4, 8}
BINS = 8
#: Randomness is kept as tenths of -log10 of the combined p, up to this.
WORST = 200

_RANK = np.full((len(ALPHABETS), 256), -1)
for _i, _a in enumerate(ALPHABETS):
    _RANK[_i, list(_a.encode())] = np.arange(len(_a))
_SIZE = np.array([len(a) for a in ALPHABETS])
_SHARE = np.array([np.bincount(np.arange(n) * BINS // n, minlength=BINS) / n for n in _SIZE])
_erfc = np.vectorize(math.erfc, otypes=[float])


def battery(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per token its encoding and the combined p of the three tests."""
    data = np.frombuffer("".join(tokens).encode("ascii"), dtype=np.uint8)
    n = np.array([len(t) for t in tokens])
    first = np.concatenate([[0], np.cumsum(n)[:-1]])
    owner = np.repeat(np.arange(len(tokens)), n)
    encoding = np.full(len(tokens), len(ALPHABETS) - 1)
    for i in range(len(ALPHABETS) - 2, -1, -1):
        encoding[np.minimum.reduceat(_RANK[i][data], first) >= 0] = i
    rank, size = _RANK[encoding[owner], data], _SIZE[encoding]
    counts = np.bincount(owner * BINS + rank * BINS // size[owner], minlength=len(tokens) * BINS).reshape(-1, BINS)
    share = _SHARE[encoding]
    chi = ((counts - n[:, None] * share) ** 2 / (n[:, None] * share)).sum(axis=1)
    # Wilson-Hilferty: the cube root of chi-squared over its freedom is near normal
    k = BINS - 1
    z = ((chi / k) ** (1 / 3) - (1 - 2 / (9 * k))) / math.sqrt(2 / (9 * k))
    p_chi = 0.5 * _erfc(z / math.sqrt(2))
    u = (rank + 0.5) / size[owner]
    inner = np.ones(len(data), dtype=bool)
    inner[first] = False
    high = u >= 0.5
    n1 = np.add.reduceat(high.astype(float), first)
    n2 = n - n1
    change = np.concatenate([[False], high[1:] != high[:-1]]) & inner
    runs = 1 + np.add.reduceat(change.astype(float), first)
    mean = 2 * n1 * n2 / n + 1
    spread = np.sqrt(np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9))
    p_runs = np.where((n1 == 0) | (n2 == 0), 1e-12, _erfc(np.abs(runs - mean) / spread / math.sqrt(2)))
    d = u - (np.add.reduceat(u, first) / n)[owner]
    product = np.concatenate([[0.0], d[1:] * d[:-1]]) * inner
    total = np.add.reduceat(d * d, first)
    r = np.add.reduceat(product, first) / np.maximum(total, 1e-12)
    p_serial = np.where(total < 1e-12, 1e-12, _erfc(np.abs(r) * np.sqrt(n) / math.sqrt(2)))
    x = -sum(np.log(np.maximum(p, 1e-30)) for p in (p_chi, p_runs, p_serial))
    return encoding, np.exp(-x) * (1 + x + x * x / 2)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the fixed patterns, in code points, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 32]
    return sorted(found)


def joined_pieces(text: str) -> list[str]:
    """The text's ordinary words, joined and cut to the length classes in turn, from a turn its letters decide."""
    letters = "".join(WORD.findall(text))
    out, at, turn = [], 0, zlib.crc32(letters.encode())
    while len(letters) - at >= CLASSES[0]:
        size = CLASSES[turn % len(CLASSES)]
        turn += 1
        if at + size <= len(letters):
            out.append(letters[at : at + size])
            at += size
    return out


def _levels(tokens: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token its encoding, level and length class."""
    encoding, p = battery(tokens)
    level = np.minimum(np.floor(-10 * np.log10(np.maximum(p, 1e-25))), WORST).astype(int)
    return encoding, level, np.searchsorted(CLASSES, [len(t) for t in tokens], side="right") - 1


def _histogram(pieces: list[str], step: int = 4096) -> np.ndarray:
    """(class, level) counts of the pieces."""
    out = np.zeros(len(CLASSES) * (WORST + 1), dtype=np.int64)
    for at in range(0, len(pieces), step):
        _, level, length_class = _levels(pieces[at : at + step])
        out += np.bincount(length_class * (WORST + 1) + level, minlength=len(out))
    return out.reshape(len(CLASSES), WORST + 1)


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_TOKEN = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("level", pa.int32()), ("length_class", pa.int32()), ("word", pa.bool_())])
_CELL = pa.struct([("length_class", pa.int32()), ("level", pa.int32()), ("n", pa.int64())])
SCANNED = (
    "id long, base array<struct<start: bigint, kind: int, end: bigint>>, "
    "tokens array<struct<start: bigint, end: bigint, level: int, length_class: int, word: boolean>>, "
    "ordinary array<struct<length_class: int, level: int, n: bigint>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in textkit.slices(batches, "text", 4 << 20):
        base, found, tokens, pieces = [], [], [], []
        for row, text in enumerate(part.column("text").to_pylist()):
            text = text or ""
            base.append(base_spans(text))
            found += [(row, m.start(), m.end()) for m in TOKEN.finditer(text)]
            tokens += [m for m in TOKEN.findall(text)]
            pieces += joined_pieces(text)
        own: list[list[dict]] = [[] for _ in base]
        if tokens:
            encoding, level, length_class = _levels(tokens)
            for (row, a, b), e, v, c in zip(found, encoding.tolist(), level.tolist(), length_class.tolist(), strict=True):
                covered = any(s < b and a < t for s, _, t in base[row])
                if not covered:
                    own[row].append({"start": a, "end": b, "level": v, "length_class": c, "word": e in LETTERS_ONLY})
        # the slice's histogram goes with its first row
        cells = _histogram(pieces)
        ordinary = [{"length_class": c, "level": v, "n": cells[c, v]} for c, v in np.argwhere(cells).tolist()]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array([[{"start": s, "kind": k, "end": t} for s, k, t in x] for x in base], pa.list_(_SPAN)),
                pa.array(own, pa.list_(_TOKEN)),
                pa.array([ordinary, *[[]] * (len(base) - 1)][: len(base)], pa.list_(_CELL)),
            ],
            names=["id", "base", "tokens", "ordinary"],
        )


def discovery_levels(tokens: DataFrame, ordinary: DataFrame, rate: float) -> list[int]:
    """The highest level still a discovery at ``rate``, or -1, per length class: of tokens with other symbols, of letters only.

    ``tokens`` has ``length_class, level, word``, ``ordinary`` has
    ``length_class, level, n``. Only the histograms, at most classes x levels
    x 3 cells, reach the driver.
    """
    null = _histogram([text[i : i + n] for n in CLASSES for text in [ORDINARY.replace(" ", "")] for i in range(len(text) - n + 1)])
    for c in ordinary.groupBy("length_class", "level").agg(F.sum("n").alias("n")).collect():
        null[c["length_class"], c["level"]] += c["n"]
    counts = np.zeros((len(CLASSES), 2, WORST + 1))
    for c in tokens.groupBy("length_class", "level", "word").count().collect():
        counts[c["length_class"], int(c["word"]), c["level"]] += c["count"]
    out = []
    for k in range(len(CLASSES)):
        p = (1 + np.cumsum(null[k])) / (1 + null[k].sum())
        for own in counts[k]:
            seen = np.cumsum(own)
            good = np.flatnonzero((seen > 0) & (p * own.sum() <= rate * seen))
            out.append(int(good.max()) if len(good) else -1)
    return out


def scan_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rate: float = 0.05) -> DataFrame:
    """One row per input row: ``id, base, spans``: arrays of (start, kind, end) in code points.

    ``base`` holds the fixed patterns' spans, ``spans`` these and the tokens
    the battery discovers (kind 3) outside them, by start, then kind. Null and
    empty texts have none. Repeated rows and ids are scanned each for itself;
    an empty table gives no rows; other columns aren't read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    scanned = materialize(rows.mapInArrow(_scan, SCANNED), "secret-spans")
    each = lambda c: scanned.select(F.explode(c).alias("t")).select("t.*")
    levels = discovery_levels(each("tokens"), each("ordinary"), rate)
    limits = F.array(*[F.lit(x) for x in levels])
    random = F.transform(
        F.filter("tokens", lambda t: t["level"] <= F.element_at(limits, 2 * t["length_class"] + t["word"].cast("int") + 1)),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
    )
    return scanned.select("id", "base", F.array_sort(F.concat("base", random)).alias("spans"))


def _joined(spans: str):
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )


def query(docs: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scan_secrets(docs).select(
        F.col("id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )
