"""Vectorised text primitives for Arrow tasks: words, shingles, stable hashes.

Everything works on the UTF-8 bytes of a batch of texts laid end to end. Only
A-Z are lower-cased and words are runs of bytes outside ``20 09-0D``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_UNBASE = pow(_BASE, -1, 1 << 64)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: spreads 64-bit values evenly."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _pow(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        grown = np.full(max(n, 1 << 20), np.uint64(base), dtype=np.uint64)
        grown[0] = 1
        have = _powers[base] = np.multiply.accumulate(grown)
    return have[:n]


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``limit`` bytes each (one row at least)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the n + 1 bounds between them; null is empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[bounds[0] : bounds[-1]], bounds - bounds[0]


def words(data: np.ndarray, bounds: np.ndarray, between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every word, in order; ``between`` marks bytes outside words."""
    space = between[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    starts = ~space
    starts[1:] &= space[:-1] | edge[1:-1]
    ends = ~space
    ends[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.searchsorted(bounds, starts, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span, equal for equal bytes."""
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _pow(_BASE, len(data)), out=total[1:])
    return mix((total[ends] - total[starts]) * _pow(_UNBASE, len(data) + 1)[starts])


def keyed_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: int) -> np.ndarray:
    """A 64-bit hash of each byte span that is no polynomial of its bytes.

    Every run of eight bytes is mixed before it enters the sum, so texts made
    to cancel in a polynomial don't. Spans of fewer bytes are mixed whole.
    Different keys give independent hashes.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray(n + 1, dtype="<u8", buffer=padded, strides=(1,)).astype(np.uint64)
    salt = mix(np.array([key + 1], dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[0]
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix(eight[:n] ^ salt) * _pow(_BASE, n), out=total[1:])
    size = ends - starts
    last = np.maximum(ends - 7, starts)
    long = (total[last] - total[starts]) * _pow(_UNBASE, n + 1)[starts]
    kept = np.minimum(size, 7).astype(np.uint64) * np.uint64(8)
    short = mix((eight[starts] & ((np.uint64(1) << kept) - np.uint64(1))) ^ salt)
    return mix(np.where(size >= 8, long, short) + size.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + salt)


def shingles(data: np.ndarray, bounds: np.ndarray, size: int, key: int = 0) -> list[np.ndarray]:
    """Per text the sorted distinct hashes, by ``key``, of its ``size``-word shingles.

    A text with fewer words has its whole word sequence as one shingle; one
    without words has none.
    """
    data = LOWER[data]
    starts, ends, owner = words(data, bounds)
    n = len(bounds) - 1
    hashes = keyed_hashes(data, starts, ends, key)
    count = np.bincount(owner, minlength=n)
    first = np.concatenate([[0], np.cumsum(count)])
    out: list[np.ndarray] = [np.zeros(0, dtype=np.uint64)] * n
    rolled = np.zeros(max(0, len(hashes) - size + 1), dtype=np.uint64)
    for j in range(size):
        rolled = rolled * _STEP + hashes[j : j + len(rolled)]
    rolled = mix(rolled)
    for i in np.flatnonzero(count):
        a, b = first[i], first[i + 1]
        if count[i] >= size:
            own = np.sort(rolled[a : b - size + 1])
            out[i] = own[np.concatenate([[True], own[1:] != own[:-1]])]
        else:
            value = 0
            for h in hashes[a:b].tolist():
                value = (value * int(_STEP) + h) % (1 << 64)
            out[i] = mix(np.array([value ^ int(count[i])], dtype=np.uint64))
    return out
