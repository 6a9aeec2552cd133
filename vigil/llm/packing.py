"""Packing along a space-filling curve.

Documents become token ids and a hashed count vector, which a fixed random
projection takes to a few dimensions; the Hilbert key of that point is the sort
key. Range partitions follow the curve, so neighbours on it share sequences,
and each partition is cut into full sequences in one streaming pass. What a
partition leaves over goes into sequences of power-of-two length, which need no
padding.
"""

from __future__ import annotations

import functools
import itertools
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vigil.llm import textkit
from vigil.llm.common import materialize, small_batches
from vigil.session import ship_package

#: Hashed vector width, projected dimensions and bits per dimension.
WIDTH, DIMENSIONS, BITS = 512, 4, 10
#: Tokens per range partition: 32 MB of two-byte ids.
PARTITION_TOKENS = 16_000_000
#: Word pieces whose ids a worker remembers at once.
CACHE_PIECES = 800_000
#: Longest piece remembered, in bytes.
CACHE_BYTES = 64
#: Text taken apart at a time, where one document isn't longer.
SLICE_BYTES = 4 << 20
#: New pieces the tokenizer gets as one text.
GROUP_WORDS = 512


#: What a byte belongs to for the tokenizer's pre-splitting: a letter, a digit,
#: any other sign, one of these three but not known which, or white space (of
#: control characters, also those that only some engines count as such).
LETTER, DIGIT, SIGN, SOLID, WHITE = range(5)
KIND = np.full(256, SIGN, np.uint8)
KIND[[*range(0x30, 0x3A)]] = DIGIT
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = LETTER
KIND[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = WHITE
KIND[0x80:] = SOLID
#: First bytes of U+00C0 to U+02BF and of U+0400 to U+047F, letters but for U+00D7 and U+00F7.
KIND[[*range(0xC3, 0xCB), 0xD0, 0xD1]] = LETTER
#: White space beyond ASCII, in UTF-8.
WIDE_SPACES = [chr(c).encode() for c in (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
WIDE_CODES = np.array([int.from_bytes(s.ljust(3, b"\0"), "big") for s in WIDE_SPACES])


def kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character each byte of a UTF-8 text belongs to."""
    kind = KIND[data]
    first = np.flatnonzero(((data >= 0xC3) & (data < 0xCB)) | (data == 0xD0) | (data == 0xD1))
    if len(first):
        sign = (data[first] == 0xC3) & ((data[first + 1] == 0x97) | (data[first + 1] == 0xB7))
        kind[first[sign]] = SOLID
        kind[first[~sign] + 1] = LETTER
    first = np.flatnonzero((data == 0xC2) | ((data >= 0xE1) & (data <= 0xE3)))
    if len(first):
        size = np.where(data[first] == 0xC2, 2, 3)
        code = data[first].astype(np.int64) << 16 | data[first + 1].astype(np.int64) << 8
        code[size == 3] |= data[first[size == 3] + 2]
        white = np.isin(code, WIDE_CODES)
        kind[first[white]] = kind[first[white] + size[white] - 1] = WHITE
    return kind


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of UTF-8 texts begin, which lie end to end between ``bounds``.

    Texts are cut before a space and around a line break that have no white
    space beside them, and between letters, digits and signs, but not between
    an apostrophe and a letter. A byte-level tokenizer's own pre-splitting cuts
    at all these places too, so the ids of the pieces end to end are the ids of
    the text.
    """
    kind = kinds(data)
    cut = np.zeros(len(data) + 1, bool)
    plain = kind < SOLID
    cut[1:-1] = (kind[1:] != kind[:-1]) & plain[1:] & plain[:-1] & ((data[:-1] != 0x27) | (kind[1:] != LETTER))
    solid = kind != WHITE
    gap = np.flatnonzero((data[1:-1] == 0x20) | (data[1:-1] == 0x0A)) + 1
    gap = gap[solid[gap - 1] & solid[gap + 1]]
    cut[gap] = True
    cut[gap[data[gap] == 0x0A] + 1] = True
    cut[bounds] = True
    return np.flatnonzero(cut[:-1])


class Encoder:
    """Token ids of whole texts, piece by piece.

    Pieces (see ``piece_starts``) recur, and the ids of the shorter ones are
    remembered, up to a fixed number of pieces.
    """

    def __init__(self, path: str | None, end_id: int) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("byte_bpe_50k.json")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        size = max(end_id, *self.tokenizer.get_vocab().values()) + 1
        self.type = "H" if size <= 1 << 16 else "I"
        self.end = array(self.type, [end_id]).tobytes()
        #: Bin of the hashed count vector, by id.
        self.bins = bins(np.arange(size))
        #: Ids of a piece, by the piece.
        self.seen: dict[bytes, bytes] = {}
        self.plain = re.compile(r" ?\S+")
        # pieces may only be encoded apart where splitting is byte-level and comes first
        split = self.tokenizer.pre_tokenizer
        self.splits = (
            type(split).__name__ == "ByteLevel"
            and split.use_regex
            and not split.add_prefix_space
            and self.tokenizer.normalizer is None
            and all(t.special for t in self.tokenizer.get_added_tokens_decoder().values())
        )
        line = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = line[0] if len(line) == 1 else None

    def ids(self, texts: list[str]) -> list[bytes]:
        return [array(self.type, e.ids).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, words: list[str]) -> list[bytes]:
        """Ids of each of the pieces.

        Pieces without white space but a space before them are encoded in one
        go, a line break between them: it is a token of its own there, and
        none of the pieces has one.
        """
        out: list[bytes | None] = [None] * len(words)
        plain = [i for i, w in enumerate(words) if self.plain.fullmatch(w)] if self.line is not None else []
        groups = [plain[i : i + GROUP_WORDS] for i in range(0, len(plain), GROUP_WORDS)]
        joined = ["\n".join([words[i] for i in g]) for g in groups]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast(joined, add_special_tokens=False), strict=True):
            ids = np.array(found.ids, self.type)
            breaks = np.flatnonzero(ids == self.line) * ids.itemsize
            if len(breaks) == len(group) - 1:
                raw, size = ids.tobytes(), ids.itemsize
                starts, ends = [0, *(breaks + size).tolist()], [*breaks.tolist(), len(raw)]
                for i, x, y in zip(group, starts, ends, strict=True):
                    out[i] = raw[x:y]
        rest = [i for i, o in enumerate(out) if o is None]
        for i, o in zip(rest, self.ids([words[i] for i in rest]), strict=True):
            out[i] = o
        return out

    def lookup(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of distinct pieces, remembered or encoded now."""
        found = list(map(self.seen.get, pieces))
        new = [i for i, f in enumerate(found) if f is None]
        if len(self.seen) + len(new) > CACHE_PIECES:
            self.seen.clear()
        for i, ids in zip(new, self.pieces([pieces[i].decode() for i in new]), strict=True):
            found[i] = ids
            if len(pieces[i]) <= CACHE_BYTES:
                self.seen[pieces[i]] = ids
        return found

    def flat(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, each with the end id, and the n + 1 bounds between them."""
        if not self.splits:
            blobs = [i + self.end for i in self.ids([t or "" for t in column.to_pylist()])]
            bounds = np.cumsum([0, *map(len, blobs)])
            return np.frombuffer(b"".join(blobs), self.type), bounds // len(self.end)
        data, bounds = textkit.text_bytes(column)
        starts = piece_starts(data, bounds)
        first = np.searchsorted(starts, bounds)
        offsets = np.append(starts, len(data))
        spans = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data))]
        ).dictionary_encode()
        distinct = self.lookup(spans.dictionary.to_numpy(zero_copy_only=False).tolist())
        order = np.insert(spans.indices.to_numpy(), first[1:], len(distinct))
        taken = pa.array([*distinct, self.end], pa.large_binary()).take(pa.array(order))
        raw, at = textkit.text_bytes(taken)
        return raw.view(self.type), at[first + np.arange(len(first))] // len(self.end)

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids and the end id, in native unsigned integers."""
        ids, bounds = self.flat(pa.array(texts, pa.large_string()))
        return [ids[a:b].tobytes() for a, b in itertools.pairwise(bounds.tolist())]


@functools.cache
def encoder(path: str | None, end_id: int) -> Encoder:
    """One per worker process, so later tasks find the pieces of earlier ones."""
    return Encoder(path, end_id)


def hilbert_key(points: np.ndarray, bits: int) -> np.ndarray:
    """The index along the Hilbert curve of (n, d) integer points below 2**bits."""
    x = [points[:, i].astype(np.int64) for i in range(points.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        low = q - 1
        for i in range(len(x)):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            x[i] = x[i] ^ swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] = x[i] ^ x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << 1) | (((axis ^ turn) >> b) & 1)
    return key


def bins(tokens: np.ndarray) -> np.ndarray:
    """The place of each token id in the hashed count vector."""
    return (textkit.mix(tokens.astype(np.uint64) + np.uint64(1)) >> np.uint64(40)).astype(np.int64) % WIDTH


def curve_keys(place: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Hilbert keys of documents from the bins of their token ids, which lie end to end between ``bounds``."""
    n = len(bounds) - 1
    flat = np.repeat(np.arange(n) * WIDTH, np.diff(bounds)) + place
    vector = np.log1p(np.bincount(flat, minlength=n * WIDTH).reshape(n, WIDTH))
    vector /= np.maximum(np.linalg.norm(vector, axis=1, keepdims=True), 1e-9)
    # the mean direction says nothing of a document, so the projection leaves it out
    ray = np.random.default_rng(8).standard_normal((WIDTH, DIMENSIONS))
    ray -= ray.mean(axis=0)
    even = 1 / (1 + np.exp(-1.702 * 1.5 * (vector @ ray)))
    return hilbert_key(np.minimum((even * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _tokenise(path: str | None, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, end_id)
        for part in textkit.slices(batches, "text", SLICE_BYTES):
            ids, bounds = own.flat(part.column("text"))
            offsets = pa.py_buffer((bounds * ids.itemsize).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("id"),
                    pa.array(np.diff(bounds)),
                    pa.array(curve_keys(own.bins[ids], bounds)),
                    pa.Array.from_buffers(pa.binary(), part.num_rows, [None, offsets, pa.py_buffer(ids)]),
                ],
                names=["id", "n", "key", "ids"],
            )

    return run


PIECE = "id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


class _Packer:
    """Cuts documents in order into sequences; holds one unfinished sequence at most."""

    def __init__(self, length: int, keep_ids: bool, first: int) -> None:
        self.length, self.keep_ids, self.sequence = length, keep_ids, first
        self.open: list[tuple] = []
        self.filled = 0

    def piece(self, id_, start: int, ids: np.ndarray, total: int, offset: int) -> tuple:
        return (
            id_, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, self.sequence, offset,
            ids.astype("<u4").tobytes() if self.keep_ids else None,
        )

    def add(self, id_, ids: np.ndarray) -> Iterator[tuple]:
        at = 0
        while at < len(ids):
            take = min(len(ids) - at, self.length - self.filled)
            self.open.append((id_, at, ids[at : at + take], len(ids)))
            self.filled += take
            at += take
            if self.filled == self.length:
                yield from self.cut(self.length)

    def cut(self, size: int) -> Iterator[tuple]:
        """A sequence of ``size`` tokens from the head of what is open."""
        offset, rest = 0, []
        for id_, start, ids, total in self.open:
            take = min(len(ids), size - offset)
            if take:
                yield self.piece(id_, start, ids[:take], total, offset)
                offset += take
            if take < len(ids):
                rest.append((id_, start + take, ids[take:], total))
        self.open, self.filled = rest, self.filled - size
        self.sequence += 1

    def finish(self) -> Iterator[tuple]:
        while self.filled:
            yield from self.cut(1 << (self.filled.bit_length() - 1))


def _pack(length: int, keep_ids: bool, width: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [(n, pa.int64()) for n in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
            + [("ids", pa.binary())]
        )
        packer = _Packer(length, keep_ids, TaskContext.get().partitionId() << 40)

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(schema)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
            )

        for part in textkit.slices(batches, "ids"):
            rows: list[tuple] = []
            for id_, blob in zip(part.column("id").to_pylist(), part.column("ids").to_pylist(), strict=True):
                rows.extend(packer.add(id_, np.frombuffer(blob, width)))
            yield out(rows)
        yield out(list(packer.finish()))

    return run


def pack(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 2048,
    tokenizer: str | None = None,
    end_id: int = 1,
    keep_ids: bool = True,
    partition_tokens: int = PARTITION_TOKENS,
) -> DataFrame:
    """One row per piece: ``id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids``.

    Every token of every document, the end id included, lies in exactly one
    piece; the pieces of a sequence are gapless from 0. Null and empty texts
    are the end id alone. Repeated rows and equal ids are packed each for
    itself, a null id stays null. An empty table gives no rows. ``tokenizer``
    is the vocabulary file's path on every worker (default: the public
    byte-level BPE). Columns other than the two named aren't read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    tokens = materialize(
        rows.mapInArrow(_tokenise(tokenizer, end_id), "id long, n long, key long, ids binary").withColumn(
            "at", F.monotonically_increasing_id()
        ),
        "pack-tokens",
    )
    total = tokens.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // partition_tokens))
    order = ["key", "id", "at"]
    ordered = tokens.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("id", "ids")
    return ordered.mapInArrow(_pack(length, keep_ids, encoder(tokenizer, end_id).type), PIECE)


def query(docs: DataFrame) -> DataFrame:
    return pack(docs, keep_ids=False).withColumnRenamed("id", "doc_id").drop("ids")
