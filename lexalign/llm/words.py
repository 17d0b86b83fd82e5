"""Words of many documents at once, as numpy arrays over the UTF-8 bytes of Arrow batches.

Every text is read whole. A chunk holds the documents of a few MB, or a single longer one, so that memory is bounded by
the longest document and not by the batch. Hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

U64 = np.uint64
CHUNK_BYTES = 1 << 20
#: For kernels that keep many arrays over the bytes of a chunk.
SMALL_CHUNK = 1 << 19

_rng = np.random.default_rng(20240229)
BYTE_CODE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
ODD = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
BASE = int(ODD[0])
INVERSE = pow(BASE, -1, 1 << 64)


def _table(members: bytes) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[list(members)] = True
    return out


#: Bytes that end a word in ``[^\x20\x09-\x0D]+``.
BLANKS = _table(bytes([0x20, *range(0x09, 0x0E)]))
#: Bytes that end a word in ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after A-Z are lower-cased.
MARKS = _table(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers: dict[str, np.ndarray] = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and BASE**-i modulo 2**64 for i below n; kept up to 2 Mi entries."""
    if len(_powers["up"]) >= n:
        return _powers["up"][:n], _powers["down"][:n]
    size = 1 << max(16, int(n - 1).bit_length())
    made = []
    for base in (BASE, INVERSE):
        out = np.ones(size, U64)
        done = 1
        while done < size:
            out[done : 2 * done] = out[:done] * U64(pow(base, done, 1 << 64))
            done *= 2
        made.append(out)
    if size <= 2 << 20:
        _powers["up"], _powers["down"] = made
    return made[0][:n], made[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A finalizer: every output bit depends on every input bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def ranges_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``values[start:end]`` for each pair; equal contents give equal hashes wherever they stand."""
    if not len(starts):
        return np.zeros(0, U64)
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, U64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(U64) * ODD[1])


@dataclass
class Words:
    """Words in document order. ``first`` has for each document the place of its first word, and one more at the end."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray
    data: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def cut_words(data: np.ndarray, offsets: np.ndarray, ends_word: np.ndarray, lower: bool) -> Words:
    """``data``: bytes of all documents; ``offsets``: where each begins, and the end."""
    if lower:
        data = LOWER[data]
    inside = ~ends_word[data]
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    at = offsets[:-1]
    before[at[at < len(data)]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    last = offsets[1:]
    after[last[last > 0] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(starts, offsets)
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(ranges_hash(BYTE_CODE[data], starts, ends), starts, ends, doc, first, data)


def chunks(batch: pa.RecordBatch, column: str, size: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of a batch of about ``size`` bytes of text, each with its bytes and offsets. A null text has no bytes."""
    if not batch.num_rows:
        return
    where = batch.schema.get_field_index(column)
    text = batch.column(where)
    if not pa.types.is_large_string(text.type):
        text = text.cast(pa.large_string())
    buffers = text.buffers()
    offs = np.frombuffer(buffers[1], np.int64, len(text) + 1, text.offset * 8)
    lengths = np.diff(offs)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    total, begin = np.cumsum(lengths), 0
    while begin < len(text):
        base = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, base + size, "right")))
        yield batch.slice(begin, end - begin), data[offs[begin] : offs[end]], offs[begin : end + 1] - offs[begin]
        begin = end


def grams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each place, and the places where a document has so many left."""
    n = len(words.hashes)
    if n < k:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    at = np.flatnonzero(words.doc[: n - k + 1] == words.doc[k - 1 :])
    out = np.zeros(n - k + 1, U64)
    for i in range(k):
        out += words.hashes[i : n - k + 1 + i] * ODD[8 + i % 40]
        out ^= out >> U64(29)
    return mix(out[at]), at


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of k words as (document, hash), sorted; a document of fewer words, but not none, is one shingle."""
    hashes, at = grams(words, k)
    doc = words.doc[at]
    counts = words.counts
    few = np.flatnonzero((counts > 0) & (counts < k))
    if len(few):
        whole = ranges_hash(words.hashes, words.first[few], words.first[few + 1])
        hashes, doc = np.concatenate([hashes, whole]), np.concatenate([doc, few])
    order = np.lexsort((hashes, doc))
    hashes, doc = hashes[order], doc[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (doc[1:] != doc[:-1])
    return doc[new], hashes[new]


class Parcels:
    """Arrays on their way to a partition each: rows of (part, data), where data holds the columns one after another.
    At most ``limit`` bytes wait at a time."""

    def __init__(self, dtypes: list[str], parts: int, limit: int = 16 << 20):
        self.kind = np.dtype([(f"f{i}", d) for i, d in enumerate(dtypes)])
        self.parts, self.limit, self.wait, self.size = parts, limit, [], 0

    def add(self, part: np.ndarray, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
        rows = np.empty(len(part), self.kind)
        for name, column in zip(self.kind.names, columns, strict=True):
            rows[name] = column
        self.wait.append((part.astype(np.int32), rows))
        self.size += rows.nbytes
        if self.size > self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[int, bytes]]:
        if self.wait:
            part, rows = (np.concatenate([w[i] for w in self.wait]) for i in (0, 1))
            self.wait, self.size = [], 0
            order = np.argsort(part, kind="stable")
            part, rows = part[order], rows[order]
            cuts = np.flatnonzero(np.diff(part)) + 1
            for begin, end in zip([0, *cuts], [*cuts, len(part)], strict=True):
                if end > begin:
                    yield int(part[begin]), rows[begin:end].tobytes()

    def read(self, blobs: list[bytes]) -> np.ndarray:
        return np.frombuffer(b"".join(blobs), self.kind)
