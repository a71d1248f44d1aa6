"""Words, lines and n-gram hashes of many texts at once, as numpy arrays over one byte buffer.

Python objects per word would cost more than all else that the operators do, so a batch of
texts stays one byte array: words are pairs of positions and are compared by 64-bit hashes.
Batches are cut into slices of about SLICE_BYTES and at most SLICE_ROWS texts (a text is never
cut), which bounds memory.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 1 << 14
U64 = np.uint64

_random = np.random.default_rng(20240229)
_BYTE = _random.integers(0, 1 << 64, 256, dtype=U64) | U64(1)
_STEP = U64(0x9E3779B97F4A7C15)
_STEP_BACK = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FOLD = U64(0xBF58476D1CE4E5B9)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def cut(
    batch: pa.RecordBatch, column: str | int, size: int = SLICE_BYTES, rows: int = SLICE_ROWS
) -> Iterator[pa.RecordBatch]:
    """Runs of rows whose texts have about `size` bytes together, at most `rows` and at least one."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    group = (np.cumsum(lengths.astype(np.int64)) - lengths) // size
    edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    for a, b in zip(edges, edges[1:], strict=False):
        for k in range(a, b, rows):
            yield batch.slice(k, min(rows, b - k))


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each text begins (one more entry: the end)."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    forth, back = np.full(n, _STEP, U64), np.full(n, _STEP_BACK, U64)
    forth[0] = back[0] = 1
    return np.cumprod(forth), np.cumprod(back)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(21, int(n).bit_length())
    return _powers(size)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a finaliser; one to one)."""
    h = (h ^ (h >> U64(30))) * _FOLD
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


class Ranges:
    """Hashes of any byte ranges of a buffer, from prefix sums of a polynomial."""

    def __init__(self, raw: np.ndarray):
        forth, self._back = powers(len(raw) + 1)
        self._sums = np.zeros(len(raw) + 1, U64)
        np.cumsum(_BYTE[raw] * forth[: len(raw)], out=self._sums[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        h = (self._sums[ends] - self._sums[starts]) * self._back[starts]
        return mix(h + (ends - starts).astype(U64) * _STEP)

    def every(self, size: int) -> np.ndarray:
        """The hashes of all ranges of one size."""
        n = max(0, len(self._sums) - size)
        h = (self._sums[size:] - self._sums[:n]) * self._back[:n]
        return mix(h + U64(size * int(_STEP) % (1 << 64)))


def counts_by_doc(marks: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many marked bytes each text has."""
    sums = np.zeros(len(marks) + 1, np.int64)
    np.cumsum(marks, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of bytes other than ASCII white space."""
    inside = ~SPACE[raw]
    return runs(inside, offsets)


def runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every run of marked bytes within a text."""
    n = len(inside)
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = offsets[(offsets > 0) & (offsets < n)]
    first[edges] = inside[edges]
    last[edges - 1] = inside[edges - 1]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


def lines(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text number of every non-empty line (split at \\n alone)."""
    return runs(raw != 10, offsets)


def grams(hashes: np.ndarray, docs: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of every run of k words of one text."""
    m = len(hashes) - k + 1
    if m <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U64)
    h = hashes[:m].copy()
    for j in range(1, k):
        h = (h ^ (h >> U64(29))) * _STEP + hashes[j : j + m]
    at = np.flatnonzero(docs[:m] == docs[k - 1 :])
    return at, mix(h[at])


def keyed(hashes: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Hashes that are equal only within one text."""
    return mix(hashes + mix(docs.astype(U64) + _STEP))


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur more than once."""
    order = np.argsort(values, kind="stable")
    same = values[order][1:] == values[order][:-1]
    out = np.zeros(len(values), bool)
    out[order[1:]] |= same
    out[order[:-1]] |= same
    return out
