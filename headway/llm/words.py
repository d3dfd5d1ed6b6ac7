"""Words and their hashes for whole Arrow columns, in numpy.

A text column is cut into slices of some hundred KB of documents, so that a worker's arrays
stay small; each slice is handled by array operations over its bytes. Hashes are 64 bits; where a collision could change a result the
callers compare more than the hash or say that they don't.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 18

_MULT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACE

ALNUM = np.ones(256, bool)
ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = False

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, n: int) -> np.ndarray:
    """base ** 0 .. n-1 modulo 2 ** 64, kept between slices."""
    have = _powers.get(str(base))
    if have is None or len(have) < n:
        grown = np.full(1 << max(18, (n - 1).bit_length()), base, np.uint64)
        grown[0] = 1
        have = _powers[str(base)] = np.multiply.accumulate(grown)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


class Slice(NamedTuple):
    """Documents first..first+len(offsets)-1 of a column: their bytes and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[Slice]:
    """Whole documents, about ``limit`` bytes at a time; nulls count as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if n == 0:
        return
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64, n + 1, column.offset * 8)
    if column.null_count:
        sizes = np.where(np.asarray(column.is_null()), 0, np.diff(offsets))
        if sizes.sum() != offsets[-1] - offsets[0]:  # bytes behind a null
            column = column.fill_null("")
            _, places, data = column.buffers()
            offsets = np.frombuffer(places, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < n:
        end = max(begin + 1, int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1)
        end = min(end, n)
        yield Slice(begin, raw[offsets[begin] : offsets[end]], offsets[begin : end + 1] - offsets[begin])
        begin = end


class Words(NamedTuple):
    """Words of a slice: byte ranges, the document of each and the first word of each document."""

    starts: np.ndarray
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words_of(piece: Slice, letters: np.ndarray, data: np.ndarray | None = None) -> Words:
    data = piece.data if data is None else data
    n, docs = len(data), len(piece.offsets) - 1
    inside = letters[data]
    begins = piece.offsets[:-1][piece.offsets[:-1] < n]
    start = inside.copy()
    start[1:] &= ~inside[:-1]
    start[begins] = inside[begins]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    before = begins[begins > 0] - 1
    last[before] = inside[before]
    starts, ends = np.flatnonzero(start), np.flatnonzero(last) + 1
    doc = np.searchsorted(piece.offsets, starts, "right") - 1
    return Words(starts, ends, doc, np.searchsorted(doc, np.arange(docs + 1)))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """64 bits of each word's bytes."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * _power(_MULT, len(data)), out=total[1:])
    h = (total[words.ends] - total[words.starts]) * _power(_INVERSE, len(data) + 1)[words.starts]
    return mix(h + (words.ends - words.starts).astype(np.uint64) * _MULT)


def gram_hashes(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of the k words from each place on, of the len - k + 1 places there are."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _MULT + hashes[i : i + n]
    return mix(out ^ np.uint64(k))


def same_doc(doc: np.ndarray, k: int) -> np.ndarray:
    """Whether the k words from each place on lie in one document."""
    n = max(0, len(doc) - k + 1)
    return doc[:n] == doc[len(doc) - n :]
