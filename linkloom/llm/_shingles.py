"""Words and 5-word shingles of whole texts as 64-bit hashes, for many texts at once with NumPy.

Bytes are hashed with a polynomial whose prefix sums give the hash of any span, so no Python loop runs
over words. All arithmetic is modulo 2**64; each span hash is then mixed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WIDTH = 5
#: Texts are taken together up to so many bytes; a longer text is taken alone.
CHUNK_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_FACTORS = np.random.Generator(np.random.PCG64(20_240_501)).integers(1, 1 << 63, WIDTH + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WHITE = np.zeros(256, dtype=bool)
_WHITE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(CHUNK_BYTES, 1 << (n - 1).bit_length())
    if size not in _powers:
        both = tuple(np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, _INVERSE))
        if size > CHUNK_BYTES:
            return both  # not kept: one very long text must not hold memory
        _powers[size] = both
    return _powers[size]


def chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets of the rows in the bytes and their end) for runs of rows."""
    texts = texts.cast(pa.large_binary()).fill_null(b"") if texts.null_count else texts.cast(pa.large_binary())
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each word."""
    text = ~_WHITE[data]
    n = len(data)
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    before = np.concatenate([np.zeros(1, bool), text[:-1]]) if n else text
    after = np.concatenate([text[1:], np.zeros(1, bool)]) if n else text
    starts = np.flatnonzero(text & (~before | edge[:n]))
    ends = np.flatnonzero(text & (~after | edge[1:])) + 1
    return np.searchsorted(offsets, starts, "right") - 1, starts, ends


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    if not len(starts):
        return np.empty(0, np.uint64)
    power, inverse = _power_tables(len(data))
    values = (_LOWER[data] if lower else data).astype(np.uint64) + np.uint64(1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(values * power[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64) * _FACTORS[WIDTH])


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each distinct shingle, ordered by row and hash."""
    row, starts, ends = words(data, offsets)
    h = word_hashes(data, starts, ends)
    n = len(row)
    per_row = np.bincount(row, minlength=len(offsets) - 1)
    first = np.concatenate([np.zeros(1, np.int64), np.cumsum(per_row)])
    long = np.zeros(0, np.int64)
    rolled = np.zeros(0, np.uint64)
    if n >= WIDTH:
        rolled = np.zeros(n - WIDTH + 1, np.uint64)
        for k in range(WIDTH):
            rolled += h[k : n - WIDTH + 1 + k] * _FACTORS[k]
        long = np.flatnonzero(row[: n - WIDTH + 1] == row[WIDTH - 1 :])
        rolled = rolled[long]
    short = np.flatnonzero((per_row > 0) & (per_row < WIDTH))
    whole = per_row[short].astype(np.uint64)
    for k in range(WIDTH - 1):
        has = per_row[short] > k
        whole[has] += h[first[short[has]] + k] * _FACTORS[k]
    rows = np.concatenate([row[long], short])
    hashes = mix(np.concatenate([rolled, whole]))
    order = np.lexsort((hashes, rows))
    rows, hashes = rows[order], hashes[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
    return rows[new], hashes[new]
