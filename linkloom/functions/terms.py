"""Terms of many texts at once, as 64-bit hashes in NumPy arrays.

The texts of a chunk are one array of code points in which every text stands between two blanks. Prefix sums
of a polynomial give the hash of any span, so no Python loop runs over characters, n-grams or words. Two
different terms of a corpus with a million terms share a hash with a probability of about 3e-8.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np

#: Texts are taken together up to so many characters; a longer text is taken alone.
CHUNK_CHARS = 1 << 19

_BASE = 0x9E3779B97F4A7C15
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_STEP = 0xA0761D6478BD642F
_powers: list[np.ndarray] = []
_tables: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power_tables(n: int) -> list[np.ndarray]:
    if not _powers or len(_powers[0]) <= n:
        size = max(n, 4 * CHUNK_CHARS)
        both = [np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64))]
        if n > 4 * CHUNK_CHARS:
            return both  # not kept: one very long text must not hold memory
        _powers[:] = both
    return _powers


def letters(kinds: str) -> np.ndarray:
    """By code point: whether its general category begins with one of kinds; `_` in kinds adds the underscore."""
    if kinds not in _tables:
        table = np.fromiter((unicodedata.category(chr(c))[0] in kinds for c in range(0x110000)), bool, 0x110000)
        table[0x5F] |= "_" in kinds
        _tables[kinds] = table
    return _tables[kinds]


def chunks(texts: list[str], limit: int = CHUNK_CHARS) -> Iterator[tuple[int, int]]:
    """(first, end) of runs of texts that are taken together."""
    first = 0
    while first < len(texts):
        end, size = first + 1, len(texts[first])
        while end < len(texts) and size + len(texts[end]) <= limit:
            size += len(texts[end])
            end += 1
        yield first, end
        first = end


class Points:
    """The code points of several texts, with the hash of any span."""

    def __init__(self, texts: list[str]):
        self.n = len(texts)
        joined = " " + "  ".join(texts) + " "
        self.points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        self.owner = np.repeat(np.arange(self.n), [len(x) + 2 for x in texts])
        self.power, self.inverse = _power_tables(len(self.points))
        self.sums = np.zeros(len(self.points) + 1, np.uint64)
        np.cumsum(mix(self.points.astype(np.uint64) + np.uint64(1)) * self.power[: len(self.points)], out=self.sums[1:])

    def row(self, places: np.ndarray) -> np.ndarray:
        return self.owner[places]

    def span(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + (ends - starts).astype(np.uint64) * _LENGTH)

    def runs(self, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the runs of code points that the table holds; a blank is never in it."""
        edges = np.diff(np.concatenate([[0], inside[self.points].astype(np.int8), [0]]))
        return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)

    def grams(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of the n-grams inside each word with one blank on both sides; a shorter word gives itself once."""
        if low < 2:
            raise ValueError("n-grams of at least two characters")
        blank = self.points == 32
        before = np.concatenate([[0], np.cumsum(blank)])
        starts, found = [], []
        for n in range(low, high + 1):
            m = max(len(self.points) - n + 1, 0)
            # Blanks stand at the ends of a window only; all of it is one padded word then.
            ok = before[n - 1 : n - 1 + m] == before[1 : 1 + m]
            if n == 2 and m:
                ok &= ~(blank[:-1] & blank[1:])
            starts.append(np.flatnonzero(ok))
            found.append(mix((self.sums[n : n + m][ok] - self.sums[:m][ok]) * self.inverse[:m][ok] + np.uint64(n * int(_LENGTH) % (1 << 64))))
        if low > 3:
            edges = np.diff(np.concatenate([[0], (~blank).astype(np.int8), [0]]))
            first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            short = last - first + 2 < low
            starts.append(first[short] - 1)
            found.append(self.span(first[short] - 1, last[short] + 1))
        return self.row(np.concatenate(starts)), np.concatenate(found)

    def words(self, kinds: str) -> tuple[np.ndarray, np.ndarray]:
        """Row and hash of the runs of characters of these kinds, in order."""
        starts, ends = self.runs(letters(kinds))
        return self.row(starts), self.span(starts, ends)


def phrases(row: np.ndarray, words: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each run of length adjacent words of a text; a single word keeps its hash."""
    if length == 1 or len(words) < length:
        return (row, words) if length == 1 else (row[:0], words[:0])
    n = len(words) - length + 1
    total = np.zeros(n, np.uint64)
    for k in range(length):
        total += words[k : k + n] * np.uint64(pow(_STEP, k + 1, 1 << 64))
    same = row[:n] == row[length - 1 :]
    return row[:n][same], mix(total)[same]


class Places:
    """Where 64-bit hashes are in a sorted table of distinct ones. Hashes are spread evenly, so their leading bits lead there."""

    def __init__(self, terms: np.ndarray):
        self.terms = np.append(terms, np.uint64(0xFFFFFFFFFFFFFFFF))
        bits = len(terms).bit_length() + 1
        self.shift = np.uint64(64 - bits)
        sizes = np.bincount((terms >> self.shift).astype(np.int64), minlength=1 << bits)
        self.begin = np.cumsum(sizes) - sizes

    def of(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The place of each hash, and whether the table has it."""
        at = self.begin[(h >> self.shift).astype(np.int64)]
        left = np.flatnonzero(self.terms[at] < h)
        while len(left):
            at[left] += 1
            left = left[self.terms[at[left]] < h[left]]
        return at, (self.terms[at] == h) & (at < len(self.terms) - 1)


def counted(row: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, term and number of each distinct (row, term), ordered by both."""
    if not len(row):
        return row, term, np.zeros(0, np.int64)
    known = np.unique(term)
    key, n = np.unique(row * len(known) + Places(known).of(term)[0], return_counts=True)
    row, at = np.divmod(key, len(known))
    return row, known[at], n


def summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of n of each."""
    if not len(key):
        return key, n
    if n.max() < 1 << 16 and key.max() < 1 << 47:
        # Both in one number, as numbers alone are sorted fastest.
        both = np.sort(key << 16 | n)
        key, n = both >> 16, both & 0xFFFF
    else:
        order = np.argsort(key)
        key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    return key[first], np.add.reduceat(n, first)


def _spread(begin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """begin, begin + 1 and so on, n of each."""
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - begin, n)


def gram_counts(texts: list[str], low: int, high: int, known: Places | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, n-gram and number of each distinct (row, n-gram), ordered by both; the n-grams are those of Points.grams.

    The n-grams of each distinct word are made once. They are hashes, or their places among the known ones.
    """
    points = Points(texts)
    edges = np.diff(np.concatenate([[0], (points.points != 32).astype(np.int8), [0]]))
    start, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    h, first, word = np.unique(points.span(start, end), return_index=True, return_inverse=True)
    pair, n = np.unique(points.row(start) * max(len(h), 1) + word, return_counts=True)
    row, word = np.divmod(pair, max(len(h), 1))
    begin, size = start[first] - 1, end[first] - start[first] + 2
    owner, found = [], []
    for length in range(low, high + 1):
        windows = np.maximum(size - length + 1, 0)
        at = _spread(begin, windows)
        owner.append(np.repeat(np.arange(len(h)), windows))
        found.append(points.span(at, at + length))
    short = np.flatnonzero(size < low)
    owner, grams = np.concatenate([*owner, short]), np.concatenate([*found, points.span(begin[short], begin[short] + size[short])])
    if known is None:
        terms, at = np.unique(grams, return_inverse=True)
    else:
        terms = None
        at, has = known.of(grams)
        owner, at = owner[has], at[has]
    order = np.argsort(owner, kind="stable")
    at, per_word = at[order], np.bincount(owner, minlength=len(h))
    begin, times = np.cumsum(per_word) - per_word, per_word[word]
    width = max(len(known.terms) if terms is None else len(terms), 1)
    key, n = summed(np.repeat(row * width, times) + at[_spread(begin[word], times)], np.repeat(n, times))
    row, at = np.divmod(key, width)
    return row, at if terms is None else terms[at], n
