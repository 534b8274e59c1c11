"""Vectorised text kernels that run inside tasks: word boundaries, word hashes, rolling hashes.

Texts stay in their Arrow buffers; every kernel works on one slice of documents of
bounded bytes, so that a task's memory does not follow the size of its partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: ASCII white space: the separators of the word pattern [^\x20\x09-\x0D]+.
SPACES = b" \t\n\x0b\x0c\r"
SLICE_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15
BASE_2 = 0xD6E8FEB86659FD93


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the whole word."""
    x = x + np.uint64(0x9E3779B97F4A7C15 * (seed + 1) & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = BASE):
        self.base, self.n = base | 1, 0
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if self.n < n:
            self.n = max(n, 2 * self.n, 1 << 16)
            steps = np.full(self.n + 1, self.base, np.uint64)
            steps[0] = 1
            self.up = np.cumprod(steps, dtype=np.uint64)
            steps[1:] = pow(self.base, -1, 2**64)
            self.down = np.cumprod(steps, dtype=np.uint64)
        return self.up[:n], self.down[:n]


def spans_hash(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, powers: Powers, seed: int = 0) -> np.ndarray:
    """Hash of values[lo:hi] for every span; equal spans hash equally wherever they stand."""
    up, down = powers.upto(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], dtype=np.uint64, out=total[1:])
    return mix((total[hi] - total[lo]) * down[lo], seed)


def text_buffers(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and each row's start in them (one more at the end); null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64, len(column) + 1, 8 * column.offset)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, starts


def row_slices(starts: np.ndarray, limit: int = SLICE_BYTES):
    """Row ranges of at most ``limit`` bytes each, or of one longer row."""
    row, rows = 0, len(starts) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(starts, starts[row] + limit, "right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


def words_of(raw: np.ndarray, starts: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of rows lo..hi: their bytes, each word's start and end in them, and each row's first word (one more at the end)."""
    first = int(starts[lo])
    part = raw[first : int(starts[hi])]
    edges = (starts[lo : hi + 1] - first).astype(np.int64)
    space = np.zeros(256, bool)
    space[list(SPACES)] = True
    solid = ~space[part]
    begin = solid.copy()
    begin[1:] &= ~solid[:-1]
    inner = edges[:-1][edges[:-1] < len(part)]
    begin[inner] = solid[inner]
    stop = solid.copy()
    stop[:-1] &= ~solid[1:]
    last = edges[1:] - 1
    last = last[last >= 0]
    stop[last] = solid[last]
    word_lo, word_hi = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return part, word_lo, word_hi, np.searchsorted(word_lo, edges)


#: Places of a word whose mixed (byte, place) pairs are looked up; further ones are mixed as they come.
TABLE_PLACES = 256


def pair_table(seed: int) -> np.ndarray:
    """Strongly mixed values of all (place, byte) pairs of the first places."""
    return mix(mix(np.arange(TABLE_PLACES << 8, dtype=np.uint64), seed), seed + 1)


def _chunks(n: np.ndarray, limit: int = 1 << 18):
    """Ranges of spans of sizes ``n`` with about ``limit`` bytes each (or one larger span): bounds the arrays of one step."""
    ends = np.cumsum(n)
    at = 0
    while at < len(n):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


def _places(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each span starts in the concatenation of all, and each byte's place in its own span."""
    start = np.cumsum(n) - n
    return start, np.arange(int(n.sum())) - np.repeat(start, n)


def word_hashes(part: np.ndarray, word_lo: np.ndarray, word_hi: np.ndarray, table: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of every word: the sum of its (byte, place) pairs, each mixed on its own under ``seed``.

    Unlike a polynomial modulo 2**64 it has no words that collide by their pattern.
    """
    out, sizes = np.zeros(len(word_lo), np.uint64), word_hi - word_lo
    for a, b in _chunks(sizes):
        n = sizes[a:b]
        start, place = _places(n)
        pair = part[np.repeat(word_lo[a:b], n) + place] + (place << 8)
        far = np.flatnonzero(pair >= len(table))
        values = table[np.minimum(pair, len(table) - 1)]
        if len(far):
            values[far] = mix(mix(pair[far].astype(np.uint64), seed), seed + 1)
        out[a:b] = mix(np.add.reduceat(values, start) + n.astype(np.uint64), seed)
    return out


def same_spans(a: np.ndarray, a_lo: np.ndarray, b: np.ndarray, b_lo: np.ndarray, n: np.ndarray) -> bool:
    """Whether a[a_lo : a_lo + n] equals b[b_lo : b_lo + n], for every span (none empty)."""
    for x, y in _chunks(n):
        _, place = _places(n[x:y])
        if not np.array_equal(a[np.repeat(a_lo[x:y], n[x:y]) + place], b[np.repeat(b_lo[x:y], n[x:y]) + place]):
            return False
    return True


def windows(row_words: np.ndarray, width: int, n_words: int) -> np.ndarray:
    """First words of all windows of ``width`` words that lie within one row."""
    ok = np.zeros(n_words + 1, bool)
    full = np.diff(row_words) >= width
    at, to = row_words[:-1][full], row_words[1:][full] - width + 1
    steps = np.zeros(n_words + 1, np.int32)
    np.add.at(steps, at, 1)
    np.add.at(steps, to, -1)
    ok = np.cumsum(steps) > 0
    return np.flatnonzero(ok)
