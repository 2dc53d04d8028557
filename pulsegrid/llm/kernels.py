"""Vectorised text kernels over the UTF-8 buffers of Arrow string columns.

Words are hashed with a rolling polynomial modulo 2^64 over random byte codes (prefix sums
give every word's value at once), so no Python object is made per word. Buffers are
handled in pieces of about ``PIECE`` bytes cut at white space; memory beyond the input is
a few times that, plus eight bytes a word, for texts of any length.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from ..workers import ship_by_value

PIECE = 1 << 20
_rng = np.random.default_rng(20240229)
BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BYTE_LOWER = BYTE.copy()
BYTE_LOWER[65:91] = BYTE[97:123]
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
SHINGLE = _rng.integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int, of: int) -> np.ndarray:
    p = np.full(n, of, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than there are rows) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type)
    column = column.fill_null("") if column.null_count else column
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    o = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[o[0]:o[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, o - o[0]


def slices(batches, rows: int = 1024):
    """The batches in slices of some rows: what is made of a slice is freed before the next."""
    for b in batches:
        for a in range(0, b.num_rows, rows):
            yield b.slice(a, rows)


def pieces(raw: np.ndarray, offsets: np.ndarray):
    """(from, to) cuts of the buffer of about PIECE bytes, at row starts or before white space that
    follows something else: a run of white space is never cut."""
    a = 0
    while a < len(raw):
        b = min(a + PIECE, len(raw))
        if b < len(raw):
            row = offsets[np.searchsorted(offsets, b)]
            while b < row:
                space = SPACE[raw[b - 1:min(b + 4096, row)]]
                gap = np.flatnonzero(space[1:] & ~space[:-1])
                if len(gap):
                    b += int(gap[0])
                    break
                b = min(b + 4096, int(row))
        yield a, b
        a = b


def runs(raw, offsets, lower: bool, lead: bool = False):
    """For each piece: (hash, start, end) of its words in order. ``lead``: a word takes the
    white space before it along (the rest of a row's white space is a word of its own)."""
    code = BYTE_LOWER if lower else BYTE
    up = down = np.zeros(0, np.uint64)
    for a, b in pieces(raw, offsets):
        x = raw[a:b]
        space = SPACE[x]
        first = np.zeros(len(x) + 1, bool)
        at = offsets[np.searchsorted(offsets, a):np.searchsorted(offsets, b, "right")] - a
        first[at] = True
        first[0] = True
        before = np.empty(len(x), bool)
        before[0] = True
        before[1:] = space[:-1]
        if lead:
            starts = np.flatnonzero(first[:-1] | (space & ~before))
            ends = np.append(starts[1:], len(x))
        else:
            starts = np.flatnonzero(~space & (before | first[:-1]))
            stop = np.empty(len(x) + 1, bool)
            stop[:-1] = space | first[:-1]
            stop[-1] = True
            ends = np.flatnonzero(stop[1:] & ~space) + 1
        if len(starts):
            if len(up) < len(x):
                up, down = powers(len(x) + 8192, BASE), powers(len(x) + 8192, INVERSE)  # pieces differ a little
            sums = np.zeros(len(x) + 1, np.uint64)
            np.cumsum(code[x] * up[:len(x)], out=sums[1:])
            h = (sums[ends] - sums[starts]) * down[starts]
            yield mix(h + (ends - starts).astype(np.uint64)), starts + a, ends + a


def word_hashes(raw: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words (A-Z as a-z if ``lower``), and the number of words before each row."""
    hashes, starts = [], []
    for h, s, _ in runs(raw, offsets, lower):
        hashes.append(h)
        starts.append(s)
    if not hashes:
        return np.zeros(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(hashes), np.searchsorted(np.concatenate(starts), offsets)


def shingles(words: np.ndarray, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles of one text; the whole text is one
    shingle if it has fewer words, and a text without words has none."""
    m = min(n, len(words))
    if not m:
        return words
    h = np.full(len(words) - m + 1, m, np.uint64)
    for j in range(m):
        h += words[j:len(words) - m + 1 + j] * SHINGLE[j]
    return np.unique(mix(h))


ship_by_value(__name__)
