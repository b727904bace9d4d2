"""Texts of an Arrow batch as flat numpy arrays: words, lines, hashes and shingle sets.

A chunk is the UTF-8 bytes of some rows laid end to end, with the rows' offsets. Segments (words,
lines) are pairs of start and end arrays; no segment crosses a row. Null texts are empty rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from tillweave.llm.shared import kept, released, ship

ship(__name__)

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15 | 1
CHUNK_BYTES = 1 << 19


def table_of(seed: int, n: int = 256) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 1 << 63, n, dtype=np.uint64) * U64(2) + U64(1)


BYTE_HASH = table_of(11)
BLANK = np.zeros(256, bool)
BLANK[[32, 9, 10, 11, 12, 13]] = True
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2**64, at least n of each."""
    held = kept().get("powers")
    if held is None or len(held[0]) < n:
        held = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            steps = np.full(max(n, CHUNK_BYTES + 1), base, dtype=U64)
            steps[0] = 1
            held.append(np.cumprod(steps, dtype=U64))
        if n <= 4 * CHUNK_BYTES:
            kept()["powers"] = held
    return held[0], held[1]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def chunks(column, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) of runs of rows of about `most` bytes."""
    released()  # of the batch before
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    _, at, data = column.buffers()
    offsets = np.frombuffer(at, dtype=np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j, raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def words(buf: np.ndarray, offs: np.ndarray, blanks: np.ndarray = BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and where each row's words begin (one more than rows)."""
    blank = blanks[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[offs] = True
    start = ~blank
    start[1:] &= blank[:-1] | edge[1:-1]
    end = ~blank
    end[:-1] &= blank[1:] | edge[1:-1]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(s, offs)


def lines(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (without the newline) of lines and where each row's lines begin."""
    nl = np.flatnonzero(buf == 10)
    row = np.searchsorted(offs, nl, "right") - 1
    per = np.bincount(row, minlength=len(offs) - 1) + 1
    ptr = np.concatenate(([0], np.cumsum(per)))
    s = np.empty(ptr[-1], np.int64)
    first = np.zeros(ptr[-1], bool)
    first[ptr[:-1]] = True
    s[ptr[:-1]] = offs[:-1]
    s[~first] = nl + 1
    e = np.empty_like(s)
    e[:-1] = s[1:] - 1
    e[ptr[1:] - 1] = offs[1:]
    return s, e, ptr


def segment_hashes(buf: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """A mixed 64-bit polynomial hash of every segment's bytes, its length included."""
    p, q = powers(len(buf) + 1)
    total = np.zeros(len(buf) + 1, U64)
    np.cumsum(BYTE_HASH[buf] * p[: len(buf)], out=total[1:])
    return mix((total[e] - total[s]) * q[s] + (e - s).astype(U64) * U64(0xA24BAED4963EE407))


def owners(ptr: np.ndarray) -> np.ndarray:
    return np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))


def grams(h: np.ndarray, ptr: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the rows' runs of n segments and the index of each run's first segment."""
    if len(h) < n:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    k = len(h) - n + 1
    out = np.zeros(k, U64)
    for j in range(n):
        out += h[j : j + k] * U64((BASE * (2 * j + 3)) & 0xFFFFFFFFFFFFFFFF)
    last = np.repeat(ptr[1:], np.diff(ptr))[:k]
    at = np.flatnonzero(np.arange(k) + n <= last)
    return mix(out[at]), at


def shingle_sets(buf: np.ndarray, offs: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Each row's sorted distinct hashes of n lower-cased words (all words where it has fewer).

    Returns where each row's hashes begin, and the hashes."""
    buf = FOLD[buf]
    s, e, ptr = words(buf, offs)
    h = segment_hashes(buf, s, e)
    g, at = grams(h, ptr, n)
    row = owners(ptr)[at]
    count = np.diff(ptr)
    for c in range(1, n):
        few = np.flatnonzero(count == c)
        if len(few):
            one = np.full(len(few), c, U64)
            for j in range(c):
                one += h[ptr[few] + j] * U64((BASE * (2 * j + 3)) & 0xFFFFFFFFFFFFFFFF)
            g, row = np.concatenate((g, mix(one))), np.concatenate((row, few))
    order = np.lexsort((g, row))
    g, row = g[order], row[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (row[1:] != row[:-1])
    g, row = g[new], row[new]
    return np.searchsorted(row, np.arange(len(offs))), g


def sums(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sum of values in each row, empty rows included."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[ptr[1:]] - total[ptr[:-1]]


def counts(marks: np.ndarray, s: np.ndarray, e: np.ndarray) -> np.ndarray:
    """How many bytes that are marked lie in each segment."""
    total = np.zeros(len(marks) + 1, np.int32)
    np.cumsum(marks, out=total[1:], dtype=np.int32)
    return total[e] - total[s]


def strings(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
