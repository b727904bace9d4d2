"""Multi-document Burrows-Wheeler construction, column by column, over sequential files.

Round j inserts, for every string at once, the symbol that turns its suffix of length j - 1 into
the one of length j. The transform of all suffixes so far and their common prefixes lie in two files
(in memory up to IN_MEMORY bytes, beyond it on the executor's disk);
each round reads both from front to end, computes where the new suffixes fall (their rank among
equal symbols, as in backward search), and writes both anew with the insertions merged in. Common
prefixes follow from range minima between neighbouring equal symbols.
"""

from __future__ import annotations

import tempfile

import numpy as np

from tillweave.llm.shared import ship

ship(__name__)

BLOCK = 32
#: Bytes of the transform and of the prefixes up to which their files stay in memory.
IN_MEMORY = 8 << 20


def _put(file, x: np.ndarray) -> None:
    """Writes the file anew, from front to end."""
    file.seek(0)
    file.truncate()
    file.write(x.tobytes())


def _get(file) -> np.ndarray:
    file.seek(0)
    return np.frombuffer(file.read(), np.uint8)


def range_minima(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """min(x[lo : hi + 1]) for arrays of bounds, by block minima and a sparse table over blocks."""
    if not len(lo):
        return np.zeros(0, x.dtype)
    n = -(-len(x) // BLOCK)
    pad = np.full((n + 1) * BLOCK, 255, x.dtype)
    pad[: len(x)] = x
    levels = [pad[: n * BLOCK].reshape(n, BLOCK).min(axis=1)]
    while 2 * (1 << (len(levels) - 1)) <= n:
        half = 1 << (len(levels) - 1)
        levels.append(np.minimum(levels[-1][:-half], levels[-1][half:]))
    steps = np.arange(BLOCK)
    left = lo[:, None] + steps
    out = np.where(left <= hi[:, None], pad[left], 255).min(axis=1)
    right = hi[:, None] - steps
    out = np.minimum(out, np.where(right >= lo[:, None], pad[np.maximum(right, 0)], 255).min(axis=1))
    first, last = lo // BLOCK + 1, hi // BLOCK - 1
    wide = np.flatnonzero(last >= first)
    if len(wide):
        a, b = first[wide], last[wide]
        k = np.log2(b - a + 1 + 1e-9).astype(int)
        for level in np.unique(k):
            at = k == level
            m = np.minimum(levels[level][a[at]], levels[level][b[at] - (1 << level) + 1])
            out[wide[at]] = np.minimum(out[wide[at]], m)
    return out.astype(x.dtype)


def long_matches(buf: np.ndarray, start: np.ndarray, size: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes of at least `least` bytes of the strings buf[start : start + size] (sizes up to 254).

    Returns string, offset, and whether the suffix shares its first `least` bytes with another."""
    m = len(start)
    if not m:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)
    symbols = buf + np.uint8(1)  # UTF-8 has no byte 255; 0 ends a string
    with tempfile.SpooledTemporaryFile(IN_MEMORY) as transform, tempfile.SpooledTemporaryFile(IN_MEMORY) as prefixes:
        _put(transform, symbols[start + size - 1])
        _put(prefixes, np.zeros(m, np.uint8))
        at, tracked, names = np.arange(m), np.zeros(0, np.int64), []
        for j in range(1, int(size.max()) + 1):
            bwt, lcp = _get(transform), _get(prefixes)
            live = np.flatnonzero(size >= j)
            p = at[live]
            order = np.argsort(bwt, kind="stable")
            rank = np.empty(len(bwt), np.int64)
            rank[order] = np.arange(len(bwt))
            to = m + rank[p] - int((bwt == 0).sum())
            c = bwt[p]
            before, after = order[np.maximum(rank[p] - 1, 0)], order[np.minimum(rank[p] + 1, len(bwt) - 1)]
            has_before, has_after = (rank[p] > 0) & (bwt[before] == c), (rank[p] < len(bwt) - 1) & (bwt[after] == c)
            own = np.zeros(len(p), np.uint8)
            own[has_before] = range_minima(lcp, before[has_before] + 1, p[has_before]) + np.uint8(1)
            follow = range_minima(lcp, p[has_after] + 1, after[has_after]) + np.uint8(1)
            mask = np.zeros(len(bwt) + len(p), bool)
            mask[to] = True
            free = np.flatnonzero(~mask)
            new_bwt, new_lcp = np.empty(len(mask), np.uint8), np.empty(len(mask), np.uint8)
            new_bwt[free], new_lcp[free] = bwt, lcp
            left = size[live] - j
            new_bwt[to] = np.where(left > 0, symbols[start[live] + np.maximum(left - 1, 0)], 0)
            new_lcp[to] = own
            new_lcp[to[has_after] + 1] = follow
            _put(transform, new_bwt), _put(prefixes, new_lcp)
            at[live] = to
            tracked = free[tracked]
            if j >= least:
                tracked = np.concatenate((tracked, to))
                names.append(np.stack((live, left)))
        lcp = np.append(_get(prefixes), 0)
    string, offset = np.concatenate(names, axis=1) if names else np.zeros((2, 0), np.int64)
    return string, offset, (lcp[tracked] >= least) | (lcp[tracked + 1] >= least)
