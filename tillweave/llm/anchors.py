"""Content-chosen anchors of byte windows: which windows could repeat, found by one exchange.

Every window of WINDOW bytes holds WINDOW - GRAM + 1 grams; the leftmost of the least hash is its
anchor, so equal windows have the same anchor at the same place. The windows that share one anchor
position start in one run; the run's extent is all bytes they cover. Extents that are equal
byte for byte repeat as a whole; anchors found once cannot lie in a repeated window.
"""

from __future__ import annotations

import numpy as np

from tillweave.llm import arrays as A
from tillweave.llm.shared import ship

ship(__name__)

WINDOW, GRAM = 200, 64
POSITION_BITS = np.uint64(31)
ENTRY = np.dtype([("anchor", "<u8"), ("extent", "<u8"), ("doc", "<i8"), ("tie", "<i8"), ("lo", "<i4"), ("at", "u1"), ("run", "u1")])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of x[i : i + w] for every i, by doubling."""
    have = 1
    while 2 * have <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    rest = w - have
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def runs(buf: np.ndarray, offs: np.ndarray):
    """Anchor hash, row, anchor position, first and last window start of every run of windows."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < WINDOW:
        return none.astype(np.uint64), none, none, none, none
    p, q = A.powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(A.BYTE_HASH[buf] * p[:n], out=total[1:])
    h = A.mix((total[GRAM:] - total[:-GRAM]) * q[: n - GRAM + 1])
    key = (h >> POSITION_BITS << POSITION_BITS) | np.arange(len(h), dtype=np.uint64)
    low = (sliding_min(key, WINDOW - GRAM + 1) & ((np.uint64(1) << POSITION_BITS) - np.uint64(1))).astype(np.int64)
    stop = np.repeat(offs[1:], np.diff(offs))[: len(low)]
    start = np.flatnonzero(np.arange(len(low)) + WINDOW <= stop)
    if not len(start):
        return none.astype(np.uint64), none, none, none, none
    at = low[start]
    new = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (start[1:] != start[:-1] + 1))))
    lo, hi = start[new], start[np.append(new[1:], len(start)) - 1]
    return h[at[new]], np.searchsorted(offs, lo, "right") - 1, at[new], lo, hi
