"""Quality classifier: a linear-chain conditional random field over a document's lines.

Every line is labelled good or bad from its own features and those of its neighbours; transitions
tie neighbouring labels. Training lines carry their document's label; at most TRAIN_ROWS labelled
documents train (the documented bound), drawn in seeded order, each with all its lines. A
document's score is the mean of its lines' forward-backward marginals of "good", weighted by their
length, so long texts are scored whole at two additions a line.

Defined results: null or empty text is one empty line and is scored like any; without labels of
both kinds every score is the share of label 1 (0.5 with none); rows that repeat a doc_id are each
scored; labels, lang, source and doc_id never reach the features; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import arrays as A
from tillweave.llm.quality_rules import labelled
from tillweave.llm.shared import need, ship

ship(__name__)

TRAIN_ROWS, ACCEPT = 3000, 0.7


def _marks(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


CLASSES = [
    _marks(bytes(range(65, 91))),
    _marks(bytes(range(97, 123))),
    _marks(bytes(range(128, 256))),
    _marks(b"0123456789"),
    _marks(b"|"),
    _marks(b"!?"),
    _marks(b"#*$%&<>@=_~^{}[]/\\"),
    _marks(b".,;:"),
]
WIDTH = len(CLASSES) + 6


def line_features(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features (lines x WIDTH), line lengths and where each row's lines begin."""
    ls, le, ptr = A.lines(buf, offs)
    size = (le - ls).astype(np.float64)
    s, e, _ = A.words(buf, offs)
    h = A.segment_hashes(buf, s, e)
    first, last = np.searchsorted(s, ls), np.searchsorted(s, le)
    n = (last - first).astype(np.float64)
    f = np.empty((len(ls), WIDTH), np.float32)
    for k, marks in enumerate(CLASSES):
        f[:, k] = A.counts(marks[buf], ls, le) / np.maximum(size if k < 4 else n, 1)
    again = np.zeros(len(h) + 1, np.int32)
    again[2:] = np.cumsum(h[1:] == h[:-1]) if len(h) > 1 else 0
    inner = np.where(n > 1, again[last] - again[np.minimum(first + 1, last)], 0)
    k = len(CLASSES)
    f[:, k] = inner / np.maximum(n - 1, 1)
    f[:, k + 1] = np.where(n > 0, size / np.maximum(n, 1) / 20, 0)
    f[:, k + 2] = np.log1p(n) / 6
    f[:, k + 3] = n == 0
    f[:, k + 4] = n == 1
    f[:, k + 5] = 1.0
    np.clip(f, 0, 3, out=f)
    return f, size + 1, ptr


def with_neighbours(f: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Own features, then the previous and the next line's (zero beyond the document)."""
    before, after = np.zeros_like(f), np.zeros_like(f)
    before[1:], after[:-1] = f[:-1], f[1:]
    before[ptr[:-1]], after[ptr[1:] - 1] = 0, 0
    return np.concatenate((f, before, after), axis=1)


def marginals(emit: np.ndarray, ptr: np.ndarray, trans: np.ndarray):
    """P(good) of every line, log Z of every row, and expected transition counts.

    emit: score of good over bad. Rows run in step, longest first, one numpy pass a line."""
    count = np.diff(ptr)
    order = np.argsort(-count, kind="stable")
    start, count = ptr[:-1][order], count[order]
    alive = np.searchsorted(-count, -np.arange(int(count[0]) + 1 if len(count) else 1), "left")  # rows longer than t
    fwd, back = np.zeros((len(emit), 2)), np.zeros((len(emit), 2))
    e2 = np.stack((np.zeros(len(emit)), emit), axis=1)
    fwd[start] = e2[start]
    for t in range(1, int(count[0]) if len(count) else 0):
        at = start[: alive[t]] + t
        prev = fwd[at - 1]
        fwd[at] = np.logaddexp(prev[:, :1] + trans[0], prev[:, 1:] + trans[1]) + e2[at]
    for t in range(int(count[0]) - 2 if len(count) else -1, -1, -1):
        at = start[: alive[t + 1]] + t
        nxt = back[at + 1] + e2[at + 1]
        back[at] = np.logaddexp(nxt[:, :1] + trans[:, 0], nxt[:, 1:] + trans[:, 1])
    tail = fwd[ptr[1:] - 1]
    z = np.logaddexp(tail[:, 0], tail[:, 1])
    both = fwd + back
    good = 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -60, 60)))
    inner = np.ones(len(emit), bool)
    inner[ptr[1:] - 1] = False
    at = np.flatnonzero(inner)
    zz = z[A.owners(ptr)[at]]
    pair = np.exp(fwd[at][:, :, None] + trans[None] + (back[at + 1] + e2[at + 1])[:, None, :] - zz[:, None, None]).sum(axis=0) if len(at) else np.zeros((2, 2))
    return good, z, pair


def _train_batches(batches):
    for batch in batches:
        y, out = batch.column("quality").to_numpy(zero_copy_only=False), []
        for i, j, buf, offs in A.chunks(batch.column("text")):
            f, size, ptr = line_features(buf, offs)
            out += [(int(y[i + r]), f[ptr[r] : ptr[r + 1]].tobytes()) for r in range(j - i)]
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["y", "f"])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, steps: int = 80) -> dict:
    """Emission weights and transitions, by Adam on the exact likelihood."""
    got = labelled(docs, labels, rows).select("quality", "text").repartition(8).mapInArrow(_train_batches, "y int, f binary").toArrow()
    pairs = sorted(zip(got.column("y").to_pylist(), got.column("f").to_pylist(), strict=True))  # not the order of arrival
    y = np.array([p[0] for p in pairs], np.float64)
    if len(y) < 2 or y.min() == y.max():
        p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 0.5
        flat = np.zeros(3 * WIDTH)
        return {"w": flat, "t": np.zeros((2, 2)), "bias": float(np.log(p / (1 - p)))}
    lines = [np.frombuffer(p[1], np.float32).reshape(-1, WIDTH) for p in pairs]
    ptr = np.concatenate(([0], np.cumsum([len(x) for x in lines])))
    f = with_neighbours(np.concatenate(lines), ptr).astype(np.float64)
    label = np.repeat(y, np.diff(ptr))
    links = np.diff(ptr) - 1
    seen = np.array([[links[y == 0].sum(), 0], [0, links[y == 1].sum()]], np.float64)
    w, t = np.zeros(f.shape[1]), np.zeros((2, 2))
    state = [np.zeros(len(w) + 4), np.zeros(len(w) + 4)]
    for k in range(1, steps + 1):
        good, _, pair = marginals(f @ w, ptr, t)
        g = np.concatenate(((good - label) @ f / len(y) + 1e-3 * w, ((pair - seen) / len(y) + 1e-2 * t).ravel()))
        state = [0.9 * state[0] + 0.1 * g, 0.99 * state[1] + 0.01 * g * g]
        step = 0.3 * (state[0] / (1 - 0.9**k)) / (np.sqrt(state[1] / (1 - 0.99**k)) + 1e-6)
        w, t = w - step[:-4], t - step[-4:].reshape(2, 2)
    return {"w": w, "t": t, "bias": 0.0}


def scorer(model: dict):
    def run(batches):
        for batch in batches:
            out = []
            for _i, _j, buf, offs in A.chunks(batch.column("text")):
                f, size, ptr = line_features(buf, offs)
                good, _, _ = marginals(with_neighbours(f, ptr) @ model["w"] + model["bias"], ptr, model["t"])
                out.append(A.sums(good * size, ptr) / A.sums(size, ptr))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.clip(np.concatenate(out), 0.0, 1.0))], ["doc_id", "score"])

    return run


def scores(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, score."""
    need(docs, "doc_id", "text")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scorer(model), "doc_id long, score double")


def row_filter(model: dict, column: str):
    """A mapInArrow function that keeps the rows, with all their columns, scored ACCEPT or more."""

    def run(batches):
        for batch in batches:
            good = [np.zeros(0, bool)]
            for _i, _j, buf, offs in A.chunks(batch.column(column)):
                f, size, ptr = line_features(buf, offs)
                p, _, _ = marginals(with_neighbours(f, ptr) @ model["w"] + model["bias"], ptr, model["t"])
                good.append(A.sums(p * size, ptr) / A.sums(size, ptr) >= ACCEPT)
            yield batch.filter(pa.array(np.concatenate(good)))

    return run


def accepted(docs: DataFrame, model: dict) -> DataFrame:
    """The rows of docs that the model accepts, columns unchanged."""
    return docs.mapInArrow(row_filter(model, "text"), docs.schema)
