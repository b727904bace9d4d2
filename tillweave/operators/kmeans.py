"""K-means of every category and every k at once: seeded starts, Lloyd rounds of one job each, silhouettes from cluster moments.

A model is a category with a number of clusters. Each round one job assigns all rows to the nearest centre of
every model of their category and sums rows, coordinates and squares by (model, cluster); the sums of all models,
categories x clusters x dimensions, pass the driver. Silhouettes are those of squared distances, which the
clusters' moments give for a row without meeting other rows.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillweave.functions.shipping import ship
from tillweave.operators.cells import random_rows_per_group

ship(__name__)

#: Rows of a category that its starts are chosen among; Lloyd rounds at most; movement below which centres stand still.
START_ROWS, ROUNDS, STILL = 256, 40, 1e-6


def starts(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k rows of a sample, each drawn with weight its squared distance to those before (fewer where the rest are equal)."""
    draw, out = np.random.default_rng(seed), [0]
    far = ((sample - sample[0]) ** 2).sum(axis=1)
    while len(out) < k and far.max() > 0:
        out.append(int(np.searchsorted(np.cumsum(far), draw.random() * far.sum(), "right").clip(0, len(sample) - 1)))
        far = np.minimum(far, ((sample - sample[out[-1]]) ** 2).sum(axis=1))
    return sample[out]


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The first of the nearest centres of each row."""
    return ((x**2).sum(axis=1)[:, None] - 2 * x @ centres.T + (centres**2).sum(axis=1)).argmin(axis=1)


def _rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column("features")
    return batch.column("no").to_numpy(), column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_category(no: np.ndarray, models: dict):
    for c in np.unique(no).tolist():
        at = np.flatnonzero(no == c)
        for k, centres in models.get(c, {}).items():
            yield c, k, at, centres


def moments(rows: DataFrame, models: dict[int, dict[int, np.ndarray]]) -> dict[tuple[int, int], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rows, coordinate sums and sums of squares of each cluster, by (category, k); one job."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            no, x = _rows(batch)
            for c, k, at, centres in _by_category(no, models):
                of, part = nearest(x[at], centres), x[at]
                one = np.zeros((len(centres), x.shape[1] + 2))
                np.add.at(one, of, np.concatenate((np.ones((len(at), 1)), part, (part**2).sum(axis=1)[:, None]), axis=1))
                total[c, k] = total.get((c, k), 0) + one
        keys = [(c, k, i, j) for (c, k), one in total.items() for i in range(one.shape[0]) for j in range(one.shape[1])]
        value = np.concatenate([one.ravel() for one in total.values()]) if total else np.zeros(0)
        yield pa.RecordBatch.from_arrays([*(pa.array([key[j] for key in keys], pa.int32()) for j in range(4)), pa.array(value)], ["no", "k", "i", "j", "value"])

    got = rows.select("no", "features").mapInArrow(run, "no int, k int, i int, j int, value double").groupBy("no", "k", "i", "j").agg(F.sum("value").alias("value")).collect()
    out = {(c, k): np.zeros((len(centres), centres.shape[1] + 2)) for c, held in models.items() for k, centres in held.items()}
    for r in got:
        out[r.no, r.k][r.i, r.j] = r.value
    return {key: (m[:, 0], m[:, 1:-1], m[:, -1]) for key, m in out.items()}


def silhouettes(rows: DataFrame, models: dict, found: dict) -> dict[tuple[int, int], float]:
    """The mean silhouette of squared distances, by (category, k); one job."""

    def run(batches):
        total: dict = {}
        for batch in batches:
            no, x = _rows(batch)
            for c, k, at, centres in _by_category(no, models):
                n, sums, squares = found[c, k]
                full = n > 0
                part, of = x[at], nearest(x[at], centres)
                d = (part**2).sum(axis=1)[:, None] + (squares / np.maximum(n, 1)) - 2 * part @ (sums / np.maximum(n, 1)[:, None]).T
                own = d[np.arange(len(at)), of] * n[of] / np.maximum(n[of] - 1, 1)
                d[:, ~full] = np.inf
                d[np.arange(len(at)), of] = np.inf
                other = d.min(axis=1)
                top = np.maximum(own, other)
                s = np.where((n[of] > 1) & (top > 0) & np.isfinite(other), (other - own) / np.where(top > 0, top, 1), 0.0)
                total[c, k] = total.get((c, k), 0) + s.sum()
        yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in total], pa.int32()), pa.array([k for _, k in total], pa.int32()), pa.array(list(total.values()), pa.float64())], ["no", "k", "value"])

    got = rows.select("no", "features").mapInArrow(run, "no int, k int, value double").groupBy("no", "k").agg(F.sum("value").alias("value")).collect()
    return {(r.no, r.k): r.value / found[r.no, r.k][0].sum() for r in got}


def fit(rows: DataFrame, key: str, ks: Sequence[int], seed: int) -> dict[int, dict[int, np.ndarray]]:
    """Centres by category number and k; rows have key, no and features."""
    held: dict[int, list] = {}
    for r in random_rows_per_group(rows.select(key, "no", "features"), ["no"], START_ROWS, key, seed).collect():
        held.setdefault(r["no"], []).append(r["features"])
    models = {c: {k: starts(np.array(sorted(x)), k, seed) for k in ks} for c, x in held.items()}
    moving = {c: dict(m) for c, m in models.items()}
    for _ in range(ROUNDS):
        if not moving:
            break
        found = moments(rows, moving)
        for (c, k), (n, sums, _) in found.items():
            old = models[c][k]
            new = np.where(n[:, None] > 0, np.round(sums / np.maximum(n, 1)[:, None], 12), old)
            models[c][k] = moving[c][k] = new
            if np.abs(new - old).max() < STILL:
                del moving[c][k]
        moving = {c: m for c, m in moving.items() if m}
    return models


def chosen(models: dict, found: dict, scores: dict, least: float, give_up: int) -> dict[int, np.ndarray]:
    """Per category the centres of the best silhouette whose clusters all have the least share of rows; none where no k has.

    ks are tried from the smallest on, until give_up of them in a row are rejected."""
    out = {}
    for c, held in models.items():
        best, fails = None, 0
        for k in sorted(held):
            n = found[c, k][0]
            if len(n) < k or n.min() < least * n.sum():
                fails += 1
                if fails >= give_up:
                    break
                continue
            fails = 0
            if best is None or scores[c, k] > best[0]:
                best = (scores[c, k], held[k])
        if best:
            out[c] = best[1]
    return out


def labelled(rows: DataFrame, centres: dict[int, np.ndarray]) -> DataFrame:
    """rows with segmentation: the nearest centre of their category, 0 where it has none."""
    schema = StructType([*rows.schema.fields, StructField("segmentation", IntegerType())])

    def run(batches):
        for batch in batches:
            no, x = _rows(batch)
            label = np.zeros(len(no), np.int32)
            for c in np.unique(no).tolist():
                if c in centres:
                    at = np.flatnonzero(no == c)
                    label[at] = nearest(x[at], centres[c])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(label)], [*batch.schema.names, "segmentation"])

    return rows.mapInArrow(run, schema)
