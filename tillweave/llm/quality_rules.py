"""Quality rules: counted rules and a calibrated n-gram classifier, against fixed thresholds.

Features are hashed word unigrams and bigrams and trigrams of code points, each family averaged over the
text. A logistic regression is fitted on at most TRAIN_ROWS labelled documents in seeded order (the
documented bound) and calibrated by Platt scaling on a quarter of them that the fit did not see.
Scoring runs over Arrow batches; every text is counted and scored whole. A document fails the
rules with fewer than 50 words or more than half of its words in repeated three-word windows; the
rest is kept at a calibrated probability of KEEP or more.

Defined results: null or empty text has no words and fails; null labels do not train; a document
labelled twice counts once with its higher label and the smallest of its texts; with labels of one kind only, or none, every probability is that
kind's (or 1); rows that repeat a doc_id are each counted; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.llm import arrays as A
from tillweave.llm.shared import need, ship

ship(__name__)

#: Fixed thresholds.
MIN_WORDS, REPEAT_PERCENT, KEEP = 50, 50, 0.5
TRAIN_ROWS = 3000
WORD_BITS, CHAR_BITS = 18, 16
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


def features(buf: np.ndarray, offs: np.ndarray, s: np.ndarray, ptr: np.ndarray, h: np.ndarray):
    """(slot, row) pairs of the three families; a repeated word makes one bigram of its own."""
    mask = np.uint64((1 << WORD_BITS) - 1)
    uni = ((h >> np.uint64(20)) & mask).astype(np.int64)
    two, at = A.grams(h, ptr, 2)
    two[h[at] == h[at + 1]] = np.uint64(0x1234567)
    bi = ((two >> np.uint64(20)) & mask).astype(np.int64)
    tri, owner = character_trigrams(buf, offs)
    rows = A.owners(ptr)
    return (uni, rows), (bi, rows[at]), (tri, owner)


def character_trigrams(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the runs of three code points that lie within a row, and their rows."""
    first = np.flatnonzero((buf & 0xC0) != 0x80)
    code = buf[first].astype(np.uint32)
    size = np.diff(np.append(first, len(buf)))
    for k in (1, 2, 3):
        long = np.flatnonzero(size > k)
        code[long] |= buf[first[long] + k].astype(np.uint32) << np.uint32(8 * k)
    n = max(len(code) - 2, 0)
    word = code[:n].astype(np.uint64) * np.uint64(A.BASE) + code[1 : n + 1].astype(np.uint64)
    word = word * np.uint64(A.BASE) + code[2 : n + 2].astype(np.uint64)
    row = np.searchsorted(offs, first, "right") - 1
    inside = row[:n] == row[2 : n + 2]
    slot = (A.mix(word[inside]) >> np.uint64(64 - CHAR_BITS)).astype(np.int64)
    return slot, row[:n][inside]


def family_sizes() -> tuple[int, int, int]:
    return 1 << WORD_BITS, 1 << WORD_BITS, 1 << CHAR_BITS


def base_counts(buf, offs, s, e, ptr, h) -> dict[str, np.ndarray]:
    rows = len(offs) - 1
    chars = A.counts((buf & 0xC0) != 0x80, s, e)
    symbols = np.bincount(np.searchsorted(offs, np.flatnonzero(SYMBOLS[buf]), "right") - 1, minlength=rows)
    ls, le, lptr = A.lines(buf, offs)
    said = np.searchsorted(s, ls) < np.searchsorted(s, le)
    key = A.mix(A.segment_hashes(buf, ls, le)[said] + A.owners(lptr)[said].astype(np.uint64) * np.uint64(A.BASE))
    owner = A.owners(lptr)[said]
    _, first = np.unique(key, return_index=True)
    dup = np.bincount(owner, minlength=rows) - np.bincount(owner[first], minlength=rows)
    tri, at = A.grams(h, ptr, 3)
    key = A.mix(tri + A.owners(ptr)[at].astype(np.uint64) * np.uint64(A.BASE))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    cover = np.zeros(len(h) + 1, np.int32)
    np.add.at(cover, at[again], 1)
    np.add.at(cover, at[again] + 3, -1)
    return {
        "n_words": np.diff(ptr),
        "word_chars": A.sums(chars, ptr),
        "n_symbols": symbols,
        "n_dup_lines": dup,
        "n_repeat_words": A.sums((np.cumsum(cover[:-1]) > 0).astype(np.int64), ptr),
    }


def labelled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """doc_id, text, quality of at most `rows` labelled documents, in seeded order.

    A quarter of all labelled documents (crc32 of the id modulo 4 equal to 2) never trains."""
    need(labels, "doc_id", "quality")
    some = labels.filter("quality is not null and doc_id is not null and crc32(cast(cast(doc_id as string) as binary)) % 4 != 2")
    some = some.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    picked = some.orderBy(F.xxhash64(F.lit("train"), "doc_id"), "doc_id").limit(rows)
    met = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return met.groupBy("doc_id").agg(F.min("text").alias("text"), F.min("quality").alias("quality"))


def _train_batches(batches):
    sizes = family_sizes()
    for batch in batches:
        out_y, out_i, out_v = [], [], []
        y = batch.column("quality").to_numpy(zero_copy_only=False)
        for i, j, buf, offs in A.chunks(batch.column("text")):
            s, e, ptr = A.words(buf, offs)
            h = A.segment_hashes(buf, s, e)
            parts, base = [], 0
            for (slot, row), size in zip(features(buf, offs, s, ptr, h), sizes, strict=True):
                key, n = np.unique(row * size + slot, return_counts=True)
                total = np.bincount(row, minlength=j - i)
                parts.append((key // size, key % size + base, (n / total[key // size]).astype(np.float32)))
                base += size
            row = np.concatenate([p[0] for p in parts])
            order = np.argsort(row, kind="stable")
            slot, value = np.concatenate([p[1] for p in parts])[order].astype(np.int32), np.concatenate([p[2] for p in parts])[order]
            cut = np.searchsorted(row[order], np.arange(j - i + 1))
            for r in range(j - i):
                out_y.append(int(y[i + r]))
                out_i.append(slot[cut[r] : cut[r + 1]].tobytes())
                out_v.append(value[cut[r] : cut[r + 1]].tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(out_y, pa.int32()), pa.array(out_i, pa.binary()), pa.array(out_v, pa.binary())], ["y", "i", "v"])


def platt(score: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """a, b of the probability 1 / (1 + exp(-(a * score + b))), by Newton steps, halved where they would raise the loss."""
    target = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))

    def loss(p: np.ndarray) -> float:
        z = p[0] * score + p[1]
        return float((np.logaddexp(0, z) - target * z).sum() + 5e-4 * (p @ p))

    at = np.array([1.0, 0.0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(at[0] * score + at[1], -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - target) * score).sum(), (p - target).sum()]) + 1e-3 * at
        hess = np.array([[(w * score * score).sum() + 1e-3, (w * score).sum()], [(w * score).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
            step = step / 2
        at = at - step
    return float(at[0]), float(at[1])


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, steps: int = 120) -> dict:
    """Weights of the three families, bias and calibration; fitted on a bounded sample."""
    picked = labelled(docs, labels, rows).select("quality", "text").repartition(8)
    got = picked.mapInArrow(_train_batches, "y int, i binary, v binary").toArrow()
    y = got.column("y").to_numpy().astype(np.float64)
    size = sum(family_sizes())
    if len(y) < 20 or y.min() == y.max():
        p = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 1 - 1e-6
        return {"w": np.zeros(size, np.float32), "bias": 0.0, "a": 0.0, "b": float(np.log(p / (1 - p)))}
    slot = [np.frombuffer(x, np.int32) for x in got.column("i").to_pylist()]
    value = [np.frombuffer(x, np.float32) for x in got.column("v").to_pylist()]
    order = np.argsort([hash((int(a.sum()), len(a))) for a in slot], kind="stable")  # not the order of arrival
    fit, hold = order[len(order) // 4 :], order[: len(order) // 4]
    col, val = np.concatenate([slot[i] for i in fit]), np.concatenate([value[i] for i in fit]).astype(np.float64)
    ptr = np.concatenate(([0], np.cumsum([len(slot[i]) for i in fit])))
    row = A.owners(ptr)
    t = y[fit]
    weight = np.where(t > 0, len(t) / 2 / t.sum(), len(t) / 2 / max(len(t) - t.sum(), 1)) / len(t)
    w, bias = np.zeros(size), 0.0
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for k in range(1, steps + 1):
        z = A.sums(val * w[col], ptr) + bias
        d = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - t) * weight
        g = np.concatenate((np.bincount(col, val * d[row], size) + 1e-6 * w, [d.sum()]))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.5 * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-6)
        w, bias = w - step[:-1], bias - 0.2 * step[-1]
    score = np.array([(w[slot[i]] * value[i]).sum() + bias for i in hold])
    a, b = platt(score, y[hold]) if len({*y[hold]}) == 2 else (1.0, 0.0)
    return {"w": w.astype(np.float32), "bias": float(bias), "a": a, "b": b}


def scorer(model: dict, keep: float):
    sizes = family_sizes()

    def run(batches):
        w, starts = model["w"], np.concatenate(([0], np.cumsum(sizes)))
        for batch in batches:
            cols: dict[str, list] = {}
            for _i, j, buf, offs in A.chunks(batch.column("text")):
                rows = len(offs) - 1
                s, e, ptr = A.words(buf, offs)
                h = A.segment_hashes(buf, s, e)
                got = base_counts(buf, offs, s, e, ptr, h)
                z = np.full(rows, model["bias"])
                for k, (slot, row) in enumerate(features(buf, offs, s, ptr, h)):
                    z += np.bincount(row, w[starts[k] + slot], rows) / np.maximum(np.bincount(row, minlength=rows), 1)
                got["probability"] = 1 / (1 + np.exp(-np.clip(model["a"] * z + model["b"], -30, 30)))
                for name, x in got.items():
                    cols.setdefault(name, []).append(x)
            if not cols:
                continue
            c = {k: np.concatenate(x) for k, x in cols.items()}
            c["base_failed"] = (c["n_words"] < MIN_WORDS) | (100 * c["n_repeat_words"] > REPEAT_PERCENT * c["n_words"])
            c["kept"] = ~c["base_failed"] & (c["probability"] >= keep)
            kinds = {"probability": pa.float64(), "base_failed": pa.bool_(), "kept": pa.bool_()}
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "probability"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c[n], kinds.get(n, pa.int64())) for n in names)], ["doc_id", *names])

    return run


def quality(docs: DataFrame, model: dict, keep: float = KEEP) -> DataFrame:
    need(docs, "doc_id", "text")
    schema = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(scorer(model, keep), schema)
