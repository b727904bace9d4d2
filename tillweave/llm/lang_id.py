"""Language ID: nearest of several centroids per language, by cosine of TF-IDF n-gram vectors.

Grams are runs of one to three code points, ASCII and Latin-1 capitals folded and ASCII characters that are
no letters taken as blanks, hashed to 2**SLOT_BITS slots. A weight is
(1 + ln count) * idf; vectors have length 1. Document frequencies cover every training row. Centroids come
from at most SAMPLE_ROWS distinct rows of each language (the documented bound), drawn by hash: spherical
k-means, a task per language. A text has the language of its nearest centroid, and is rejected where
that cosine is below the language's floor (half of the first percentile of its training rows).

Defined results: null text, or text without a letter, is `und` with score 0; so is all where nothing can be
learned. Null lang never trains. Equal cosines go to the language that sorts first. Rows that repeat a
doc_id are each judged; a null doc_id trains. lang, source and doc_id are no inputs; extra columns are left out.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.llm import arrays as A
from tillweave.llm.shared import need, ship

ship(__name__)

SLOT_BITS, CENTROIDS, SAMPLE_ROWS, ROUNDS = 14, 4, 400, 25
SLOTS = 1 << SLOT_BITS
CHUNK = 1 << 16  # bytes of text worked on at a time: its arrays stay in the cache
UNKNOWN = "und"

ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
PLAIN = A.FOLD.copy()
PLAIN[:128][~ASCII_LETTER[:128]] = 32
#: A gram's slot is the top bits of the sum of its code points times these.
MULTIPLIERS = {n: A.table_of(30 + n, n) for n in (1, 2, 3)}


def held_out(key: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def grams(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """row * SLOTS + slot of every gram; grams across rows have the key rows * SLOTS."""
    lead = (buf & 0xC0) != 0x80
    first = np.flatnonzero(lead)
    code = PLAIN[buf[first]].astype(np.uint64)
    if len(first) < len(buf):
        size = np.diff(np.append(first, len(buf)))
        for k in (1, 2, 3):
            long = np.flatnonzero(size > k)
            code[long] |= buf[first[long] + k].astype(np.uint64) << np.uint64(8 * k)
        second = code >> np.uint64(8)
        code[((code & np.uint64(255)) == 0xC3) & (second >= 0x80) & (second <= 0x9E) & (second != 0x97)] += np.uint64(0x2000)
    count = A.counts(lead, offs[:-1], offs[1:])
    rows, begin = len(count), np.cumsum(count)
    base = np.repeat(np.arange(rows) << SLOT_BITS, count)
    if not len(code):
        return np.zeros(0, np.int64)
    keys = []
    for n in (1, 2, 3):
        k = max(len(code) - n + 1, 0)
        run = code[:k] * MULTIPLIERS[n][0]
        for j in range(1, n):
            run += code[j : j + k] * MULTIPLIERS[n][j]
        key = base[:k] + (run >> np.uint64(64 - SLOT_BITS)).view(np.int64)
        for j in range(1, n):  # grams that begin j before the end of a row
            at = begin - j
            key[at[(at >= 0) & (at < k)]] = rows << SLOT_BITS
        keys.append(key)
    return np.concatenate(keys)


def counted(key: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, slot and count of the distinct grams, in row order."""
    if rows * SLOTS <= 4 * len(key):
        every = np.bincount(key, minlength=rows * SLOTS)
        at = np.flatnonzero(every)
        n = every[at]
    else:
        at, n = np.unique(key, return_counts=True)
    inside = np.searchsorted(at, rows * SLOTS)
    at, n = at[:inside], n[:inside]
    return at >> SLOT_BITS, at & (SLOTS - 1), n


def vectors(buf: np.ndarray, offs: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, slot and weight; the weights of a row have length 1."""
    rows = len(offs) - 1
    row, slot, n = counted(grams(buf, offs), rows)
    w = (1 + np.log(n.astype(np.float32))) * idf[slot]
    norm = np.sqrt(np.bincount(row, w * w, rows))
    return row, slot, (w / norm[row]).astype(np.float32)


def frequencies(batches):
    """How many texts have each slot; the number of texts as slot -1."""
    n, total = np.zeros(SLOTS, np.int64), 0
    for batch in batches:
        for i, j, buf, offs in A.chunks(batch.column("text"), CHUNK):
            n += np.bincount(counted(grams(buf, offs), j - i)[1], minlength=SLOTS)
            total += j - i
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1), pa.int32()), pa.array(np.append(n[at], total))], ["slot", "n"])


def vectoriser(idf: np.ndarray):
    def run(batches):
        for batch in batches:
            slots, weights = [], []
            for i, j, buf, offs in A.chunks(batch.column("text"), CHUNK):
                row, slot, w = vectors(buf, offs, idf)
                cut = np.searchsorted(row, np.arange(j - i + 1))
                slots += [slot[cut[r] : cut[r + 1]].astype(np.int32).tobytes() for r in range(j - i)]
                weights += [w[cut[r] : cut[r + 1]].tobytes() for r in range(j - i)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(slots, pa.binary()), pa.array(weights, pa.binary())], ["lang", "slots", "weights"])

    return run


def clusterer(k: int):
    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        """The centroids of one language's sample, which holds at most the documented number of rows."""
        given = sorted((s, w) for s, w in zip(rows["slots"], rows["weights"], strict=True) if len(s))  # not the order of arrival
        x = np.zeros((len(given), SLOTS), np.float32)
        for i, (s, w) in enumerate(given):
            x[i, np.frombuffer(s, np.int32)] = np.frombuffer(w, np.float32)
        if not len(x):
            return pd.DataFrame({"lang": [], "centroid": [], "floor": []})
        seeds = [int(np.argmax(x @ x.mean(axis=0)))]
        near = x @ x[seeds[0]]
        while len(seeds) < min(k, len(x)) and near.min() < 0.999:
            seeds.append(int(np.argmin(near)))  # the farthest from all seeds so far
            near = np.maximum(near, x @ x[seeds[-1]])
        centre, of = x[seeds], None
        for _ in range(ROUNDS):
            now = np.argmax(x @ centre.T, axis=1)
            if of is not None and (now == of).all():
                break
            of = now
            centre = unit(np.stack([x[of == c].sum(axis=0) if (of == c).any() else centre[c] for c in range(len(centre))]))
        floor = 0.5 * float(np.quantile((x @ centre.T).max(axis=1), 0.01))
        return pd.DataFrame({"lang": rows["lang"].iloc[0], "centroid": [c.astype(np.float32).tobytes() for c in centre], "floor": floor})

    return run


def train(docs: DataFrame, rows: int = SAMPLE_ROWS, k: int = CENTROIDS) -> dict:
    """idf of the slots, and the languages' centroids with their floors."""
    need(docs, "doc_id", "text", "lang")
    known = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    got = known.select("text").mapInArrow(frequencies, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow().to_pydict()
    seen = dict(zip(got["slot"], got["n"], strict=True))
    df = np.array([seen.get(s, 0) for s in range(SLOTS)], np.float64)
    idf = np.log((seen.get(-1, 0) + 1) / (df + 1)) + 1
    share = known.groupBy("lang").agg((F.lit(2.0 * rows) / F.count("*")).alias("share"))
    # one row a language, for each of which the model holds whole centroids: far below any bound on a broadcast
    drawn = known.withColumn("draw", F.xxhash64(F.lit("centroids"), "doc_id", "text")).join(F.broadcast(share), "lang")
    drawn = drawn.filter(F.pmod("draw", F.lit(1 << 32)).cast("double") / float(1 << 32) < F.col("share"))
    once = drawn.groupBy("lang", "draw").agg(F.min("text").alias("text"))  # repeated rows count once
    few = once.withColumn("place", F.row_number().over(W.partitionBy("lang").orderBy("draw"))).filter(F.col("place") <= rows)
    sparse = few.select("lang", "text").mapInArrow(vectoriser(idf), "lang string, slots binary, weights binary")
    found = sparse.groupBy("lang").applyInPandas(clusterer(k), "lang string, centroid binary, floor double").toArrow().to_pydict()
    order = sorted(range(len(found["lang"])), key=lambda i: (found["lang"][i], found["centroid"][i]))
    return {
        "idf": idf, "lang": [found["lang"][i] for i in order], "floor": np.array([found["floor"][i] for i in order]),
        "centre": np.stack([np.frombuffer(found["centroid"][i], np.float32) for i in order], axis=1) if order else np.zeros((SLOTS, 0), np.float32),
    }


def lettered(column, buf: np.ndarray, offs: np.ndarray, i: int) -> np.ndarray:
    """Which rows of a chunk hold a letter; only rows without an ASCII letter are read character by character."""
    some = A.counts(ASCII_LETTER[buf], offs[:-1], offs[1:]) > 0
    for r in np.flatnonzero(~some & (A.counts(buf > 127, offs[:-1], offs[1:]) > 0)):
        some[r] = any(map(str.isalpha, column[i + int(r)].as_py() or ""))
    return some


def predictor(model: dict):
    def run(batches):
        names, floor, most = np.array(model["lang"], object), model["floor"], max(1, (1 << 22) // max(len(model["lang"]), 1))
        for batch in batches:
            texts, langs, scores, rejected = A.strings(batch.column("text")), [], [], []
            for i, j, buf, offs in A.chunks(texts, CHUNK):
                rows, alike = j - i, np.zeros((j - i, len(names)), np.float32)
                if len(names):
                    row, slot, w = vectors(buf, offs, model["idf"])
                    for a in range(0, len(row), most):
                        r = row[a : a + most]
                        part = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                        alike[r[part]] += np.add.reduceat(w[a : a + most, None] * model["centre"][slot[a : a + most]], part, axis=0)
                good = lettered(texts, buf, offs, i) & (len(names) > 0)
                best = alike.argmax(axis=1) if len(names) else np.zeros(rows, int)
                score = np.clip(alike[np.arange(rows), best], 0, 1).astype(np.float64) if len(names) else np.zeros(rows)
                langs += np.where(good, names[best] if len(names) else UNKNOWN, UNKNOWN).tolist()
                scores.append(np.where(good, score, 0.0))
                rejected.append(~good | (score < (floor[best] if len(names) else 1)))
            if langs:
                out = [pa.array(langs, pa.string()), pa.array(np.concatenate(scores)), pa.array(np.concatenate(rejected))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *out], ["doc_id", "lang_pred", "score", "rejected"])

    return run


def identify(docs: DataFrame, model: dict) -> DataFrame:
    """doc_id, lang_pred, score, rejected."""
    need(docs, "doc_id", "text")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predictor(model), "doc_id long, lang_pred string, score double, rejected boolean")
