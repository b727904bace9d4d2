"""Embedding whitening by the exact characteristic polynomial of the integer scatter.

Entries c become y = floor(64 * c), integers (x = y + SHIFT). Tasks sum y and y * y' exactly; with n rows the
scatter A = n * sum(y y') - S S' is an integer matrix, n**2 times the covariance. Its characteristic
polynomial comes from Hessenberg reductions modulo 31-bit primes, a Spark row per prime, joined by Chinese
remainders under a bound on the coefficients. All its roots are real, so the sign changes of its Taylor
shift at a count the roots above a exactly: they are isolated and bisected in integers to 64 significant bits.
Components solve (A - root) v = b until v stands still, in 256-bit fixed point, a Spark row per root; equal
roots share a task and are made orthogonal. Only d x d sums, coefficients and components pass the driver.

Defined results: a vector that is null, empty, or holds a null, NaN, infinity or an entry of 2**56 or more
is left out, as is one whose length is not the commonest (of equals the longest). Roots of zero give
no component, so equal or single vectors give no rows, nor does an empty table; at most `most` components.
A deviation beyond a long is null. Rows that repeat a vec_id are each whitened and each counted in the fit;
a null vec_id stays null. Extra columns are left out.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm.shared import need, ship

ship(__name__)

SHIFT, MOST, LARGEST = 1_000_000, 32, float(1 << 56)
LIMB, BLOCK = 60, 4096
DIGITS, SETTLED, ITERATIONS = 256, 100, 60  # bits after the point, bits of a component that stand still, and rounds at most
LONG = (1 << 63) - 1


def integers(column, d: int) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable, and their y as int64, row by row."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    value = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null is NaN
    bad = np.concatenate(([0], np.cumsum(~(np.abs(value) < LARGEST))))
    end = np.cumsum(size)
    keep = (size == d) & (bad[end] == bad[end - size])
    return keep, np.floor(64 * value[np.repeat(keep, size)]).astype(np.int64).reshape(-1, d)


def exact_product(y: np.ndarray) -> np.ndarray:
    """y' y in Python integers, by the quickest arithmetic that is exact."""
    top = int(np.abs(y).max()) if y.size else 0
    if len(y) * top * top < 1 << 53:
        f = y.astype(np.float64)
        return (f.T @ f).astype(np.int64).astype(object)
    return (y.T @ y).astype(object) if len(y) * top * top <= LONG else y.astype(object).T @ y.astype(object)


def scatterer(d: int):
    def run(batches):
        n, total, square = 0, np.zeros(d, object), np.zeros((d, d), object)
        for batch in batches:
            _, y = integers(batch.column("embedding"), d)
            for a in range(0, len(y), BLOCK):
                part = y[a : a + BLOCK]
                n, total, square = n + len(part), total + part.astype(object).sum(axis=0), square + exact_product(part)
        if n:
            i, j = np.triu_indices(d)
            value = [n, *total.tolist(), *square[i, j].tolist()]
            at_i, at_j = np.concatenate(([-2], np.full(d, -1), i)), np.concatenate(([-2], np.arange(d), j))
            hi, lo = [v >> LIMB for v in value], [v & ((1 << LIMB) - 1) for v in value]
            yield pa.RecordBatch.from_arrays([pa.array(at_i, pa.int32()), pa.array(at_j, pa.int32()), pa.array(hi, pa.int64()), pa.array(lo, pa.int64())], ["i", "j", "hi", "lo"])

    return run


def commonest_length(vectors: DataFrame) -> int:
    """Of the usable vectors' lengths; 0 where there is none."""
    fine = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < LARGEST))
    sizes = vectors.filter(F.coalesce(fine, F.lit(False))).groupBy(F.size("embedding").alias("d")).count().filter("d > 0")
    top = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    return top["d"] if top else 0


def scatter(vectors: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, S of y, and A."""
    parts = vectors.select("embedding").mapInArrow(scatterer(d), "i int, j int, hi long, lo long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    sums = {(r.i, r.j): (int(r.hi) << LIMB) + int(r.lo) for r in parts.groupBy("i", "j").agg(exact("hi"), exact("lo")).collect()}
    n, s = sums.get((-2, -2), 0), [sums.get((-1, j), 0) for j in range(d)]
    a = np.zeros((d, d), object)
    for i in range(d):
        for j in range(i, d):
            a[i, j] = a[j, i] = n * sums.get((i, j), 0) - s[i] * s[j]
    return n, s, a


def is_prime(p: int) -> bool:
    """Miller-Rabin with the bases that decide every 32-bit number."""
    if p % 2 == 0:
        return p == 2
    r = ((p - 1) & (1 - p)).bit_length() - 1
    for base in (2, 3, 5, 7):
        x = pow(base, (p - 1) >> r, p)
        if x in (0, 1, p - 1):
            continue
        for _ in range(r - 1):
            x = x * x % p
            if x == p - 1:
                break
        else:
            return False
    return True


def primes(bits: int) -> list[int]:
    """31-bit primes whose product has more than `bits` bits."""
    out, have, p = [], 1, 1 << 31
    while have.bit_length() <= bits + 1:
        p -= 1
        if is_prime(p):
            out.append(p)
            have *= p
    return out


def polynomial_modulo(a: np.ndarray, p: int) -> np.ndarray:
    """Coefficients of det(xI - a) modulo p, constant first: Hessenberg form, then its recurrence."""
    d = len(a)
    h = np.array([[v % p for v in row] for row in a.tolist()], np.int64).reshape(d, d)
    for m in range(1, d - 1):
        found = np.flatnonzero(h[m:, m - 1])
        if not len(found):
            continue
        i = m + int(found[0])
        if i != m:
            h[[i, m]] = h[[m, i]]
            h[:, [i, m]] = h[:, [m, i]]
        u = h[m + 1 :, m - 1] * pow(int(h[m, m - 1]), -1, p) % p
        h[m + 1 :] = (h[m + 1 :] - u[:, None] * h[m] % p) % p
        h[:, m] = (h[:, m] + (h[:, m + 1 :] * u % p).sum(axis=1)) % p
    poly = np.zeros((d + 1, d + 1), np.int64)
    poly[0, 0] = 1
    for k in range(d):
        poly[k + 1, 1:] = poly[k, :-1]
        poly[k + 1] = (poly[k + 1] - h[k, k] * poly[k] % p) % p
        chain = 1
        for i in range(k - 1, -1, -1):
            chain = chain * int(h[i + 1, i]) % p
            if not chain:
                break
            poly[k + 1] = (poly[k + 1] - (int(h[i, k]) * chain % p) * poly[i] % p) % p
    return poly[d]


def characteristic_polynomial(spark: SparkSession, a: np.ndarray) -> list[int]:
    """Integer coefficients of det(xI - a) for a symmetric matrix without negative roots, constant first."""
    d = len(a)
    trace = sum(int(a[i, i]) for i in range(d))
    moduli = primes((((d + trace) ** d) // d**d + 1).bit_length())  # each coefficient is at most (1 + trace / d) ** d

    def run(batches):
        for batch in batches:
            for p in batch.column("p").to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array([p]), pa.array([polynomial_modulo(a, p).tolist()], pa.list_(pa.int64()))], ["p", "residues"])

    rows = spark.createDataFrame(pa.table({"p": moduli})).repartition(max(1, len(moduli) // 8))
    residues = {r.p: r.residues for r in rows.mapInArrow(run, "p long, residues array<long>").collect()}
    out, product = [0] * (d + 1), 1
    for p in moduli:
        inverse = pow(product, -1, p)
        out = [x + product * ((r - x) * inverse % p) for x, r in zip(out, residues[p], strict=True)]
        product *= p
    return [x - product if 2 * x > product else x for x in out]


def roots_above(coefficients: list[int], at: int, bits: int) -> int:
    """How many roots, repeats counted, lie above at / 2**bits: sign changes after a Taylor shift (exact for real roots)."""
    d = len(coefficients) - 1
    c = np.array([v << (bits * (d - k)) for k, v in enumerate(coefficients)], object)
    for i in range(d):
        for k in range(d - 1, i - 1, -1):
            c[k] += at * c[k + 1]
    signs = [v > 0 for v in c if v]
    return sum(x != y for x, y in zip(signs, signs[1:], strict=False))


def sign_at(coefficients: list[int], at: int, bits: int) -> int:
    d, total = len(coefficients) - 1, 0
    for k in range(d, -1, -1):
        total = total * at + (coefficients[k] << (bits * (d - k)))
    return (total > 0) - (total < 0)


def isolated_roots(coefficients: list[int], most: int) -> list[tuple[int, int, int]]:
    """(z, bits, times) of the largest roots above 0: a root lies in (z, z + 1] / 2**bits; times counts those that 64 bits don't part."""
    while len(coefficients) > 1 and coefficients[0] == 0:
        coefficients = coefficients[1:]  # roots of zero
    d = len(coefficients) - 1
    if d == 0:
        return []
    bits, top = 32, 1
    while roots_above(coefficients, top << bits, bits):
        top *= 2
    out, found, waiting = [], 0, [(0, top << bits, bits, d, 0)]
    while waiting and found < most:
        lo, hi, bits, above_lo, above_hi = waiting.pop()  # the highest interval is last
        times = above_lo - above_hi
        if not times:
            continue
        if times == 1:
            while hi - lo > 1 or lo.bit_length() < 64:
                if hi - lo == 1:
                    lo, hi, bits = lo << 32, hi << 32, bits + 32
                mid = (lo + hi) // 2
                if sign_at(coefficients, mid, bits) == (-1 if above_hi % 2 == 0 else 1):
                    lo = mid  # one more root above mid than above hi
                else:
                    hi = mid
            out.append((lo, bits, 1))
            found += 1
            continue
        if hi - lo == 1 and lo.bit_length() >= 64:
            out.append((lo, bits, times))
            found += times
            continue
        if hi - lo == 1:
            lo, hi, bits = lo << 32, hi << 32, bits + 32
        mid = (lo + hi) // 2
        above = roots_above(coefficients, mid, bits)
        waiting += [(lo, mid, bits, above_lo, above), (mid, hi, bits, above, above_hi)]
    return out


def null_vectors(a: np.ndarray, z: int, bits: int, times: int) -> list[np.ndarray]:
    """Unit vectors that span the null space of a - root, by inverse iteration in fixed point."""
    d, one = len(a), DIGITS + bits
    m = np.array([[v << one for v in row] for row in a.tolist()], object).reshape(d, d)
    for i in range(d):
        m[i, i] -= (2 * z + 1) << (one - bits - 1)
    order = list(range(d))
    for k in range(d):  # LU with row exchanges
        i = k + max(range(d - k), key=lambda r: abs(m[k + r, k]))
        if i != k:
            m[[i, k]] = m[[k, i]]
            order[i], order[k] = order[k], order[i]
        if m[k, k] == 0:
            m[k, k] = 1
        if k + 1 < d:
            m[k + 1 :, k] = (m[k + 1 :, k] << one) // m[k, k]
            m[k + 1 :, k + 1 :] -= (m[k + 1 :, k][:, None] * m[k, k + 1 :][None, :]) >> one

    def solved(b: np.ndarray) -> np.ndarray:
        y = b[order].copy()
        for k in range(d):
            y[k + 1 :] -= (m[k + 1 :, k] * y[k]) >> one
        for k in range(d - 1, -1, -1):
            y[k] = (y[k] << one) // m[k, k]
            y[:k] -= (m[:k, k] * y[k]) >> one
        return y

    def unit(y: np.ndarray) -> np.ndarray:
        top = max(abs(v) for v in y) or 1
        y = np.array([(v << one) // top for v in y], object)
        length = math.isqrt(sum(v * v for v in y.tolist())) or 1
        return np.array([(v << one) // length for v in y], object)

    draw, out = np.random.default_rng(z % (1 << 32)), []
    for _ in range(times):
        v = np.array([int(x) << one for x in draw.choice([-1, 1], d)], object)
        for _ in range(ITERATIONS):
            before, v = v, unit(solved(v))
            for u in out:
                v = v - ((u * (int((u * v).sum()) >> one)) >> one)
            v = unit(v)
            if min(max(map(abs, (v - before).tolist())), max(map(abs, (v + before).tolist()))) >> (one - SETTLED) == 0:
                break
        out.append(v)
    return [np.array([to_float(int(x), one) for x in v]) for v in out]


def to_float(v: int, bits: int) -> float:
    """v / 2**bits, rounded once, whatever their sizes."""
    cut = max(abs(v).bit_length() - 64, 0)
    return float(v >> cut) * 2.0 ** (cut - bits)


def fit(vectors: DataFrame, most: int = MOST) -> dict:
    """d, n, S of y, root (of A), vector and share of the trace per component."""
    need(vectors, "embedding")
    spark, d = vectors.sparkSession, commonest_length(vectors)
    model = {"d": d, "n": 0, "s": [], "roots": np.zeros(0), "v": np.zeros((d, 0)), "share": np.zeros(0)}
    if d == 0:
        return model
    n, s, a = scatter(vectors, d)
    found = isolated_roots(characteristic_polynomial(spark, a), most)
    if not found:
        return model | {"n": n, "s": s}

    def run(batches):
        for batch in batches:
            for k in batch.column("k").to_pylist():
                for v in null_vectors(a, *found[k]):
                    yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([v.tolist()], pa.list_(pa.float64()))], ["k", "v"])

    rows = spark.range(len(found)).select(F.col("id").alias("k")).repartition(len(found))
    got = sorted((r.k, r.v) for r in rows.mapInArrow(run, "k long, v array<double>").collect())[:most]
    trace, halves = sum(int(a[i, i]) for i in range(d)), [(2 * found[k][0] + 1, found[k][1] + 1) for k, _ in got]
    return model | {
        "n": n, "s": s, "v": np.array([v for _, v in got]).T, "roots": np.array([to_float(z, bits) for z, bits in halves]),
        "share": np.array([to_float((z << 80) // trace, bits + 80) for z, bits in halves]),
    }


def centred(y: np.ndarray, model: dict) -> np.ndarray:
    """n * y - S, exact: int64 where that holds it, else Python integers."""
    top = (int(np.abs(y).max()) if y.size else 0) * model["n"] + max(map(abs, model["s"]), default=0)
    kind = np.int64 if top <= LONG else object
    return y.astype(kind) * model["n"] - np.array(model["s"], kind)


def whitener(model: dict):
    scale = model["v"] / np.sqrt(model["roots"])

    def deviations(t: np.ndarray) -> pa.Array:
        top = int(np.abs(t).max()) if t.size else 0
        if top * top * t.shape[1] <= LONG:
            return pa.array((t.astype(np.int64) ** 2).sum(axis=1), pa.int64())
        return pa.array([v if v <= LONG else None for v in (sum(int(x) ** 2 for x in row) for row in t)], pa.int64())

    def run(batches):
        k = scale.shape[1]
        for batch in batches:
            keep, y = integers(batch.column("embedding"), model["d"])
            ids = batch.column("vec_id").filter(pa.array(keep))
            for a in range(0, len(y), BLOCK):
                t = centred(y[a : a + BLOCK], model)
                m = len(t)
                at = np.repeat(np.arange(m), k)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.slice(a, m).take(pa.array(at)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(np.full(m * k, model["n"], np.int64)),
                        deviations(t).take(pa.array(at)), pa.array((t.astype(np.float64) @ scale).ravel()), pa.array(np.tile(model["share"], m)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained"],
                )

    return run


def covariance_error(vectors: DataFrame, model: dict) -> float:
    """The largest entry, by size, of the whitened rows' covariance minus the identity."""
    scale, k = model["v"] / np.sqrt(model["roots"]), len(model["roots"])

    def run(batches):
        n, total, square = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            _, y = integers(batch.column("embedding"), model["d"])
            for a in range(0, len(y), BLOCK):
                w = centred(y[a : a + BLOCK], model).astype(np.float64) @ scale
                n, total, square = n + len(w), total + w.sum(axis=0), square + w.T @ w
        if n:
            i, j = np.triu_indices(k)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate((np.full(k, -1), i)), pa.int32()), pa.array(np.concatenate((np.arange(k), j)), pa.int32()), pa.array(np.concatenate((total, square[i, j])))], ["i", "j", "value"]
            )

    sums = {(r.i, r.j): r.value / model["n"] for r in vectors.select("embedding").mapInArrow(run, "i int, j int, value double").groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}
    return max(abs(v - sums[-1, i] * sums[-1, j] - (i == j)) for (i, j), v in sums.items() if i >= 0)


def whiten(vectors: DataFrame, model: dict) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component."""
    need(vectors, "vec_id", "embedding")
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    if not len(model["roots"]):
        return vectors.sparkSession.createDataFrame([], schema + ", identity_error double")
    return rows.mapInArrow(whitener(model), schema).withColumn("identity_error", F.lit(covariance_error(vectors, model)))
