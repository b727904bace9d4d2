"""Latent factors of all segments, settings and folds at once: alternating least squares over keyed Gram matrices.

A model is one setting on one set of training folds; every model has factors of each (segment, item). Users' rating
lists are written once. A round is one Spark job: tasks solve the vectors of their users for every model, given the
items' factors, and sum Gram matrices by (model, segment, item), which are added up and solved per key. Users' vectors
are never stored, and the number of jobs depends neither on segments nor on settings and folds. A user's vector is
linear in the ratings unless it must not be negative; so where few sets of items are rated, one job sums the products
of ratings per set, and the rounds need no user. What a model trains on comes from counts and sums per (segment, item, fold): a fold's training statistics are the totals less its own.

The items' factors of all models pass through the driver: items are product groups. More than MAX_ITEMS items,
MAX_SEGMENTS segments or MAX_BYTES of factors are an error.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tillweave.functions.hashing import uniform
from tillweave.functions.shipping import ship
from tillweave.sources.scratch import stored

ship(__name__)

MAX_ITEMS, MAX_SEGMENTS, MAX_BYTES = 100_000, 1000, 256 << 20
BLOCK, HELD, SWEEPS = 1 << 22, 64 << 20, 40
#: Sets of items rated together, items of a set, and numbers of all Gram matrices, up to which rounds go over sets instead of users.
MAX_SETS, MAX_LISTED, MAX_GRAMS = 2048, 32, 1 << 24

SETTING = {"rank": 50, "iterations": 30, "reg": 0.1, "nonnegative": False}


class Ratings:
    """Rating lists per user, and counts and sums per (segment, item, fold)."""

    def __init__(self, ratings: DataFrame, user: str, item: str, rating: str, segment: str | None, folds: int, seed: int):
        self.user, self.item, self.segment, self.folds = user, item, segment, folds
        fold = F.least(F.floor(uniform(seed, user, item) * folds), F.lit(folds - 1)).cast("int")
        known = ratings.select(F.col(segment) if segment else F.lit(0).alias("__segment"), user, item, F.col(rating).cast("double").alias("__r"), fold.alias("__fold"))
        known = known.filter("__r is not null and not isnan(__r)")
        known = known if segment in (user, item) else stored(known)
        of = segment or "__segment"
        self.items, self.segments = self._names(known, item, MAX_ITEMS), self._names(known, of, MAX_SEGMENTS)
        numbered = known
        for name, held, number in ((item, self.items, "__item"), (of, self.segments, "__of")):
            table = known.sparkSession.createDataFrame(pa.table({"__name": held, number: pa.array(range(len(held)), pa.int32())})) if len(held) else None
            if table is not None:  # at most MAX_ITEMS rows
                numbered = numbered.join(F.broadcast(table), F.col(name).eqNullSafe(F.col("__name"))).drop("__name")
            else:
                numbered = numbered.withColumn(number, F.lit(0))
        numbered = stored(numbered.select(F.col("__of"), user, "__item", "__r", "__fold"))
        self.schema = known.schema
        self.users = stored(numbered.groupBy("__of", user).agg(F.sort_array(F.collect_list(F.struct("__item", "__r", "__fold"))).alias("__rows")))
        shape = (max(len(self.segments), 1), max(len(self.items), 1), folds)
        self.n, self.sums = np.zeros(shape), np.zeros(shape)
        for r in numbered.groupBy("__of", "__item", "__fold").agg(F.count("*").alias("n"), F.sum(F.col("__r").cast("decimal(38,12)")).cast("double").alias("s")).collect():
            self.n[r["__of"], r["__item"], r["__fold"]], self.sums[r["__of"], r["__item"], r["__fold"]] = r["n"], r["s"]

    @staticmethod
    def _names(known: DataFrame, column: str, most: int) -> pa.Array:
        found = known.select(column).distinct().orderBy(column).limit(most + 1).toArrow().column(0).combine_chunks()
        if len(found) > most:
            raise ValueError(f"{column} has more than {most} values")
        return found


class Model:
    """A setting on all folds but one (None: on all)."""

    def __init__(self, data: Ratings, setting: dict, fold: int | None, seed: int):
        self.setting, self.fold = SETTING | setting, fold
        keep = [f for f in range(data.folds) if f != fold]
        self.n, sums = data.n[:, :, keep].sum(axis=2), data.sums[:, :, keep].sum(axis=2)
        total, all_sums = self.n.sum(axis=1), sums.sum(axis=1)
        self.mu = np.divide(all_sums, total, out=np.zeros_like(total), where=total > 0)
        self.mean = np.where(self.n > 0, np.divide(sums, self.n, out=np.zeros_like(sums), where=self.n > 0), self.mu[:, None])
        rank, size = self.setting["rank"], self.n.shape
        self.q = np.zeros((*size, rank))
        for i, name in enumerate(data.items.to_pylist()):  # the same start in every segment, setting and fold
            start = np.random.default_rng(zlib.crc32(f"{seed}|{name}".encode())).normal(size=rank) / np.sqrt(rank)
            self.q[:, i] = np.abs(start) if self.setting["nonnegative"] else start
        self.q[self.n == 0] = 0
        if self.setting["iterations"] == 0:  # the means alone
            self.q[:] = 0


class Part:
    """A batch of users as flat arrays."""

    def __init__(self, batch: pa.RecordBatch):
        rows = batch.column("__rows")
        size = rows.value_lengths().to_numpy(zero_copy_only=False)
        flat = rows.flatten()
        self.of, self.owner = batch.column("__of").to_numpy(), np.repeat(np.arange(len(size)), size)
        self.item, self.r, self.fold = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
        self.seg, self.users, self.sets = self.of[self.owner], len(size), {}

    def rated(self, fold: int | None) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray, np.ndarray]]]:
        """Training rows, the start of each user's, and the users by segment and set of items."""
        if fold not in self.sets:
            use = np.flatnonzero(self.fold != fold) if fold is not None else np.arange(len(self.r))
            cut = np.searchsorted(self.owner[use], np.arange(self.users + 1))
            n, found = np.diff(cut), []
            for k in np.unique(n[n > 0]).tolist():
                users = np.flatnonzero(n == k)
                rows = np.column_stack((self.of[users], self.item[use][cut[users][:, None] + np.arange(k)]))
                names, at = np.unique(rows, axis=0, return_inverse=True)
                order = np.argsort(at.ravel(), kind="stable")
                ends = np.cumsum(np.bincount(at.ravel(), minlength=len(names)))[:-1]
                found += [(int(x[0]), x[1:], users[o]) for x, o in zip(names, np.split(order, ends), strict=True)]
            self.sets[fold] = use, cut, found
        return self.sets[fold]


def grams(x: np.ndarray, t: np.ndarray, owner: np.ndarray, n: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Blocks of owners a to b with their sums of x x' and t x; owner is sorted."""
    rank = x.shape[1]
    per = max(1, BLOCK // (rank * rank))
    cut = np.searchsorted(owner, np.arange(n + 1))
    a = 0
    while a < n:
        b = max(a + 1, min(n, int(np.searchsorted(cut, cut[a] + per, "right")) - 1, a + per))
        g, v = np.zeros((b - a, rank, rank)), np.zeros((b - a, rank))
        if cut[b] > cut[a]:
            rows = slice(cut[a], cut[b])
            first = np.flatnonzero(np.r_[True, np.diff(owner[rows]) > 0])
            at = owner[rows][first] - a
            g[at] = np.add.reduceat(x[rows][:, :, None] * x[rows][:, None, :], first)
            v[at] = np.add.reduceat(x[rows] * t[rows][:, None], first)
        yield a, b, g, v
        a = b


def solved(g: np.ndarray, v: np.ndarray, n: np.ndarray, reg: float, nonnegative: bool) -> np.ndarray:
    """The ridge solution of each system, its weight growing with the number of ratings; by coordinates where it must not be negative."""
    rank = g.shape[1]
    g = g + (reg * np.maximum(n, 1))[:, None, None] * np.eye(rank)
    if not nonnegative:
        return np.linalg.solve(g, v[:, :, None])[:, :, 0]
    x, diagonal = np.zeros_like(v), np.einsum("nii->ni", g)
    for _ in range(SWEEPS):
        before = x.copy()
        for j in range(rank):
            x[:, j] = np.maximum(0, x[:, j] - (np.einsum("ni,ni->n", g[:, j], x) - v[:, j]) / diagonal[:, j])
        if np.abs(x - before).max(initial=0) < 1e-10:
            break
    return x


def shared_nonnegative(g: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The non-negative solution for each row of v of one system, by coordinates."""
    x = np.zeros_like(v)
    for _ in range(SWEEPS):
        before = x.copy()
        for j in range(len(g)):
            x[:, j] = np.maximum(0, x[:, j] - (x @ g[j] - v[:, j]) / g[j, j])
        if np.abs(x - before).max(initial=0) < 1e-10:
            break
    return x


def nonnegative_of_few(q: np.ndarray, of: np.ndarray, items: np.ndarray, t: np.ndarray, reg: float, per: int = 2048) -> np.ndarray:
    """The non-negative vectors of users who rated equally many items, few: the coordinate steps of solved, on what is left of t."""
    k, rank = items.shape[1], q.shape[2]
    out = np.empty((len(t), rank))
    for a in range(0, len(t), per):
        rows = slice(a, a + per)
        x = np.ascontiguousarray(q[of[rows, None], items[rows]].transpose(2, 1, 0))
        left = np.ascontiguousarray(t[rows].T)
        diagonal, p = (x * x).sum(axis=1) + reg * k, np.zeros((rank, left.shape[1]))
        for _ in range(SWEEPS):
            most = 0.0
            for j in range(rank):
                new = np.maximum(0, p[j] + ((x[j] * left).sum(axis=0) - reg * k * p[j]) / diagonal[j])
                change = new - p[j]
                left -= x[j] * change
                p[j] = new
                most = max(most, np.abs(change).max(initial=0))
            if most < 1e-10:
                break
        out[rows] = p.T
    return out


def user_vectors(part: Part, m: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's users: vectors, training means (the segment's where there is no rating), the training rows and their targets."""
    use, cut, sets = part.rated(m.fold)
    owner, seg, item, n = part.owner[use], part.seg[use], part.item[use], np.diff(cut)
    mean = np.where(n > 0, np.bincount(owner, part.r[use], part.users) / np.maximum(n, 1), m.mu[part.of] if part.users else 0)
    t = part.r[use] if m.setting["nonnegative"] else part.r[use] - (mean[owner] + m.mean[seg, item] - m.mu[seg])
    p = np.zeros((part.users, m.setting["rank"]))
    reg, nonnegative = m.setting["reg"], m.setting["nonnegative"]
    if 4 * len(sets) > part.users:
        for a, b, g, v in grams(m.q[seg, item], t, owner, part.users):
            p[a:b] = solved(g, v, n[a:b], reg, nonnegative)
    else:
        for of, items, users in sets:  # users of a segment who rated the same items share one matrix
            k, x = len(items), m.q[of, items]
            ts = t[cut[users][:, None] + np.arange(k)]
            if nonnegative:
                if k > x.shape[1]:
                    p[users] = shared_nonnegative(x.T @ x + reg * k * np.eye(x.shape[1]), ts @ x)
            else:
                p[users] = ts @ linear_map(x[None], reg)[0]
        for k in np.unique(n[(n > 0) & (n <= p.shape[1])]).tolist() if nonnegative else ():
            users = np.flatnonzero(n == k)
            at = cut[users][:, None] + np.arange(k)
            p[users] = nonnegative_of_few(m.q, part.of[users], item[at], t[at], reg)
    p[n == 0] = 0
    return p, mean, use, t


def linear_map(x: np.ndarray, reg: float) -> np.ndarray:
    """For sets of items (their vectors as rows of x) the matrix that takes ratings to the user's ridge solution."""
    k, rank = x.shape[1:]
    if k <= rank and reg > 0:
        return np.linalg.solve(x @ x.transpose(0, 2, 1) + reg * k * np.eye(k), x)
    return np.linalg.solve(x.transpose(0, 2, 1) @ x + reg * k * np.eye(rank), x.transpose(0, 2, 1)).transpose(0, 2, 1)


def predicted(m: Model, p: np.ndarray, mean: np.ndarray, known: np.ndarray, of: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Predictions of rows (one user and item each); known marks users that train. What is unknown has the means."""
    base, extra = mean + m.mean[of, item] - m.mu[of], np.einsum("ni,ni->n", p, m.q[of, item])
    if m.setting["nonnegative"]:
        return np.where(known & (m.n[of, item] > 0), extra, base)
    return base + extra


def products(data: Ratings, models: Sequence[Model]) -> dict | None:
    """By fold and number of items: segments, item sets and sums of t t' over the users who rated the set; None where there are too many sets."""
    of_fold = {m.fold: m for m in models}
    folds, width = list(of_fold), data.n.shape[1]

    def run(batches):
        held: dict = {}
        for batch in batches:
            part = Part(batch)
            for f, fold in enumerate(folds):
                m, (use, cut, sets) = of_fold[fold], part.rated(fold)
                for of, items, users in sets:
                    if len(items) > MAX_LISTED or len(held) > MAX_SETS:
                        yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([0], pa.int32()), pa.array([b""], pa.binary()), pa.array([b""], pa.binary())], ["fold", "of", "items", "sums"])
                        return
                    at = cut[users][:, None] + np.arange(len(items))
                    r = part.r[use][at]
                    t = r - (r.mean(axis=1)[:, None] + m.mean[of, items] - m.mu[of])
                    key = f, of, items.astype(np.int32).tobytes()
                    held[key] = held.get(key, 0) + t.T @ t
        keys = list(held)
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.binary()), pa.array([held[k].tobytes() for k in keys], pa.binary())], ["fold", "of", "items", "sums"])

    def added(key, group):
        sums = sorted(group.column("sums").to_pylist())  # not the order of arrival
        return pa.table({"fold": [key[0].as_py()], "of": [key[1].as_py()], "items": [key[2].as_py()], "sums": [np.sum([np.frombuffer(b) for b in sums], axis=0).tobytes()]}, schema=group.schema)

    kind = "fold int, of int, items binary, sums binary"
    parts = data.users.select("__of", "__rows").mapInArrow(run, kind)
    got = parts.groupBy("fold", "of", "items").applyInArrow(added, kind).limit(MAX_SETS + 1).collect()  # of at most MAX_LISTED ** 2 numbers each
    codes = {r["of"] * width + i for r in got for i in np.frombuffer(r["items"], np.int32).tolist()}
    if len(got) > MAX_SETS or any(r["fold"] < 0 for r in got) or len(codes) * max(m.setting["rank"] for m in models) ** 2 > MAX_GRAMS:
        return None
    out: dict = {fold: {} for fold in folds}
    for r in sorted(got, key=lambda r: (r["fold"], r["of"], r["items"])):
        items = np.frombuffer(r["items"], np.int32)
        out[folds[r["fold"]]].setdefault(len(items), []).append((r["of"], items, np.frombuffer(r["sums"]).reshape(len(items), -1)))
    return {f: [tuple(map(np.array, zip(*rows, strict=True))) for rows in sized.values()] for f, sized in out.items()}


def fit_by_sets(m: Model, sets: list) -> None:
    """All rounds of a model from the products of its sets of items."""
    rank, width, reg = m.setting["rank"], m.n.shape[1], m.setting["reg"]
    codes = np.unique(np.concatenate([(of[:, None] * width + items).ravel() for of, items, _ in sets])) if sets else np.zeros(0, np.int64)
    for _ in range(m.setting["iterations"] if len(codes) else 0):
        g, v = np.zeros((len(codes), rank, rank)), np.zeros((len(codes), rank))
        per = max(1, BLOCK // (rank * rank))
        for of, items, sums in sets:
            for a in range(0, len(of), per):
                at = np.searchsorted(codes, of[a : a + per, None] * width + items[a : a + per])
                x = linear_map(m.q[of[a : a + per, None], items[a : a + per]], reg)
                tx = sums[a : a + per] @ x
                own = x.transpose(0, 2, 1) @ tx
                for j in range(items.shape[1]):
                    np.add.at(g, at[:, j], own)
                    np.add.at(v, at[:, j], tx[:, j])
        m.q[codes // width, codes % width] = solved(g, v, m.n.reshape(-1)[codes], reg, False)


def rounds(data: Ratings, models: Sequence[Model]) -> None:
    """Fit all models: by sets of items where these are few and vectors may be negative; else each round is one job."""
    width = data.n.shape[1]
    if sum(m.q.nbytes for m in models) > MAX_BYTES:
        raise ValueError(f"the items' factors take more than {MAX_BYTES} bytes")

    def summer(active):
        def run(batches):
            held, used = {}, 0

            def rows():
                keys = list(held)
                return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([held[k].tobytes() for k in keys], pa.binary())], ["model", "code", "sums"])

            for batch in batches:
                part = Part(batch)
                for i, m in active:
                    p, _, use, t = user_vectors(part, m)
                    _, cut, sets = part.rated(m.fold)
                    if 4 * len(sets) <= part.users:
                        for of, items, users in sets:  # one Gram matrix for all items of a set
                            x = p[users]
                            g = (x.T @ x).ravel()
                            for j, one in enumerate(items.tolist()):
                                key, sums = (i, of * width + one), np.concatenate((g, t[cut[users] + j] @ x))
                                if key not in held:
                                    held[key], used = sums, used + sums.nbytes
                                else:
                                    held[key] += sums
                        continue
                    code = part.seg[use].astype(np.int64) * width + part.item[use]
                    order = np.argsort(code, kind="stable")
                    code, x, t = code[order], p[part.owner[use]][order], t[order]
                    begin = np.flatnonzero(np.r_[True, np.diff(code) > 0]) if len(code) else []
                    for a, b in zip(begin, [*begin[1:], len(code)], strict=True):
                        key, rows_ = (i, int(code[a])), slice(a, b)
                        one = np.concatenate(((x[rows_].T @ x[rows_]).ravel(), t[rows_] @ x[rows_]))
                        if key not in held:
                            held[key], used = one, used + one.nbytes
                        else:
                            held[key] += one
                if used > HELD:
                    yield rows()
                    held, used = {}, 0
            if held:
                yield rows()

        return run

    def solver(active):
        settings = {i: (m.setting, m.n) for i, m in active}

        def run(key, group):
            i, code = key[0].as_py(), key[1].as_py()
            setting, n = settings[i]
            rank = setting["rank"]
            total = np.sum([np.frombuffer(b) for b in sorted(group.column("sums").to_pylist())], axis=0)  # not the order of arrival
            q = solved(total[: rank * rank].reshape(1, rank, rank), total[rank * rank :][None], n.reshape(-1)[[code]], setting["reg"], setting["nonnegative"])
            return pa.table({"model": [i], "code": [code], "q": [q[0].tolist()]}, schema=pa.schema([("model", pa.int32()), ("code", pa.int32()), ("q", pa.list_(pa.float64()))]))

        return run

    linear = [m for m in models if not m.setting["nonnegative"] and m.setting["iterations"]]
    sets = products(data, linear) if linear else None
    by_users = [(i, m) for i, m in enumerate(models) if sets is None or m not in linear]
    for m in linear if sets is not None else ():
        fit_by_sets(m, sets[m.fold])
    for step in range(max((m.setting["iterations"] for _, m in by_users), default=0)):
        active = [(i, m) for i, m in by_users if step < m.setting["iterations"]]
        sums = data.users.select("__of", "__rows").mapInArrow(summer(active), "model int, code int, sums binary")
        for r in sums.groupBy("model", "code").applyInArrow(solver(active), "model int, code int, q array<double>").collect():
            models[r.model].q[r.code // width, r.code % width] = r.q


def predictions(data: Ratings, m: Model) -> DataFrame:
    """segment (if any), user, item, prediction: every user with every rated item of its segment."""
    items, segments, user, item_name = data.items, data.segments, data.user, data.item

    def run(batches):
        for batch in batches:
            part = Part(batch)
            p, mean, _, _ = user_vectors(part, m)
            rated = [np.flatnonzero(m.n[s] > 0) for s in range(m.n.shape[0])]
            per = max(1, BLOCK // max(m.q.shape[1] * m.q.shape[2], 1))
            for a in range(0, part.users, per):
                of = part.of[a : a + per]
                counts = np.array([len(rated[s]) for s in of])
                who, item = np.repeat(np.arange(a, a + len(of)), counts), np.concatenate([rated[s] for s in of])
                y = predicted(m, p[who], mean[who], np.ones(len(who), bool), part.of[who], item)
                yield pa.RecordBatch.from_arrays([segments.take(pa.array(part.of[who])), batch.column(user).take(pa.array(who)), items.take(pa.array(item)), pa.array(y)], ["__segment", user, item_name, "prediction"])

    kind = data.schema
    schema = StructType([StructField("__segment", kind[data.segment or "__segment"].dataType), kind[user], kind[data.item], StructField("prediction", DoubleType())])
    out = data.users.mapInArrow(run, schema)
    return out.withColumnRenamed("__segment", data.segment) if data.segment else out.drop("__segment")


def held_out_errors(data: Ratings, models: Sequence[Model]) -> dict[int, tuple[float, float, int]]:
    """Per model RMSE, MAE and rows of its held-out fold, every row of it counted; one job for all."""

    def run(batches):
        total = np.zeros((len(models), 3))
        for batch in batches:
            part = Part(batch)
            for i, m in enumerate(models):
                p, mean, use, _ = user_vectors(part, m)
                at = np.flatnonzero(part.fold == m.fold)
                known = np.bincount(part.owner[use], minlength=part.users) > 0
                e = predicted(m, p[part.owner[at]], mean[part.owner[at]], known[part.owner[at]], part.seg[at], part.item[at]) - part.r[at]
                total[i] += (e @ e, np.abs(e).sum(), len(e))
        yield pa.RecordBatch.from_arrays([pa.array(range(len(models)), pa.int32()), *(pa.array(total[:, k]) for k in range(3))], ["model", "se", "ae", "n"])

    got = data.users.select("__of", "__rows").mapInArrow(run, "model int, se double, ae double, n double").groupBy("model").agg(*(F.sum(c).alias(c) for c in ("se", "ae", "n"))).collect()
    return {r.model: (float(np.sqrt(r.se / r.n)), r.ae / r.n, int(r.n)) for r in got if r.n}


def factorise(ratings: DataFrame, user: str, item: str, rating: str, segment: str | None = None, seed: int = 7, **setting) -> DataFrame:
    """user, item, prediction (and segment): every user with every item rated in its segment; null is a segment.

    Without nonnegative the residuals of the segment's bias model are factorised and its prediction added. Null and NaN
    ratings are left out; without ratings there are no rows."""
    data = Ratings(ratings, user, item, rating, segment, 1, seed)
    m = Model(data, setting, None, seed)
    rounds(data, [m])
    return predictions(data, m)


def sampled(ratings: DataFrame, user: str, item: str, share: float | None, seed: int) -> DataFrame:
    """A keyed-random share of the rows."""
    return ratings if share is None else ratings.filter(uniform(seed + 1, user, item) < share)


def kfold(ratings: DataFrame, user: str, item: str, rating: str, k: int = 3, seed: int = 42, run: str = "", sample: float | None = None, segment: str | None = None, **setting) -> DataFrame:
    """fold, rmse, mae, run: each fold of rows held out from a model of the others, all folds fitted at once.

    sample takes a share of the rows first. A held-out row whose user or item is not in the other folds has the item's
    mean, the user's, or the mean of its segment; a fold without rows has no line."""
    data = Ratings(sampled(ratings, user, item, sample, seed), user, item, rating, segment, k, seed)
    models = [Model(data, setting, f, seed) for f in range(k)]
    rounds(data, models)
    rows = [(f, rmse, mae, run) for f, (rmse, mae, _) in sorted(held_out_errors(data, models).items())]
    return ratings.sparkSession.createDataFrame(rows, "fold int, rmse double, mae double, run string")


def grid_search(ratings: DataFrame, user: str, item: str, rating: str, grid: Sequence[dict], k: int = 3, seed: int = 42, sample: float | None = None, segment: str | None = None) -> DataFrame:
    """params, rmse at each setting, averaged over k folds of rows; smallest first. All settings and folds are fitted at once."""
    data = Ratings(sampled(ratings, user, item, sample, seed), user, item, rating, segment, k, seed)
    names = {"maxIter": "iterations", "regParam": "reg"}
    models = [Model(data, {names.get(x, x): v for x, v in params.items()}, f, seed) for params in grid for f in range(k)]
    rounds(data, models)
    errors = held_out_errors(data, models)
    rows = []
    for g, params in enumerate(grid):
        found = [errors[g * k + f][0] for f in range(k) if g * k + f in errors]
        if found:
            rows.append((str(sorted(params.items())), float(sum(found) / len(found))))
    return ratings.sparkSession.createDataFrame(sorted(rows, key=lambda r: (r[1], r[0])), "params string, rmse double")
