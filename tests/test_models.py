"""Factorisation, folds, moments and k-means: against numpy, hand-checked tables and the bias model."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.functions.hashing import uniform
from tillweave.operators import factors as fa
from tillweave.operators import kmeans as km
from tillweave.operators import segments as sg


def low_rank(seed, users, items, rank=3, noise=0.05, shift=0.0, fill=0.6):
    rng = np.random.default_rng(seed)
    true = rng.normal(size=(users, rank)) @ rng.normal(size=(rank, items)) + shift
    rows = [(u, f"i{i:02d}", float(true[u, i] + noise * rng.normal())) for u in range(users) for i in range(items) if rng.random() < fill]
    return true, rows


def table(spark, rows):
    return spark.createDataFrame(rows, "u long, i string, r double")


def test_factors_beat_the_bias_model_on_unseen_pairs(spark):
    true, rows = low_rank(0, 150, 20)
    seen = {(u, i) for u, i, _ in rows}
    error = {}
    for name, setting in (("bias", {"iterations": 0}), ("factors", {"rank": 5, "iterations": 12, "reg": 0.02})):
        got = fa.factorise(table(spark, rows), "u", "i", "r", **setting).collect()
        assert len(got) == 150 * 20
        error[name] = math.sqrt(np.mean([(r.prediction - true[r.u, int(r.i[1:])]) ** 2 for r in got if (r.u, r.i) not in seen]))
    assert error["factors"] < 0.4 * error["bias"]


def plain_als(rows, rank, iterations, reg, seed=7):
    import zlib

    users, items = sorted({r[0] for r in rows}), sorted({r[1] for r in rows})
    mu = np.mean([r[2] for r in rows])
    mean = lambda k, x: np.mean([r[2] for r in rows if r[k] == x])
    bias = {(u, i): mean(0, u) + mean(1, i) - mu for u in users for i in items}
    q = {i: np.random.default_rng(zlib.crc32(f"{seed}|{i}".encode())).normal(size=rank) / np.sqrt(rank) for i in items}

    def solve(side, other, k):
        out = {}
        for x in side:
            mine = [r for r in rows if r[k] == x]
            f = np.array([other[r[1 - k]] for r in mine])
            t = np.array([r[2] - bias[r[0], r[1]] for r in mine])
            out[x] = np.linalg.solve(f.T @ f + reg * len(mine) * np.eye(rank), f.T @ t)
        return out

    for _ in range(iterations):
        p = solve(users, q, 0)
        q = solve(items, p, 1)
    p = solve(users, q, 0)
    return {(u, i): bias[u, i] + p[u] @ q[i] for u in users for i in items}


def test_all_segments_at_once_equal_each_alone(spark):
    _, a = low_rank(1, 30, 6)
    _, b = low_rank(2, 25, 8, shift=4.0)
    rows = [(*r, "a") for r in a] + [(u + 1000, i, r, None) for u, i, r in b]
    d = spark.createDataFrame(rows, "u long, i string, r double, seg string")
    got = {(r.seg, r.u, r.i): r.prediction for r in fa.factorise(d, "u", "i", "r", segment="seg", rank=4, iterations=5).collect()}
    want = {("a", *k): v for k, v in plain_als(a, 4, 5, 0.1).items()} | {(None, u + 1000, i): v for (u, i), v in plain_als(b, 4, 5, 0.1).items()}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-8 for k in want)


def test_jobs_do_not_depend_on_segments_or_folds(spark):
    _, rows = low_rank(3, 40, 5)

    def jobs(segments, folds):
        d = spark.createDataFrame([(*r, r[0] % segments) for r in rows], "u long, i string, r double, seg long")
        spark.sparkContext.setJobGroup("count", "")
        data = fa.Ratings(d, "u", "i", "r", "seg", folds, 7)
        spark.sparkContext.setJobGroup(f"rounds{segments}.{folds}", "")
        fa.rounds(data, [fa.Model(data, {"rank": 3, "iterations": 4}, f if folds > 1 else None, 7) for f in range(folds)])
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"rounds{segments}.{folds}"))

    assert jobs(1, 1) == jobs(8, 1) == jobs(4, 3) > 0
    spark.sparkContext.setJobGroup("", "")


def test_nonnegative_factors(spark):
    rng = np.random.default_rng(5)
    true = rng.uniform(0, 1, (60, 2)) @ rng.uniform(0, 5, (2, 10))
    rows = [(u, f"i{i}", float(true[u, i])) for u in range(60) for i in range(10) if rng.random() < 0.7]
    data = fa.Ratings(table(spark, rows), "u", "i", "r", None, 1, 7)
    m = fa.Model(data, {"rank": 3, "iterations": 15, "reg": 0.001, "nonnegative": True}, None, 7)
    fa.rounds(data, [m])
    assert (m.q >= 0).all() and (m.q > 0).any()
    got = fa.predictions(data, m).collect()
    assert min(r.prediction for r in got) >= 0
    assert math.sqrt(np.mean([(r.prediction - true[r.u, int(r.i[1:])]) ** 2 for r in got])) < 0.15 * true.std()


def test_nonnegative_solution_is_the_best(spark):
    rng = np.random.default_rng(0)
    for _ in range(20):
        a, b = rng.normal(size=(8, 4)), rng.normal(size=8)
        x = fa.solved((a.T @ a)[None], (a.T @ b)[None], np.array([1]), 0.01, True)[0]
        assert np.allclose(fa.shared_nonnegative(a.T @ a + 0.01 * np.eye(4), np.stack([a.T @ b, a.T @ b])), x)
        grad = (a.T @ a + 0.01 * np.eye(4)) @ x - a.T @ b
        assert (x >= 0).all() and (grad > -1e-6).all() and (np.abs(grad[x > 1e-9]) < 1e-6).all()


def test_folds_by_hand(spark):
    """A bias model (no factors): each held-out row has its fold's training means."""
    rows = [(u, f"i{i}", float(3 * u + i + (u * i) % 2)) for u in range(8) for i in range(4) if (u + i) % 3] + [(99, "i9", 50.0)]
    d = table(spark, rows)
    fold = {(r.u, r.i): r.f for r in d.withColumn("f", F.least(F.floor(uniform(42, "u", "i") * 3), F.lit(2))).collect()}
    want = {}
    for f in range(3):
        train = [r for r in rows if fold[r[0], r[1]] != f]
        mean = lambda x, k=None, v=None: np.mean([r[2] for r in x if k is None or r[k] == v] or [np.nan])
        mu, errors = mean(train), []
        for u, i, y in (r for r in rows if fold[r[0], r[1]] == f):
            mean_u, mean_i = mean(train, 0, u), mean(train, 1, i)
            mean_u, mean_i = (mu if np.isnan(mean_u) else mean_u), (mu if np.isnan(mean_i) else mean_i)
            errors.append(mean_u + mean_i - mu - y)
        want[f] = (math.sqrt(np.mean(np.square(errors))), np.mean(np.abs(errors)))
    got = {r.fold: (r.rmse, r.mae) for r in fa.kfold(d, "u", "i", "r", iterations=0, run="x").collect()}
    assert set(got) == set(want) and all(np.allclose(got[f], want[f]) for f in want)
    half = fa.kfold(d, "u", "i", "r", iterations=0, sample=0.5).collect()
    assert 1 <= len(half) <= 3 and {r.fold: r.rmse for r in half} != {f: w[0] for f, w in want.items()}


def test_grid_search_prefers_factors_that_are_there(spark):
    _, rows = low_rank(6, 120, 15, rank=2)
    got = fa.grid_search(table(spark, rows), "u", "i", "r", [{"iterations": 0}, {"rank": 3, "maxIter": 8, "regParam": 0.02}, {"rank": 3, "maxIter": 8, "regParam": 50.0}]).collect()
    assert "0.02" in got[0].params and got[0].rmse < 0.6 * got[1].rmse and len(got) == 3


def test_faults_of_ratings(spark, monkeypatch):
    rows = [(1, "a", 2.0), (1, "a", 4.0), (1, "b", None), (2, None, float("nan")), (None, "b", 6.0)]
    got = {(r.u, r.i): r.prediction for r in fa.factorise(table(spark, rows), "u", "i", "r", iterations=0).collect()}
    assert set(got) == {(1, "a"), (1, "b"), (None, "a"), (None, "b")} and abs(got[1, "a"] - 2.0) < 1e-9
    assert fa.kfold(table(spark, rows).filter("false"), "u", "i", "r", rank=2, iterations=1).count() == 0
    monkeypatch.setattr(fa, "MAX_BYTES", 100)
    with pytest.raises(ValueError):
        fa.factorise(table(spark, [(1, "a", 1.0), (2, "b", 1.0)]), "u", "i", "r", rank=10, iterations=1)
    monkeypatch.setattr(fa, "MAX_SEGMENTS", 1)
    with pytest.raises(ValueError):
        fa.factorise(table(spark, [(1, "a", 1.0), (2, "b", 1.0)]), "u", "i", "r", segment="u", rank=1, iterations=1)


# ---- moments, components
def seg_table(spark, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for g, n in (("a", 80), ("b", 60), (None, 40)):
        x = rng.normal(size=(n, 3)) @ rng.normal(size=(3, 3)) + rng.normal(size=3) * 5
        rows += [(len(rows) + j, g, *map(float, v)) for j, v in enumerate(x)]
    rows += [(900, "one", 1.0, 2.0, 3.0), (901, "a", None, 1.0, 1.0), (902, "flat", 1.0, 5.0, 2.0), (903, "flat", 2.0, 5.0, 4.0)]
    return rows, spark.createDataFrame(rows, "cust_id long, g string, x double, y double, z double")


def test_components_per_category_equal_numpy(spark):
    rows, d = seg_table(spark)
    got = {r.cust_id: r for r in sg.reduced(d, ["x", "y", "z"], 2, "g").collect()}
    assert set(got) == {r[0] for r in rows} - {901}
    for g in {r[1] for r in rows}:
        part = [r for r in rows if r[1] == g and r[0] != 901]
        x = np.array([r[2:] for r in part])
        dev = x.std(axis=0, ddof=1) if len(x) > 1 else np.zeros(3)
        scaled = np.where(dev > 0, x / np.where(dev > 0, dev, 1), 0)
        assert np.allclose([got[r[0]].scaled for r in part], scaled)
        if len(x) > 2:
            value, v = np.linalg.eigh(np.cov(scaled.T))
            v = v[:, ::-1][:, :2]
            v = v * np.sign(v[np.abs(v).argmax(axis=0), [0, 1]])
            assert np.allclose([(got[r[0]].pca_0, got[r[0]].pca_1) for r in part], scaled @ v, atol=1e-6)


def test_whole_table_without_category(spark):
    _, d = seg_table(spark)
    x = np.array([(r.x, r.y, r.z) for r in d.dropna(subset=["x"]).orderBy("cust_id").collect()])
    got = sg.reduced(d, ["x", "y", "z"], 3).orderBy("cust_id").collect()
    scaled = x / x.std(axis=0, ddof=1)
    assert np.allclose([r.scaled for r in got], scaled)
    lengths = np.sort(np.array([[r.pca_0, r.pca_1, r.pca_2] for r in got]).std(axis=0, ddof=1) ** 2)
    assert np.allclose(lengths, np.linalg.eigvalsh(np.cov(scaled.T)))


# ---- k-means
def blobs(spark, groups, seed=3):
    rng, rows = np.random.default_rng(seed), []
    for no, centres in groups.items():
        for c in centres:
            rows += [(len(rows) + j, no, list(map(float, v))) for j, v in enumerate(rng.normal(size=(40, 2)) + np.array(c))]
    return rows, spark.createDataFrame(rows, "cust_id long, no int, features array<double>")


def test_kmeans_rounds_equal_numpy(spark):
    rows, d = blobs(spark, {0: [(0, 0), (6, 1), (1, 7)], 2: [(0, 0), (9, 9)]})
    models = km.fit(d, "cust_id", [2, 3], 7)
    for no in (0, 2):
        x = np.array([r[2] for r in rows if r[1] == no])
        for k in (2, 3):
            centres = km.starts(np.array(sorted(map(tuple, x))), k, 7)
            for _ in range(km.ROUNDS):
                of = ((x[:, None] - centres) ** 2).sum(axis=2).argmin(axis=1)
                new = np.array([x[of == j].mean(axis=0) for j in range(k)])
                if np.abs(new - centres).max() < km.STILL:
                    break
                centres = new
            assert np.allclose(models[no][k], new, atol=1e-6)


def test_silhouettes_equal_all_pairs(spark):
    from pyspark.ml.evaluation import ClusteringEvaluator
    from pyspark.ml.functions import array_to_vector

    rows, d = blobs(spark, {1: [(0, 0), (3, 1), (1, 4)]})
    models = km.fit(d, "cust_id", [2, 3], 7)
    found = km.moments(d, models)
    scores = km.silhouettes(d, models, found)
    for k in (2, 3):
        labels = km.labelled(d, {1: models[1][k]}).select(array_to_vector("features").alias("features"), F.col("segmentation").alias("prediction"))
        assert abs(scores[1, k] - ClusteringEvaluator().evaluate(labels)) < 1e-9
        x, of = np.array([r[2] for r in rows]), km.nearest(np.array([r[2] for r in rows]), models[1][k])
        pair, s = ((x[:, None] - x) ** 2).sum(axis=2), []
        for i in range(len(x)):
            mean = [pair[i, of == c].sum() / ((of == c).sum() - (c == of[i])) for c in range(k)]
            a, b = mean[of[i]], min(m for c, m in enumerate(mean) if c != of[i])
            s.append((b - a) / max(a, b))
        assert abs(scores[1, k] - np.mean(s)) < 1e-9


def test_rejection_stop_and_fallback():
    """k of 2, 3 ... with smallest shares as given: which is taken, by hand."""
    made = lambda shares: {k: (np.array([s * 1000, (1 - s) * 1000] + [400.0] * (k - 2)), None, None) for k, s in shares.items()}

    def take(shares, scores, give_up=2):
        sizes = made(shares)
        models = {0: {k: np.full((k, 1), float(k)) for k in shares}}
        got = km.chosen(models, {(0, k): v for k, v in sizes.items()}, {(0, k): scores[k] for k in shares}, 0.1, give_up)
        return len(got[0]) if got else 0

    assert take({2: 0.4, 3: 0.4, 4: 0.4}, {2: 0.3, 3: 0.7, 4: 0.7}) == 3  # the first of the best
    assert take({2: 0.4, 3: 0.01, 4: 0.4}, {2: 0.3, 3: 0.9, 4: 0.5}) == 4  # one rejected does not stop
    assert take({2: 0.4, 3: 0.01, 4: 0.01, 5: 0.4}, {2: 0.3, 3: 0.9, 4: 0.9, 5: 0.8}) == 2  # two in a row stop
    assert take({2: 0.01, 3: 0.01}, {2: 0.9, 3: 0.9}) == 0  # fallback


def test_starts_of_few_distinct_rows():
    assert len(km.starts(np.zeros((5, 2)), 3, 7)) == 1 and len(km.starts(np.array([[0.0], [0.0], [1.0]]), 3, 7)) == 2


def test_few_sets_of_items_need_no_job_a_round(spark):
    """Rounds over the sets of items give what rounds over the users give, in as many jobs for 40 rounds as for one."""
    _, rows = low_rank(6, 60, 4)
    fitted, jobs = {}, {}
    for most in (fa.MAX_SETS, 0):
        for iterations in (1, 40):
            data = fa.Ratings(table(spark, rows), "u", "i", "r", None, 3, 7)
            models = [fa.Model(data, {"rank": 6, "iterations": iterations}, f, 7) for f in range(3)]
            spark.sparkContext.setJobGroup(f"sets{most}.{iterations}", "")
            keep, fa.MAX_SETS = fa.MAX_SETS, most
            try:
                fa.rounds(data, models)
            finally:
                fa.MAX_SETS = keep
            jobs[most, iterations] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"sets{most}.{iterations}"))
            fitted[most, iterations] = np.stack([m.q for m in models])
    spark.sparkContext.setJobGroup("", "")
    assert jobs[fa.MAX_SETS, 1] == jobs[fa.MAX_SETS, 40] < jobs[0, 40]
    assert all(np.allclose(fitted[fa.MAX_SETS, i], fitted[0, i], atol=1e-7) for i in (1, 40))


def test_nonnegative_vectors_of_few_items():
    rng = np.random.default_rng(1)
    for k, signed in ((1, False), (3, False), (4, True)):
        x, t = rng.normal(size=(k, 20)), rng.normal(size=(200, k)) * 50
        x, t = (x, t) if signed else (np.abs(x), np.abs(t))
        want = fa.shared_nonnegative(x.T @ x + 0.1 * k * np.eye(20), t @ x)
        assert np.allclose(fa.nonnegative_of_few(x[None], np.zeros(200, int), np.tile(np.arange(k), (200, 1)), t, 0.1, 64), want, atol=1e-6)
