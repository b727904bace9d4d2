"""Neighbours by cells with bounds: the same as all pairs, and how few pairs are met."""

import math
import random

import numpy as np
import pytest
from test_operators import brute_knn

from tillweave.operators import cones, early
from tillweave.operators import models as mo


def people(seed, n, spread):
    """Some patterns, directions in bunches, negative and zero ratings, repeated users' ratings."""
    rng, rows = random.Random(seed), []
    kinds = [("abcd", [5, 9, 2, 7]), ("abc", [1, 8, 8]), ("ab", [3, 3]), ("d", [4]), ("cd", [-2, 6]), ("bd", [0, 1])]
    for u in range(n):
        items, centre = rng.choice(kinds)
        rows += [(u, i, round(c * rng.choice([1.0, 2.0, 2.0]) + rng.uniform(-spread, spread), 1)) for i, c in zip(items, centre, strict=True)]
    return rows


@pytest.mark.parametrize(("kind", "hot", "spread", "seed"), [("basic", 4, 0.0, 1), ("means", 6, 0.3, 2), ("zscore", 5, 3.0, 3), ("basic", 9, 1.0, 4)])
def test_cells_lose_no_neighbour(spark, kind, hot, spread, seed):
    rows = [(u, i, r + 20.0 if kind == "zscore" else r) for u, i, r in people(seed, 150, spread)]
    rows = [(u, i, r or 0.1) for u, i, r in rows]
    d = spark.createDataFrame(rows, "u long, i string, r double").repartition(3)
    got, want = {(x.u, x.i): x.prediction for x in mo.knn(d, "u", "i", "r", k=4, kind=kind, hot=hot).collect()}, brute_knn(rows, 4, kind)
    assert set(got) == set(want)
    wrong = [x for x in want if not (got[x] is not None and math.isclose(got[x], want[x], rel_tol=1e-6, abs_tol=1e-6))]
    assert not wrong, (len(wrong), [(x, got[x], want[x]) for x in wrong[:5]])


def test_too_many_patterns_meet_everyone(spark, monkeypatch):
    rows = people(5, 60, 1.0)
    rows = [(u, i, abs(r) + 0.5) for u, i, r in rows]
    d = spark.createDataFrame(rows, "u long, i string, r double")
    monkeypatch.setattr(cones, "MAX_PATTERNS", 2)
    got, want = {(x.u, x.i): x.prediction for x in mo.knn(d, "u", "i", "r", k=3, hot=8).collect()}, brute_knn(rows, 3, "basic")
    assert set(got) == set(want) and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)


def test_bounds_hold():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    of = np.floor(x * 2).astype(int) @ [1, 10, 100, 1000]
    names = sorted(set(of.tolist()))
    cells = [{"n": int((of == c).sum()), "items": (0, 1, 2, 3), "lo": x[of == c].min(axis=0), "hi": x[of == c].max(axis=0)} for c in names]
    boxes = cones.Boxes(cells, 4)
    for a, c in enumerate(names):
        _, least, most = boxes.bounds(a)
        for b, e in enumerate(names):
            cos = x[of == c] @ x[of == e].T
            assert least[b] - cones.MARGIN / 2 <= cos.min() and cos.max() <= most[b] + cones.MARGIN / 2


def test_few_pairs_are_met(spark):
    """Users who rate the same three items: a cell meets a small part, and four times the users hardly more cells a user."""
    share, sent = [], []
    for n in (10_000, 40_000):
        rng = np.random.default_rng(1)
        x = rng.gamma(2.0, 1.0, size=(n, 3)) + 0.05
        d = spark.createDataFrame([(u, [0, 1, 2], [(float(v), float(v)) for v in x[u]]) for u in range(n)], "u long, items array<int>, values array<struct<r:double,z:double>>")
        met = cones.meetings(d, "u", 5, 64, 3)
        leads = {r["block"]: r["count"] for r in met.filter("lead = 1").groupBy("block").count().collect()}
        seen = {r["block"]: r["count"] for r in met.filter("lead = 0").groupBy("block").count().collect()}
        assert sum(leads.values()) == n
        share.append(sum(leads[b] * seen[b] for b in leads) / n**2)
        sent.append(sum(seen.values()) / n)
    assert share[1] < 0.25 and share[1] < 0.5 * share[0] and sent[1] < 1.5 * sent[0]
    print("share of pairs met", share, "blocks a user is sent to", sent)


def test_copies_are_one_vector(spark, monkeypatch):
    """Forty copies of the same ratings: as many vectors are dealt out as ratings differ, and the results are those of all pairs."""
    rows = [(f"u{c:02d}-{u:02d}", i, abs(r) + 0.5) for u, i, r in people(7, 12, 1.0) for c in range(40)]
    dealt, meetings = [], cones.meetings
    monkeypatch.setattr(cones, "meetings", lambda vectors, *rest: dealt.append(vectors.count()) or meetings(vectors, *rest))
    got = {(x.u, x.i): x.prediction for x in mo.knn(spark.createDataFrame(rows, "u string, i string, r double"), "u", "i", "r", k=3, hot=4).collect()}
    want = brute_knn(rows, 3, "basic")
    assert dealt[0] <= 12 and set(got) == set(want) and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)


def shoppers(seed, n, items="abc", odd=0):
    """Users who rated some of the items, directions that recur now and then; the last `odd` rated all, the first of them below 0."""
    rng, rows = random.Random(seed), []
    for u in range(n):
        mine = items if u >= n - odd else [i for i in items if rng.random() < 0.6] or [rng.choice(items)]
        scale = rng.choice([0.5, 1.0, 3.0, rng.uniform(1, 9)])
        rows += [(f"u{u:04d}", i, (-1.0 if u >= n - odd and i == items[0] else 1.0) * scale * rng.choice([2.0, 6.0, 7.0, rng.uniform(1, 60)])) for i in mine]
    return rows


@pytest.mark.parametrize(("kind", "seed", "odd"), [("basic", 1, 0), ("means", 2, 0), ("zscore", 3, 0), ("basic", 4, 9)])
def test_users_at_cosine_one_need_no_cells(spark, monkeypatch, kind, seed, odd):
    """Where users who share one item are many, nobody is dealt into cells; the few of other signs still are, and the results are those of all pairs."""
    rows, led, meetings = shoppers(seed, 260, odd=odd), [], cones.meetings

    def counted(vectors, *rest):
        met = meetings(vectors, *rest)
        led.append((met.filter("lead = 1").count(), met.count()))
        return met

    monkeypatch.setattr(cones, "meetings", counted)
    d = spark.createDataFrame(rows, "u string, i string, r double").repartition(3)
    got, want = {(x.u, x.i): x.prediction for x in mo.knn(d, "u", "i", "r", k=4, kind=kind, hot=20).collect()}, brute_knn(rows, 4, kind)
    assert set(got) == set(want)
    wrong = [x for x in want if not (got[x] is not None and math.isclose(got[x], want[x], rel_tol=1e-9, abs_tol=1e-9))]
    assert not wrong, (len(wrong), [(x, got[x], want[x]) for x in wrong[:5]])
    assert not led if not odd else 0 < led[0][0] <= odd


@pytest.mark.parametrize("most", [0, 70, 30_000])
def test_users_beyond_the_early_ones_go_to_cells(spark, monkeypatch, most):
    """Which users are settled early is a matter of cost: the results are the same with none, with some and with all."""
    rows = shoppers(5, 150)
    monkeypatch.setattr(early, "MAX_EARLY", most)
    d = spark.createDataFrame(rows, "u string, i string, r double")
    got, want = {(x.u, x.i): x.prediction for x in mo.knn(d, "u", "i", "r", k=3, hot=20).collect()}, brute_knn(rows, 3, "basic")
    assert set(got) == set(want) and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)


def test_boxes_grow_coarser_rather_than_all_blocks_meet(spark, monkeypatch):
    """More boxes than cells are allowed: a coarser grid is taken, not every block sent everywhere."""
    rows = [(u, i, abs(r) + 0.5) for u, i, r in people(6, 200, 3.0)]
    monkeypatch.setattr(cones, "MAX_CELLS", 80)
    monkeypatch.setattr(early, "MAX_EARLY", 0)
    monkeypatch.setattr(cones, "_every_block", lambda *_: pytest.fail("all blocks meet"))
    d = spark.createDataFrame(rows, "u long, i string, r double")
    got, want = {(x.u, x.i): x.prediction for x in mo.knn(d, "u", "i", "r", k=3, hot=4).collect()}, brute_knn(rows, 3, "basic")
    assert set(got) == set(want) and all(math.isclose(got[x], want[x], rel_tol=1e-9) for x in want)


def test_no_ratings(spark):
    assert mo.knn(spark.createDataFrame([], "u long, i string, r double"), "u", "i", "r").collect() == []
