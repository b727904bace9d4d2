"""Stateful assignment, distributed ranks, band steps, merges that write, histograms: against plain Python."""

import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.operators import cells as ce
from tillweave.operators import joins as jn
from tillweave.operators import metrics as mt
from tillweave.operators import ranks as rk
from tillweave.operators import rolling as rl
from tillweave.sources import sinks
from tillweave.sources.scratch import shared_folder, stored


def plan_lines(df):
    return len(df._jdf.queryExecution().optimizedPlan().toString().splitlines())


# ---- exclusive assignment
def test_thirty_categories_in_turn(spark):
    rng = random.Random(4)
    rows = sorted({(rng.randrange(400), f"c{rng.randrange(30):02d}") for _ in range(3000)})
    got = ce.sequential_exclusive(spark.createDataFrame(rows, "cust_id long, g string"), [f"c{i:02d}" for i in range(30)], 12, "g").collect()
    import hashlib

    place = lambda u: (hashlib.md5(f"7|{u}".encode()).hexdigest(), u)
    used, want = set(), set()
    for c in sorted({g for _, g in rows}):
        taken = sorted((u for u, g in rows if g == c and u not in used), key=place)[:12]
        used |= set(taken)
        want |= {(u, c) for u in taken}
    assert {(r.cust_id, r.g) for r in got} == want and len(got) == len(want) == len({r.cust_id for r in got})


def test_every_round_has_the_same_plan(spark):
    pools = stored(spark.range(500).select(F.col("id").alias("cust_id"), (F.col("id") % 9).cast("string").alias("g")))
    sizes, at = [], shared_folder(spark)
    for i in range(4):
        used = spark.read.schema("cust_id long, g string, round int").parquet(at) if i else None
        part = ce.exclusive_round(pools, used, str(i), 5, "g", "cust_id", 7)
        sizes.append(plan_lines(part))
        part.write.parquet(f"{at}/round={i}")
    assert len(set(sizes[1:])) == 1


def test_exclusive_categories_may_be_numbers_or_repeat(spark):
    d = spark.createDataFrame([(i, i % 2) for i in range(20)], "cust_id long, g int")
    got = ce.sequential_exclusive(d, [0, 1, 0], 3, "g").collect()
    assert Counter(r.g for r in got) == {0: 6, 1: 3} and len({r.cust_id for r in got}) == 9
    assert ce.sequential_exclusive(d, [7], 3, "g").count() == 0 and ce.sequential_exclusive(d, [], 3, "g").count() == 0


# ---- ranks
@pytest.mark.parametrize("descending", [False, True])
def test_ranks_with_ties_over_range_borders(spark, descending):
    """One item holds nearly all rows; values repeat, some are null or NaN-free extremes; ranges hold about ten values."""
    rng = random.Random(1)
    rows = [("hot", rng.choice([None, *range(-60, 60)])) for _ in range(3000)] + [("b", 5), ("b", 5), ("c", None), (None, 1), (None, 2)]
    d = spark.createDataFrame([(i, k, None if x is None else float(x)) for i, (k, x) in enumerate(rows)], "id long, k string, x double")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {r.id: r for r in rk.with_ranks(d, ["k"], "x", descending).withColumn("share", rk.percent_rank()).collect()}
        spread = {r["__p"] for r in d.groupBy("k", "x").count().repartitionByRange("k", "x").filter("k = 'hot'").select(F.spark_partition_id().alias("__p")).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(spread) > 5
    low = float("-inf")
    groups = defaultdict(list)
    for i, (k, x) in enumerate(rows):
        groups[k].append((low if x is None else x, i))
    for items in groups.values():
        values = sorted({x for x, _ in items}, reverse=descending)
        for x, i in items:
            earlier = sum((y > x) if descending else (y < x) for y, _ in items)
            assert (got[i].dense_rank, got[i].before, got[i].total) == (values.index(x) + 1, earlier, len(items))
            assert got[i].share == (earlier / (len(items) - 1) if len(items) > 1 else 0.0)


def test_rank_plans_have_no_window_over_a_group(spark):
    d = spark.createDataFrame([("a", 1.0), ("a", 2.0)], "k string, headroom double")
    plan = rl.headroom_rank(d, "k")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "windowspecdefinition" in line and "row_number" in line]
    assert windows and all("__range" in line for line in windows)


# ---- bands
def test_bands_by_brute_force(spark):
    rng = random.Random(9)
    bands = [(t, lo := rng.randrange(0, 90), lo + rng.randrange(1, 25), o, 1000 + o) for o, t in enumerate("ab" * 12)]
    spends = [(i, t, x) for i, (t, x) in enumerate((t, x) for t in "abz" for x in [None, -5.0, float("nan"), *[rng.uniform(-2, 130) for _ in range(150)], *map(float, range(0, 120, 3))])]
    d, b = spark.createDataFrame(spends, "k long, t string, s double"), spark.createDataFrame(bands, "t string, lo int, hi int, ord int, offer_id long")
    plain = lambda x, rows: max(((o, offer) for _, lo, hi, o, offer in rows if x is not None and lo <= x < hi), default=(None, None))[1]
    keyed = {r.k: r.offer_id for r in jn.offer_band_range(d, "s", b, ["t"]).collect()}
    assert keyed == {k: plain(x, [r for r in bands if r[0] == t]) for k, t, x in spends}
    whole = jn.offer_band_range(d, "s", b.filter("t = 'a'"))
    assert {r.k: r.offer_id for r in whole.collect()} == {k: plain(x, [r for r in bands if r[0] == "a"]) for k, _, x in spends}
    text = whole._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in text and "Aggregate" not in text.replace("aggregate(", "")
    assert {r.offer_id for r in jn.offer_band_range(d, "s", b.filter("false")).collect()} == {None}


# ---- merge
def test_merge_inserts_once_and_prunes(spark):
    path = shared_folder(spark)
    spark.createDataFrame([(1, 1, "old"), (2, 1, "old"), (3, 2, "old"), (9, 5, "old")], "id long, day int, v string").write.partitionBy("day").parquet(path)
    source = spark.createDataFrame([(2, 1, "new"), (4, 1, "b"), (4, 1, "a"), (3, 1, "new"), (7, 3, "new"), (None, 1, "new")], "id long, day int, v string")
    assert sinks.insert_new(source, path, ["id", "day"], "day") == 4
    rows = lambda: sorted(((r.id, r.day, r.v) for r in spark.read.parquet(path).collect()), key=str)
    want = sorted([(1, 1, "old"), (2, 1, "old"), (3, 2, "old"), (9, 5, "old"), (4, 1, "a"), (3, 1, "new"), (7, 3, "new"), (None, 1, "new")], key=str)
    assert rows() == want
    assert sinks.insert_new(source, path, ["id", "day"], "day") == 0 and rows() == want
    assert sinks.insert_new(source.filter("false"), path, ["id", "day"], "day") == 0
    with pytest.raises(ValueError):
        sinks.insert_new(source, path, ["id"], "day")
    with pytest.raises(ValueError):
        sinks.insert_new(source, path, ["id", "day"], "day", most=1)


def test_key_bits_lose_no_key(spark):
    keys = spark.range(3000).select((F.col("id") * 7).alias("a"), (F.col("id") % 5).cast("string").alias("b"))
    assert keys.filter(sinks.key_bits(keys, ["a", "b"], 14)).count() == 3000
    other = spark.range(3000).select((F.col("id") * 7 + 1).alias("a"), F.lit("x").alias("b"))
    assert other.filter(sinks.key_bits(keys, ["a", "b"], 20)).count() < 60
    assert other.filter(sinks.key_bits(keys.filter("false"), ["a", "b"])).count() == 0


# ---- histograms
def test_histogram_equals_numpy(spark):
    rng = np.random.default_rng(0)
    values = {"a": rng.gamma(2, 30, 500), "b": np.array([4.0, 4.0, 4.0]), "c": np.array([0.0, 10.0, 5.0])}
    d = spark.createDataFrame([(k, float(x)) for k, v in values.items() for x in v] + [("a", None), ("d", None)], "k string, x double")
    got = defaultdict(dict)
    for r in mt.histogram(d, ["k"], "x", 20).collect():
        got[r.k][r.bin] = r
    assert set(got) == {"a", "b", "c"}
    for k in ("a", "c"):
        n, edges = np.histogram(values[k], 20)
        assert [got[k][i].n_rows for i in range(20)] == n.tolist()
        assert np.allclose([got[k][i].lower for i in range(20)] + [got[k][19].upper], edges)
    assert [got["b"][i].n_rows for i in range(20)] == [3] + [0] * 19
    assert mt.histogram(d, [], "x", 3).count() == 3


def test_percentiles_of_large_groups_are_exact(spark):
    """Groups beyond the size at which percentile_approx is exact; nulls and a group without values."""
    rng = random.Random(5)
    values = {"a": [rng.randrange(1 << 40) for _ in range(40_000)], "b": [7, 7, 7, 9], None: list(range(20, 0, -1)), "none": [None]}
    rows = [(g, x) for g, xs in values.items() for x in [*xs, None]]
    shares = (0.0, 0.25, 0.5, 0.85, 0.97, 0.999, 1.0)
    got = {r.g: r.steps for r in rk.percentiles(spark.createDataFrame(rows, "g string, x long").repartition(5), ["g"], "x", shares).collect()}
    for g, xs in values.items():
        want = sorted(xs) if g != "none" else None
        assert got[g] == (want and [want[max(1, math.ceil(Fraction(str(s)) * len(want))) - 1] for s in shares])
