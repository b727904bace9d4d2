"""Totals kept from day to day and sketches kept by week: against plain Python."""

import os
import random
from collections import Counter, defaultdict
from datetime import date, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillweave.operators import daily as dy
from tillweave.operators import sketches as sk
from tillweave.sources.scratch import shared_folder, stored

LINES = "cust_id long, g string, basket_id long, sales_amt decimal(12,2), item_qty int, date int"
END = date(2001, 3, 1)


def number(d):
    return int(d.strftime("%Y%m%d"))


def history(rng, n, days):
    """Lines of the last days; a basket lies within one day. Nulls in keys and measures, negative amounts, repeated rows."""
    out = []
    for i in range(n):
        d = END - timedelta(days=rng.randrange(days))
        row = (rng.choice([1, 2, 3, 4, None]), rng.choice(["a", "b", None]), i // 2 * 1000 + d.day, Decimal(rng.randrange(-200, 9000)) / 100 if rng.random() < 0.9 else None, rng.choice([None, 1, 2, 5]), number(d))
        out += [row] * rng.choice([1, 1, 2])
    return out


def totals(rows, as_of, horizon, slot):
    got = defaultdict(lambda: [Decimal(0), 0, 0, set()])
    for cust, g, basket, amount, qty, d in rows:
        day = date(d // 10000, d // 100 % 100, d % 100)
        if 0 <= (as_of - day).days <= horizon:
            t = got[cust, g, slot(day)]
            t[0] += amount or 0
            t[1] += qty or 0
            t[2] += 1
            t[3].add((basket, d))
    return {k: (t[0], t[1], t[2], len(t[3])) for k, t in got.items()}


def found(df, slot):
    rows = df.collect()
    out = {(r.cust_id, r.g, r[slot]): (r.spend, r.units, r.n_lines, r.baskets) for r in rows}
    assert len(out) == len(rows)
    return out


def files(path):
    return {f"{at}/{n}": os.stat(f"{at}/{n}").st_mtime_ns for at, _, names in os.walk(path.removeprefix("file://")) for n in names if n.endswith(".parquet")}


def new_store(spark, **how):
    return dy.Store(spark, shared_folder(spark), {"cust_id": "bigint", "g": "string"}, week_one=20001204, **how)


@pytest.mark.parametrize(("horizon", "length", "by"), [(20, 7, 1), (23, 6, 2), (13, 7, 5)])
def test_steps_equal_a_full_recount(spark, horizon, length, by):
    """13 days and windows of 7: the day that expires is one that would change its window as well."""
    rows = history(random.Random(horizon), 400, horizon + 12)
    lines = stored(spark.createDataFrame(rows, LINES))
    store = new_store(spark, horizon=horizon, length=length)
    at = [END - timedelta(days=10 - i) for i in range(0, 11, by)]
    dy.build(store, lines, number(at[0]))
    for before, now in zip(at, at[1:], strict=False):
        dy.step(store, lines, number(before), number(now))
    assert found(store.weeks(), "week") == totals(rows, END, horizon, lambda d: (d - date(2000, 12, 4)).days // 7 + 1)
    want = totals(rows, END, horizon, lambda d: (END - d).days // length)
    assert found(store.windows(number(END)), "win") == want
    dy.rebuild_windows(store, number(END))
    assert found(store.windows(number(END)), "win") == want


def test_a_step_writes_only_changed_slices_and_can_be_repeated(spark):
    rows = history(random.Random(5), 200, 40)
    lines = stored(spark.createDataFrame(rows, LINES))
    store = new_store(spark, horizon=27, length=7)
    before = END - timedelta(days=1)
    dy.build(store, lines, number(before))
    old = files(store.path)
    dy.step(store, lines, number(before), number(END))
    now = files(store.path)
    changed = {"/".join(p.split("/")[-3:-1]) for p in now.keys() ^ old.keys()} | {"/".join(p.split("/")[-3:-1]) for p in now if p in old and now[p] != old[p]}
    weeks = {store.week_of(number(END)), store.week_of(number(END - timedelta(days=28)))}
    assert changed == {f"days/date={number(END)}", f"windows/as_of={number(END)}", *(f"weeks/week={w}" for w in weeks)}
    first = found(store.windows(number(END)), "win"), found(store.weeks(), "week")
    dy.step(store, lines, number(before), number(END))
    assert (found(store.windows(number(END)), "win"), found(store.weeks(), "week")) == first


def test_a_corrected_day(spark):
    rows = history(random.Random(6), 100, 20)
    lines = stored(spark.createDataFrame(rows, LINES))
    store = new_store(spark, horizon=27, length=7)
    dy.build(store, lines, number(END))
    late = [(9, "z", 777, Decimal("1.50"), 3, number(END - timedelta(days=3)))]
    every = lines.unionByName(spark.createDataFrame(late, LINES))
    dy.put_day(store, every, late[0][5])
    dy.refresh_weeks(store, [store.week_of(late[0][5])], number(END))
    dy.rebuild_windows(store, number(END))
    assert found(store.windows(number(END)), "win") == totals(rows + late, END, 27, lambda d: (END - d).days // 7)
    assert found(store.weeks(), "week") == totals(rows + late, END, 27, lambda d: (d - date(2000, 12, 4)).days // 7 + 1)


def test_no_lines_and_all_expired(spark):
    store = new_store(spark, horizon=6, length=7)
    rows = [(1, "a", 1, Decimal("2.00"), 1, number(END - timedelta(days=6)))]
    lines = spark.createDataFrame(rows, LINES)
    dy.build(store, lines, number(END))
    assert found(store.windows(number(END)), "win") == {(1, "a", 0): (Decimal("2.00"), 1, 1, 1)}
    after = number(END + timedelta(days=1))
    dy.step(store, lines, number(END), after)
    assert store.windows(after).count() == 0 and store.weeks().count() == 0
    with pytest.raises(ValueError):
        dy.move_windows(store, after, after)


def test_a_store_built_on_no_lines_takes_days(spark):
    store = new_store(spark, horizon=6, length=7)
    lines = spark.createDataFrame([], LINES)
    dy.build(store, lines, number(END))
    after = number(END + timedelta(days=1))
    day = spark.createDataFrame([(1, "a", 1, Decimal("2.00"), 1, after)], LINES)
    dy.step(store, day, number(END), after)
    assert found(store.windows(after), "win") == {(1, "a", 0): (Decimal("2.00"), 1, 1, 1)}


# ---- sketches
def amounts(rng, n):
    pick = lambda: rng.choice([rng.randrange(100), rng.randrange(10**4), rng.randrange(10**9), 127, 128, 0])
    return [Decimal(pick() * rng.choice([1, 1, 1, -1])) / 100 for _ in range(n)]


def test_a_bucket_is_narrow_and_holds_its_value(spark):
    values = amounts(random.Random(1), 3000)
    lo, hi = sk.bucket(F.col("x"))
    for r in spark.createDataFrame([(x,) for x in values], "x decimal(18,2)").select("x", lo.alias("lo"), hi.alias("hi")).collect():
        cents = int(r.x * 100)
        assert r.lo <= cents <= r.hi and r.hi - r.lo <= abs(cents) / 64


def test_merged_sketches_bound_exact_quantiles(spark):
    rng = random.Random(2)
    rows = [(rng.choice(["p", "p", "p", "q", None]), rng.randrange(1, 9), x) for x in amounts(rng, 4000)] + [("p", 3, None), ("only null", 3, None), ("one", 2, Decimal("7.77"))]
    df = stored(spark.createDataFrame(rows, "g string, week int, x decimal(18,2)"))
    path = shared_folder(spark)
    sk.put_weeks(df.filter("week <> 5"), path, ["g"], "x")
    sk.put_week(df, path, 5, ["g"], "x")
    sk.put_week(df, path, 5, ["g"], "x")
    percents = (0, 1, 50, 85, 99, 100)
    seen = Counter()
    for r in sk.quantiles(sk.over_weeks(spark, path, ["g"], 2, 6), ["g"], percents).collect():
        mine = sorted(x for g, w, x in rows if g == r.g and 2 <= w <= 6 and x is not None)
        exact = mine[max(-(-r.percent * len(mine) // 100), 1) - 1]
        inside = sum(r.lower <= float(x) <= r.upper for x in mine)
        assert r.n_rows == len(mine) and r.lower <= float(exact) <= r.upper and r.rank_error == inside / len(mine)
        seen[r.g] += 1
    assert seen == {"p": 6, "q": 6, None: 6, "one": 6}


def test_a_span_reads_only_its_weeks(spark):
    path = shared_folder(spark)
    df = spark.range(60).select((F.col("id") % 6).cast("int").alias("week"), F.lit("g").alias("g"), F.col("id").cast("decimal(12,2)").alias("x"))
    sk.put_weeks(df, path, ["g"], "x")
    plan = sk.over_weeks(spark, path, ["g"], 2, 3)
    assert len(plan.inputFiles()) >= 2 and "PartitionFilters: [isnotnull(week" in plan._jdf.queryExecution().executedPlan().toString()
    assert plan.agg(F.sum("n")).first()[0] == 20


def test_no_rows_no_sketch(spark):
    empty = spark.createDataFrame([], "g string, week int, x decimal(12,2)")
    assert sk.quantiles(sk.sketch(empty, ["g"], "x"), ["g"], (50,)).count() == 0
