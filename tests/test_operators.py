"""Semantics on hand-made frames: traps, ties, edges, quotas, ladders."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillweave.functions.hashing import uniform
from tillweave.operators import allocate as al
from tillweave.operators import cells as ce
from tillweave.operators import checks as ck
from tillweave.operators import filters as fl
from tillweave.operators import joins as jn
from tillweave.operators import metrics as mt
from tillweave.operators import factors as fa
from tillweave.operators import models as mo
from tillweave.operators import rolling as rl
from tillweave.operators import segments as sg
from tillweave.sources import sinks
from tillweave.sources.scratch import shared_folder


def test_season_wraps_over_new_year(spark):
    d = spark.createDataFrame([(20001217,), (20001218,), (20010101,), (20010102,)], "date int")
    assert [r.date for r in d.filter(fl.outside_season("1218", "0101")).orderBy("date").collect()] == [20001217, 20010102]
    assert [r.date for r in d.filter(fl.outside_season("0101", "0105")).orderBy("date").collect()] == [20001217, 20001218]


def test_all_exclusions_apply(spark):
    d = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "y")], "l3_id string, l2_id string")
    assert fl.exclude_items(d, {"l3_id": ["a"], "l2_id": ["y"]}).collect() == [("b", "x")]
    assert fl.exclude_items(d, None).count() == 3


def test_null_in_a_tested_column_drops_the_line(spark):
    d = spark.createDataFrame([("A", "S", None, "X", 1.0, "1", 1), ("A", "S", "B", "X", 1.0, "1", 1)], "l2_id string, trans_line_type string, l4_id string, area_name string, sales_amt double, l3_id string, cust_id long")
    assert d.filter(fl.common_filters()).count() == 1


def test_week_number_truncates_toward_zero(spark):
    d = spark.createDataFrame([(20000101,), (20000107,), (20000108,), (19991231,)], "date int")
    assert [r[1] for r in d.select("date", fl.week_number("date", 20000101)).orderBy("date").collect()] == [1, 1, 1, 2]


def test_scope_and_amounts(spark):
    d = spark.createDataFrame([("a_b_fd",), ("plain",), ("£5 off when you spend £30 on food",), ("",)], "t string")
    got = d.select("t", fl.clean_scope("t").alias("s"), fl.pounds("t", 2).alias("p")).collect()
    assert [(r.s, r.p) for r in got] == [("a_b", None), ("plain", None), ("£5 off when you spend £30 on food", 30.0), ("", None)]


def test_null_counts_take_strings_and_nan(spark):
    d = spark.createDataFrame([(None, float("nan"), 1), ("abc", 1.0, 2)], "a string, b double, c int")
    assert {tuple(r) for r in fl.null_counts(d).collect()} == {("a", 1), ("b", 1)}


def test_membership_fans_out(spark):
    a = spark.createDataFrame([(1, "FD", "G", "Brand#1", "Brand#1-0", "x", "1")], "article_id long, l1_id string, l2_id string, l3_id string, l4_id string, l5_id string, l6_id string")
    rules = spark.createDataFrame([("o", "l3_id", "Brand#1"), ("o", "l4_id", "Brand#1-0"), ("p", "l2_id", "G")], "offer string, level string, id string")
    assert sorted(r.category for r in jn.category_membership(a, rules, ["G"]).collect()) == ["G", "o", "p"]


def test_band_edges_and_overlap(spark):
    bands = spark.createDataFrame([(0, 10, 0, 1), (10, 20, 1, 2), (5, 12, 2, 3)], "lo int, hi int, ord int, offer_id long")
    d = spark.createDataFrame([(1, 4.0), (2, 10.0), (3, 12.0), (4, 20.0), (5, None)], "k long, s double")
    got = {r.k: r.offer_id for r in jn.offer_band_range(d, "s", bands).collect()}
    assert got == {1: 1, 2: 3, 3: 2, 4: None, 5: None}


def test_allocation_fills_above_and_without_spend(spark):
    bands = spark.createDataFrame([(i * 10, i * 10 + 10, i, 100 + i, f"d{i}") for i in range(4)], "lo int, hi int, ord int, offer_id long, offer_desc string")
    d = spark.createDataFrame([(1, 39.9), (2, 40.0), (3, None), (4, -1.0)], "cust_id long, s double")
    got = {r.cust_id: (r.offer_id, r.offer_desc) for r in al.allocate(d, "s", bands).collect()}
    assert got[1] == (103, "d3") and got[2][0] in (102, 103) and got[3][0] in (100, 101) and got[4][0] in (100, 101)


def test_latest_snapshot_ignores_the_future(spark):
    h = spark.createDataFrame([(1, 20010101), (1, 20010701), (1, 20011001)], "cust_id long, yyyymmdd int")
    assert [r.yyyymmdd for r in jn.latest_snapshot(h, 20010801).collect()] == [20010701]


def test_sparse_rolling_equals_dense(spark):
    rows = [(c, w, float((c * 7 + w * 3) % 11 + 1)) for c in range(6) for w in (1, 2, 4, 5, 8, 9) if (c + w) % 3]
    weekly = spark.createDataFrame(rows, "cust_id long, week int, total double").withColumn("total", F.col("total").cast("decimal(12,2)"))
    dense = rl.rolling_weeks_dense(weekly, ["cust_id"], 3)
    ps = (50, 85, 100)
    want = {r.cust_id: tuple(r)[1:] for r in mt.baseline_percentiles(dense, ["cust_id"], "rolling", ps).collect()}
    got = {r.cust_id: tuple(r)[1:] for r in rl.rolling_weeks_percentiles(weekly, ["cust_id"], 3, ps).collect()}
    assert got == want and len(got) == 6


def test_nearest_above_percentile_breaks_ties(spark):
    d = spark.createDataFrame([(1, 5, 10), (1, 3, 10), (1, 4, 1)], "cust_id long, win int, v int")
    assert rl.nearest_above_percentile(d, "v", ["win"]).collect()[0].win == 3


def test_quotas_and_exclusive_cells(spark):
    q = ce.quotas_random(10, ["a", "b", "c"], 0.5)
    assert sum(n for _, _, n in q) == 10 and [n for t, _, n in q if t == "a"] == [2, 2]
    people = spark.range(10).withColumnRenamed("id", "cust_id")
    cells = ce.assign(people, q)
    assert cells.count() == 10 and cells.select("cust_id").distinct().count() == 10
    assert {r.status for r in ck.assignment_checks(people, cells, q).collect()} == {"Passed"}
    with pytest.raises(ValueError):
        ce.quotas_volume(3, {"treatment": {"a": 4}})
    with pytest.raises(ValueError):
        ce.quotas_percentage(3, {"a": 0.7, "b": 0.5}, 0.5)


def test_shuffled_index_is_a_permutation(spark):
    d = spark.range(500).withColumnRenamed("id", "k")
    got = ce.shuffled_index(d, "k").orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(500)) and [r.k for r in got] != list(range(500))


def test_sequential_exclusive(spark):
    d = spark.createDataFrame([(c, g) for c in range(10) for g in "ab"], "cust_id long, g string")
    got = ce.sequential_exclusive(d, ["a", "b"], 4, "g").collect()
    assert len(got) == 8 and len({r.cust_id for r in got}) == 8


def test_uniform_is_repeatable_and_spread(spark):
    d = spark.range(2000).select(uniform(7, "id").alias("u"))
    mean = d.agg(F.avg("u")).first()[0]
    assert abs(mean - 0.5) < 0.03 and d.filter("u < 0 or u >= 1").count() == 0


def test_scaling_round_trip_and_zero(spark):
    d = spark.createDataFrame([(0.0,), (10.0,), (400.0,)], "x double")
    b = mo.lognorm_bounds(d, "x", low=-1.0, high=500.0)
    y = d.crossJoin(b).withColumn("y", mo.lognorm(F.col("x"))).withColumn("z", mo.lognorm_inverse(F.col("y")))
    assert all(math.isclose(r.x, r.z, abs_tol=1e-6) and math.isfinite(r.y) for r in y.collect())


def test_arhr_ties_and_zeros(spark):
    d = spark.createDataFrame([(1, 1.0, 5.0), (1, 0.0, 5.0), (1, 2.0, 0.0), (2, 0.0, 1.0)], "u long, a double, p double")
    assert mo.arhr(d, "u", "a", "p").first()[0] == 0.25


def test_caps_keep_generated_under_upper_override(spark):
    offers = spark.createDataFrame([(1,), (2,), (3,)], "offer_id long")
    given = spark.createDataFrame([(1, 7, 9, 2)], "offer_id long, input_max_cap int, input_min_cap int, input_markdown_cap int")
    made = spark.createDataFrame([(2, 10.2)], "offer_id long, cap_generated double")
    got = {r.offer_id: (r.max_cap, r.min_cap) for r in al.merge_caps(offers, given, made, control=0.1, upper=50).collect()}
    assert got[1] == (7, 7) and got[2] == (12, 0) and got[3][0] is None


def test_swap_touches_the_offer_column_only(spark):
    d = spark.createDataFrame([(i, 5, 5) for i in range(200)], "cust_id long, offer_id long, other long")
    got = al.swap_offers(d, 5, 6, 0.5)
    n = got.filter("offer_id = 6").count()
    assert 60 < n < 140 and got.filter("other != 5").count() == 0


def test_knn_reaches_hand_value(spark):
    r = spark.createDataFrame([(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (2, "b", 2.0), (2, "c", 3.0)], "u long, i string, r double")
    got = {(x.u, x.i): x.prediction for x in mo.knn(r, "u", "i", "r").collect()}
    assert math.isclose(got[(1, "c")], 3.0)


def brute_knn(rows, k, kind):
    by, out = {}, {}
    for u, i, r in rows:
        by.setdefault(u, {})[i] = r
    m = {u: sum(x.values()) / len(x) if kind != "basic" else 0.0 for u, x in by.items()}
    s = {u: math.sqrt(sum((r - m[u]) ** 2 for r in x.values()) / len(x)) or 1.0 if kind == "zscore" else 1.0 for u, x in by.items()}
    for u, mine in by.items():
        near = []
        for v, x in by.items():
            both = sorted(set(mine) & set(x))
            if v != u and both:
                norm = math.sqrt(sum(mine[i] ** 2 for i in both) * sum(x[i] ** 2 for i in both))
                near.append((-round(sum(mine[i] * x[i] for i in both) / norm, 12), v))
        near.sort()
        for i in {i for x in by.values() for i in x}:
            top = [(-a, v) for a, v in near if i in by[v]][:k]
            if top:
                out[u, i] = m[u] + s[u] * sum(a * (by[v][i] - m[v]) / s[v] for a, v in top) / sum(a for a, _ in top)
    return out


@pytest.mark.parametrize(("kind", "hot"), [("basic", 1), ("means", 2), ("zscore", 7), ("means", 2000)])
def test_knn_meets_every_user(spark, kind, hot):
    rng = random.Random(hot)
    rows = [(u, i, float(rng.randrange(1, 60))) for u in range(40) for i in "abcd" if rng.random() < 0.6]
    d = spark.createDataFrame(rows, "u long, i string, r double")
    got, want = {(x.u, x.i): x.prediction for x in mo.knn(d, "u", "i", "r", k=3, kind=kind, hot=hot).collect()}, brute_knn(rows, 3, kind)
    assert set(got) == set(want)
    assert all(math.isclose(got[x], want[x], rel_tol=1e-9, abs_tol=1e-9) for x in want)


def test_grid_search_scores_unseen_users(spark):
    d = spark.createDataFrame([(u, "ab"[u % 2], 10.0 + 10 * (u % 2)) for u in range(30)], "u long, i string, r double")
    (row,) = fa.grid_search(d, "u", "i", "r", [{"rank": 2, "maxIter": 2, "regParam": 0.1}], k=2).collect()
    assert math.isclose(row.rmse, 0.0, abs_tol=1e-9)


def test_clusters_fall_back_to_zero(spark):
    d = spark.createDataFrame([(i, "g", float(i), 1.0) for i in range(5)], "cust_id long, c string, x double, y double")
    assert {r.segmentation for r in sg.search(d, "c", ["x", "y"], 2, 3, lower=10).collect()} == {0}


def test_too_many_categories_are_an_error(spark):
    d = spark.range(1001).selectExpr("id as cust_id", "cast(id as string) as c", "1.0D as x")
    with pytest.raises(ValueError, match="categories"):
        sg.search(d, "c", ["x"], 2, 3)


def test_slice_is_replaced_whole(spark):
    path = shared_folder(spark)
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "campaign int, offer_id int, v string")
    sinks.replace_slice(rows, path, {"campaign": 1}, ["offer_id"])
    for _ in range(2):
        sinks.replace_slice(rows.filter("offer_id = 2"), path, {"campaign": 1}, ["offer_id"])
    assert [(r.campaign, r.offer_id, r.v) for r in spark.read.parquet(path).collect()] == [(1, 2, "b")]


def test_staging_guard(spark):
    with pytest.raises(ValueError):
        sinks.truncate_staging(spark, "nowhere", "export")


def test_assignment_checks_find_faults(spark):
    people = spark.createDataFrame([(i,) for i in range(10)], "cust_id long")
    quotas = [("a", "treatment", 3), ("a", "control", 3), ("b", "treatment", 2), ("b", "control", 2)]
    good = [(i, "a" if i < 6 else "b", "treatment" if i % 2 else "control") for i in range(10)]
    bad = [(i, "a", "treatment") for i in range(8)] + [(0, "b", "control"), (99, "b", "control")]
    found = lambda rows: {r.check: (r.failures, r.status) for r in ck.assignment_checks(people, spark.createDataFrame(rows, "cust_id long, test_type string, test_group string"), quotas).collect()}
    assert {s for _, s in found(good).values()} == {"Passed"}
    assert {k: n for k, (n, _) in found(bad).items()} == {"assigned once": 1, "known": 1, "covered": 2, "sizes": 3, "uniform": 1, "ratio": 1}


def test_low_volume_switch_without_counts(spark):
    units = spark.createDataFrame([(1, 10.0, 9.0), (2, 1.0, 9.0)], "cust_id long, avg_weekly_article_count double, unit_stretch double")
    rows = spark.createDataFrame([(1, 50.0), (2, 50.0), (3, 50.0)], "cust_id long, spend_plus_stretch double")
    got = {r.cust_id: r.baseline_plus_stretch for r in jn.low_volume_switch(units, rows, ["cust_id"]).collect()}
    assert got == {1: 50.0, 2: 9.0, 3: None}


def test_dates_reach_the_scan(spark, sf_dir):
    from tillweave.sources.retail import Views

    plan = Views(spark, sf_dir).recent._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan and "LessThan(o_orderdate" in plan


def test_flagship_scans_lines_once(spark, sf_dir):
    from tillweave.plans.campaign import flagship
    from tillweave.sources.retail import Views

    assert flagship(Views(spark, sf_dir))._jdf.queryExecution().executedPlan().toString().count("l_extendedprice") == 0


def test_offers_remaining(spark):
    counts = spark.createDataFrame([("u", "x", 3, 9, 2), ("u", "y", 6, 9, 2), ("w", "x", 20, 20, 1)], "unit string, variant string, count long, all_variant_count long, no_of_variants long")
    volumes = spark.createDataFrame([("u", 10), ("w", 15)], "unit string, min_volume long")
    assert sorted((r.variant, r.expected_offer_count, r.remaining_offers) for r in al.offers_remaining(counts, volumes, "unit").collect()) == [("x", 5.0, 2.0), ("y", 5.0, -1.0)]


def test_factorise_takes_any_ids_and_no_rows(spark):
    rows = [(10**12 + i, f"i{j}", float(10 + i % 3 + 2 * j)) for i in range(12) for j in range(3) if (i + j) % 4]
    r = spark.createDataFrame(rows, "cust_id long, item string, rating double")
    got = fa.factorise(r, "cust_id", "item", "rating", rank=8, iterations=8).collect()
    assert len(got) == 36 and all(5 < x.prediction < 25 for x in got)
    assert fa.factorise(r.filter("false"), "cust_id", "item", "rating").count() == 0


def test_kfold_scores_every_row(spark):
    rows = [(i, f"i{i % 3}", float(5 * (i % 3))) for i in range(60)]
    r = spark.createDataFrame(rows, "cust_id long, item string, rating double")
    got = fa.kfold(r, "cust_id", "item", "rating", run="t", rank=2, iterations=2).collect()
    assert [x.fold for x in sorted(got, key=lambda x: x.fold)] == [0, 1, 2] and all(abs(x.rmse) < 1e-9 and x.run == "t" for x in got)


def test_segments_of_known_groups(spark):
    rows = [(i, "F", 1.0 + (i % 5) / 100, 1.0) for i in range(30)] + [(100 + i, "F", 50.0 + (i % 5) / 100, 70.0 + i % 2) for i in range(30)] + [(999, "M", 1.0, 1.0)]
    d = spark.createDataFrame(rows, "cust_id long, gender string, u double, w double")
    got = {r.cust_id: r for r in sg.search(d, "gender", ["u", "w"], 2, 4, lower=20).collect()}
    assert len(got) == 61 and got[999].segmentation == 0 and got[999].pca_0 is None
    assert len({got[i].segmentation for i in range(30)}) == 1 and got[0].segmentation != got[100].segmentation
    assert sg.search(d.filter("false"), "gender", ["u", "w"], 2, 4).count() == 0
    scaled = {r.cust_id: r.scaled for r in sg.standardise(d, ["u", "w"]).collect()}
    dev = np.std([r[2] for r in rows], ddof=1)
    assert abs(scaled[0][0] - rows[0][2] / dev) < 1e-9
    assert sg.reduced(d.filter("false"), ["u", "w"], 2).count() == 0


def test_headroom_of_an_item_subset(spark):
    d = spark.createDataFrame([(1, "a", 3.0), (1, "b", -1.0), (1, "c", 5.0), (2, "c", 2.0)], "cust_id long, i string, headroom double")
    whole = {r.cust_id: tuple(r)[1:] for r in mo.user_headroom_summary(d).collect()}
    assert whole == {1: (7.0, 7.0 / 3, 8.0, 8.0 / 3), 2: (2.0, 2.0, 2.0, 2.0)}
    some = {r.cust_id: tuple(r)[1:] for r in mo.user_headroom_summary(d, item="i", items=("a", "b")).collect()}
    assert some == {1: (2.0, 2.0 / 3, 3.0, 1.0), 2: (0.0, 0.0, 0.0, 0.0)}


def test_table_create_from_rows_and_over_a_table(spark):
    path = shared_folder(spark)
    rows = spark.createDataFrame([(1, "x")], "a int, b string")
    sinks.table_create(spark, path, rows, ["b"])
    sinks.append_stamped(rows, path, ["b"])
    assert sinks.table_create(spark, path, rows.schema, ["b"]).count() == 1
    again = sinks.table_create(spark, path, rows, ["b"], overwrite=True)
    assert again.count() == 0 and sorted(again.columns) == ["a", "b", "load_timestamp"]


def test_configuration_faults_are_errors(spark):
    bands = spark.createDataFrame([("FD", "full_basket", 10, 5, 0.0, 9.0), ("FD", "full_basket", 10, 6, 9.0, 20.0)], "l1_id string, target string, reward_perc int, offer_id long, lo double, hi double")
    assert al.offer_mapping(bands, "FD", "full_basket", 10).count() == 2
    with pytest.raises(ValueError):
        al.offer_mapping(bands, "GM", "full_basket", 10)
    with pytest.raises(ValueError):
        al.swap_offers(bands.withColumn("cust_id", F.lit(1)), 5, 7, 0.5, known=bands)
    links = spark.createDataFrame([(1, 4, None), (2, None, None)], "cust_id long, account_id long, uk_digital_id string")
    people = spark.createDataFrame([(1,), (2,)], "cust_id long")
    assert al.with_ids(people.filter("cust_id = 2"), links).count() == 0
    with pytest.raises(Exception, match="uk_digital_id is null"):
        al.with_ids(people, links).collect()
    given = spark.createDataFrame([(1, 12.0, 5), (2, 12.0, 6), (3, 3.0, 5)], "cust_id long, spend double, offer_id long")
    assert [r.cust_id for r in ck.large_without_large(given, "spend", bands, 9.0, 1).collect()] == [1]
    rows = spark.createDataFrame([(1, "a", 1.0), (2, "a", 0.0), (1, "b", 1.0)], "cust_id long, c string, spend double")
    assert [(r.cust_id, r.c) for r in ce.sequential_exclusive(rows, ["a", "b"], 2, "c", spend="spend").collect()] == [(1, "a")]
    with pytest.raises(ValueError):
        ce.sequential_exclusive(rows, ["a", "b"], 2, "c", spend="spend", enough=True)
