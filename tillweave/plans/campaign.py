"""Queries from predictions to offers, test cells and their checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillweave.functions.local import local_rows
from tillweave.functions.numeric import cents
from tillweave.operators import allocate as al
from tillweave.operators import cells as ce
from tillweave.operators import checks as ck
from tillweave.operators import factors as fa
from tillweave.operators import filters as fl
from tillweave.operators import joins as jn
from tillweave.operators import metrics as mt
from tillweave.operators import models as mo
from tillweave.operators import rolling as rl
from tillweave.operators import segments as sg
from tillweave.operators.ranks import percentiles
from tillweave.plans.lines import L2
from tillweave.plans.registry import SHARED, query
from tillweave.sources import sinks
from tillweave.sources.retail import ETL_DATE, SEED, Views
from tillweave.sources.scratch import shared_folder, stored

TYPES = ("85_stretch_10_perc", "85_stretch_20_perc", "85_stretch_30_perc")


def u_sql(key: str, seed: int = SEED) -> str:
    return f"(CAST('0x' || substr(md5('{seed}|' || {key}), 1, 8) AS BIGINT)::DOUBLE / 4294967296.0::DOUBLE)"


def cents_sql(x: str) -> str:
    return f"(floor(({x}) * 100.0::DOUBLE + 0.5::DOUBLE) / 100.0::DOUBLE)"


# ---- shared steps: DataFrame functions and, under the same meaning, views for the twins
def cust_p85(v: Views):
    if "p85" in v.held:
        return v.held["p85"]
    return mt.window_totals(v.recent).groupBy("cust_id").agg(F.percentile_approx("total_spend_time_window", 0.85, 10_000).cast("double").alias("85th_percentile"))


def stretched(v: Views):
    return al.fixed_stretch(cust_p85(v), (85,), (10, 20, 30))


def ratings(v: Views):
    if "ratings" in v.held:
        return v.held["ratings"]
    lines = v.held["unit_lines"] if "unit_lines" in v.held else v.scoped
    return mt.window_totals(lines, "l2_id").groupBy("cust_id", "l2_id").agg(F.percentile_approx("total_spend_time_window", 0.85, 10_000).alias("rating"))


def predictions(v: Views):
    r = v.hold("ratings", ratings)
    both = jn.prediction_left(mo.bias_baseline(r, "cust_id", "l2_id", "rating"), r.withColumn("actual", F.col("rating").cast("double")), ["cust_id", "l2_id"], "actual")
    return both.select("cust_id", "l2_id", "prediction", "actual")


def basket_bands(v: Views, reward: int = 10):
    return al.offer_mapping(v.basket_offers, "FD", "full_basket", reward)


def category_bands(v: Views):
    return v.offer_bands.filter((F.col("reward_perc") == 10) & (F.col("target") != "full_basket")).withColumnRenamed("target", "l2_id")


def baselines(v: Views):
    return al.all_baselines(stretched(v).withColumnRenamed("85th_percentile", "estimated_spend"), ["cust_id", "estimated_spend"])


def allocated(v: Views):
    return al.allocate(baselines(v), "baseline_plus_stretch", basket_bands(v))


def assigned(v: Views):
    people = v.hold("p85", cust_p85).select("cust_id")
    return ce.assign(people, ce.quotas_random(people.count(), TYPES, 0.5))


def export(v: Views):
    if "export" in v.held:
        return v.held["export"]
    v.hold("p85", cust_p85)
    rows = ce.apply_assignment(allocated(v), assigned(v))
    out = rows.withColumns({"spend_plus_stretch": F.col("baseline_plus_stretch"), "scope": F.lit("full_basket_fd"), "threshold": fl.pounds("offer_desc", 2), "reward": fl.pounds("offer_desc", 1)})
    return al.round_estimates(out).drop("baseline_plus_stretch")


def scored(v: Views):
    return al.scores(al.under_prediction_floor(predictions(v)))


SHARED |= {
    "p85": 'SELECT cust_id, quantile_disc(t, 0.85)::DOUBLE AS p85 FROM (SELECT cust_id, win, sum(sales_amt) AS t FROM recent GROUP BY ALL) GROUP BY cust_id',
    "base": " UNION ALL ".join(f"SELECT cust_id, p85 AS estimated_spend, '85_stretch_{s}_perc' AS test_type, p85 * {1 + s / 100!r}::DOUBLE AS spend FROM p85" for s in (10, 20, 30)),
    "rated": "SELECT cust_id, l2_id, quantile_disc(total_spend_time_window, 0.85) AS rating FROM cat_windows GROUP BY ALL",
    "mu_t": "SELECT sum(rating)::DOUBLE / count(*) AS mu FROM rated",
    "biased": "SELECT cust_id, l2_id, mu + (mean_u - mu) + (mean_i - mu) AS prediction FROM (SELECT cust_id, sum(rating)::DOUBLE / count(*) AS mean_u FROM rated GROUP BY cust_id), (SELECT l2_id, sum(rating)::DOUBLE / count(*) AS mean_i FROM rated GROUP BY l2_id), mu_t",
    "preds": "SELECT cust_id, l2_id, prediction, coalesce(rating::DOUBLE, 0) AS actual FROM biased LEFT JOIN rated USING (cust_id, l2_id)",
    "floored": "SELECT cust_id, l2_id, prediction AS prediction_original, CASE WHEN prediction < actual THEN actual * 1.2::DOUBLE ELSE prediction END AS prediction, actual FROM preds",
    "errors": "SELECT *, CASE WHEN pct_error BETWEEN -0.5 AND 200 THEN 0 ELSE 1 END AS outlier FROM (SELECT *, CASE WHEN actual > 0 THEN 100.0::DOUBLE * (prediction - actual) / actual ELSE 0 END AS pct_error FROM floored)",
    "used": f"SELECT *, {cents_sql('CASE WHEN actual > 0 THEN actual * fraction ELSE prediction * 0.5::DOUBLE END')}::DECIMAL(14,2) AS spend_plus_stretch FROM (SELECT *, CASE WHEN outlier = 1 THEN 1.2::DOUBLE WHEN pct_error >= 80 THEN 1.8::DOUBLE WHEN pct_error <= 5 THEN 1.05::DOUBLE ELSE 1 + pct_error / 100 END AS fraction FROM errors)",
    "full_bands": "SELECT * FROM offer_bands WHERE target = 'full_basket' AND reward_perc = 10",
    "offered": f"""SELECT b.*, CASE WHEN spend >= 270 THEN (SELECT list(offer_id ORDER BY hi DESC)[:2] FROM full_bands)[floor({u_sql('cust_id')} * 2)::INTEGER + 1]
        WHEN o.offer_id IS NULL THEN (SELECT list(offer_id ORDER BY lo)[:2] FROM full_bands)[floor({u_sql('cust_id')} * 2)::INTEGER + 1] ELSE o.offer_id END AS offer_id
        FROM base b LEFT JOIN full_bands o ON spend >= o.lo AND spend < o.hi""",
    "indexed": f"SELECT cust_id, row_number() OVER (ORDER BY md5('{SEED}|' || cust_id), cust_id) - 1 AS index FROM p85",
    "n_t": "SELECT count(*) AS n FROM p85",
    "quota": "SELECT i, t, n // 3 + CASE WHEN i < n % 3 THEN 1 ELSE 0 END AS size FROM n_t, (VALUES (0, '85_stretch_10_perc'), (1, '85_stretch_20_perc'), (2, '85_stretch_30_perc')) AS x(i, t)",
    "ranges": "SELECT t AS test_type, g AS test_group, sum(k) OVER (ORDER BY i, h) - k AS start, sum(k) OVER (ORDER BY i, h) AS stop FROM (SELECT i, 0 AS h, t, 'treatment' AS g, (size // 2) AS k FROM quota UNION ALL SELECT i, 1, t, 'control', size - size // 2 FROM quota)",
    "celled": "SELECT cust_id, test_type, test_group FROM indexed JOIN ranges ON index >= start AND index < stop",
    "exported": f"""SELECT cust_id, test_type, test_group, offer_id, offer_desc, 'full_basket_fd' AS scope, least::DOUBLE AS threshold, pay::DOUBLE AS reward, {cents_sql('spend')} AS spend_plus_stretch,
        {cents_sql(cents_sql('spend') + ' - estimated_spend')} AS estimated_stretch, {cents_sql('estimated_spend')} AS estimated_spend
        FROM offered JOIN celled USING (cust_id, test_type) JOIN full_bands USING (offer_id) JOIN bands USING (ord)""",
}

# ---- stretch and headroom
query("fixed_stretch", 'SELECT cust_id, p85 AS "85th_percentile", ' + ", ".join(f'p85 * {1 + s / 100!r}::DOUBLE AS "85_stretch_{s}_perc"' for s in (10, 20, 30)) + " FROM p85")(stretched)
query("bias_baseline", "SELECT cust_id, l2_id, prediction FROM biased")(lambda v: mo.bias_baseline(ratings(v), "cust_id", "l2_id", "rating"))
query("prediction_left", "SELECT cust_id, l2_id, prediction, actual FROM preds")(predictions)
query("headroom", "SELECT cust_id, l2_id, prediction, actual, prediction - actual AS headroom FROM preds")(lambda v: mo.headroom(predictions(v)))
query("headroom_rank", "SELECT cust_id, l2_id, dense_rank() OVER (PARTITION BY l2_id ORDER BY prediction - actual) AS headroom_item_rank FROM preds")(
    lambda v: rl.headroom_rank(mo.headroom(predictions(v)), "l2_id").select("cust_id", "l2_id", "headroom_item_rank")
)
def _summary_of_headroom(h):
    return f"SELECT cust_id, sum(h)::DOUBLE AS sum_headroom, sum(h)::DOUBLE / count(*) AS ave_headroom, coalesce(sum(h) FILTER (WHERE h > 0), 0)::DOUBLE AS sum_positive_headroom, coalesce(sum(h) FILTER (WHERE h > 0), 0)::DOUBLE / count(*) AS ave_positive_headroom FROM (SELECT cust_id, ({h})::DECIMAL(20,6) AS h FROM preds) GROUP BY cust_id"


query("user_headroom_summary", _summary_of_headroom("prediction - actual"))(lambda v: mo.user_headroom_summary(mo.headroom(predictions(v))))
query("headroom_items", _summary_of_headroom("CASE WHEN l2_id IN ('ECONOMY', 'SMALL') THEN prediction - actual ELSE 0 END"))(
    lambda v: mo.user_headroom_summary(mo.headroom(predictions(v)), item="l2_id", items=("ECONOMY", "SMALL"))
)
query("under_prediction_floor", "SELECT * FROM floored")(lambda v: al.under_prediction_floor(predictions(v)).select("cust_id", "l2_id", "prediction_original", "prediction", "actual"))
query("pct_error", "SELECT cust_id, l2_id, pct_error FROM errors")(lambda v: scored(v).select("cust_id", "l2_id", "pct_error"))
query("tag_outliers", "SELECT cust_id, l2_id, outlier FROM errors")(lambda v: scored(v).select("cust_id", "l2_id", "outlier"))
query("used_headroom", "SELECT cust_id, l2_id, fraction, spend_plus_stretch::DOUBLE AS spend_plus_stretch FROM used")(
    lambda v: al.used_headroom(scored(v), not_bought=0.5).select("cust_id", "l2_id", "fraction", F.col("spend_plus_stretch").cast("double").alias("spend_plus_stretch"))
)
query("basket_headroom_rollup", f"SELECT cust_id, sum(spend_plus_stretch)::DOUBLE AS spend_plus_stretch, sum({cents_sql('actual')}::DECIMAL(14,2))::DOUBLE AS estimated_spend FROM used GROUP BY cust_id")(
    lambda v: al.basket_rollup(al.used_headroom(scored(v), not_bought=0.5))
)

# ---- offers
query("offer_mapping", "SELECT target, offer_id, lo, hi, offer_desc FROM offer_bands WHERE reward_perc = 10")(
    lambda v: al.offer_mapping(v.offer_bands, "FD", None, 10).select("target", "offer_id", "lo", "hi", "offer_desc")
)
query("max_upper_limit", "SELECT target, max(hi) AS max_limit FROM offer_bands GROUP BY target")(lambda v: al.limits_of(v.offer_bands))
query("top_bottom_offers", "SELECT target, list(offer_id ORDER BY hi DESC)[:2] AS large, list(offer_id ORDER BY lo)[:2] AS small, max(hi) AS max_limit FROM offer_bands WHERE reward_perc = 10 GROUP BY target")(
    lambda v: (lambda e: e[0].join(e[1], "target").select("target", "large", "small", "max_limit"))(al.edge_offers(al.offer_mapping(v.offer_bands, "FD", None, 10), 2, ["target"]))
)
query("offer_band_range", "SELECT cust_id, test_type, estimated_spend, spend AS baseline_plus_stretch, arg_max(o.offer_id, o.ord) AS offer_id FROM base LEFT JOIN full_bands o ON spend >= o.lo AND spend < o.hi GROUP BY ALL")(
    lambda v: jn.offer_band_range(baselines(v), "baseline_plus_stretch", basket_bands(v))
)
query("allocate_offer", "SELECT cust_id, spend AS baseline_plus_stretch, offer_id FROM offered WHERE test_type = '85_stretch_20_perc'")(
    lambda v: al.allocate(baselines(v).filter("test_type = '85_stretch_20_perc'"), "baseline_plus_stretch", basket_bands(v)).select("cust_id", "baseline_plus_stretch", "offer_id")
)
query("allocate_all_baselines", "SELECT cust_id, test_type, estimated_spend, spend AS baseline_plus_stretch, offer_id, offer_desc FROM offered JOIN full_bands USING (offer_id)")(lambda v: allocated(v).select("cust_id", "test_type", "estimated_spend", "baseline_plus_stretch", "offer_id", "offer_desc"))
query("round_estimates", "SELECT cust_id, test_type, spend_plus_stretch, estimated_spend, estimated_stretch FROM exported")(lambda v: export(v).select("cust_id", "test_type", "spend_plus_stretch", "estimated_spend", "estimated_stretch"))
query("fill_offer", "SELECT cust_id, test_type, coalesce(arg_max(o.offer_id, o.ord), 111002) AS offer_id FROM base LEFT JOIN full_bands o ON spend >= o.lo AND spend < o.hi GROUP BY cust_id, test_type")(
    lambda v: jn.offer_band_range(baselines(v), "baseline_plus_stretch", basket_bands(v)).select("cust_id", "test_type", F.coalesce("offer_id", F.lit(111002)).alias("offer_id"))
)
query("upper_limit_exclusion", "SELECT cust_id, test_type, spend FROM base WHERE spend <= (SELECT max(hi) FROM full_bands)")(
    lambda v: al.within_upper_limit(baselines(v), "baseline_plus_stretch", al.limits_of(basket_bands(v)), None).select("cust_id", "test_type", F.col("baseline_plus_stretch").alias("spend"))
)
query("upper_limit_exclusion_category", "SELECT cust_id, l2_id, total::DOUBLE AS total FROM (SELECT cust_id, l2_id, sum(total_spend_time_window) AS total FROM cat_windows GROUP BY ALL) JOIN (SELECT target AS l2_id, max(hi) AS m FROM offer_bands GROUP BY target) USING (l2_id) WHERE total::DOUBLE < m")(
    lambda v: al.within_upper_limit(mt.window_totals(v.scoped, "l2_id").groupBy("cust_id", "l2_id").agg(F.sum("total_spend_time_window").cast("double").alias("total")), "total", al.limits_of(v.offer_bands).withColumnRenamed("target", "l2_id"), "l2_id")
)
query("allocate_by_category", f"""SELECT u.cust_id, u.l2_id, u.s AS spend, CASE WHEN s >= 270 THEN l.large[floor({u_sql('u.cust_id')} * 2)::INTEGER + 1] WHEN o.offer_id IS NULL THEN l.small[floor({u_sql('u.cust_id')} * 2)::INTEGER + 1] ELSE o.offer_id END AS offer_id
  FROM (SELECT cust_id, l2_id, spend_plus_stretch::DOUBLE AS s FROM used) u LEFT JOIN (SELECT * FROM offer_bands WHERE reward_perc = 10) o ON o.target = u.l2_id AND s >= o.lo AND s < o.hi
  LEFT JOIN (SELECT target, list(offer_id ORDER BY hi DESC)[:2] AS large, list(offer_id ORDER BY lo)[:2] AS small FROM offer_bands WHERE reward_perc = 10 GROUP BY target) l ON l.target = u.l2_id""")(
    lambda v: al.allocate(al.used_headroom(scored(v), not_bought=0.5).withColumn("spend", F.col("spend_plus_stretch").cast("double")), "spend", category_bands(v), ["l2_id"]).select("cust_id", "l2_id", "spend", "offer_id")
)


def _top_vs_rest(v):
    band = jn.latest_snapshot(v.band_history, ETL_DATE).filter("cust_band_fd is not null").select("cust_id", F.when(F.col("cust_band_fd").contains("Top"), "top").otherwise("rest").alias("band_set"))
    sets = basket_bands(v, 10).withColumn("band_set", F.lit("top")).unionByName(basket_bands(v, 7).withColumn("band_set", F.lit("rest")))
    rows = baselines(v).filter("test_type = '85_stretch_20_perc'").join(band, "cust_id")
    return al.allocate(rows, "baseline_plus_stretch", sets, ["band_set"]).select("cust_id", "band_set", "offer_id")


query("allocate_top_vs_rest", f"""WITH x AS (SELECT b.cust_id, b.spend, CASE WHEN cust_band_fd LIKE '%Top%' THEN 10 ELSE 7 END AS r FROM base b JOIN band_history h ON b.cust_id = h.cust_id AND h.yyyymmdd = 20010701 AND cust_band_fd IS NOT NULL WHERE test_type = '85_stretch_20_perc'),
  f AS (SELECT * FROM offer_bands WHERE target = 'full_basket'), e AS (SELECT reward_perc, list(offer_id ORDER BY hi DESC)[:2] AS large, list(offer_id ORDER BY lo)[:2] AS small FROM f GROUP BY reward_perc)
  SELECT x.cust_id, CASE WHEN r = 10 THEN 'top' ELSE 'rest' END AS band_set, CASE WHEN spend >= 270 THEN large[floor({u_sql('x.cust_id')} * 2)::INTEGER + 1] WHEN f.offer_id IS NULL THEN small[floor({u_sql('x.cust_id')} * 2)::INTEGER + 1] ELSE f.offer_id END AS offer_id
  FROM x JOIN e ON r = e.reward_perc LEFT JOIN f ON f.reward_perc = r AND spend >= f.lo AND spend < f.hi""".replace("WITH x", "SELECT * FROM (WITH x") + ")")(_top_vs_rest)


def _multi_reward(v):
    plan = local_rows(v.spark, [("85_stretch_10_perc", 7), ("85_stretch_10_perc", 10), ("85_stretch_20_perc", 10)], "test_type string, reward_perc int")
    rows = baselines(v).join(F.broadcast(plan), "test_type")
    out = al.allocate(rows, "baseline_plus_stretch", v.basket_offers.select("reward_perc", "lo", "hi", "ord", "offer_id", "offer_desc"), ["reward_perc"])
    return out.select("cust_id", F.concat("test_type", F.lit("_"), "reward_perc", F.lit("_perc_reward")).alias("test_type"), "offer_id")


query("multi_reward_cells", f"""SELECT b.cust_id, b.test_type || '_' || p.r || '_perc_reward' AS test_type, CASE WHEN spend >= 270 THEN e.large[floor({u_sql('b.cust_id')} * 2)::INTEGER + 1] WHEN f.offer_id IS NULL THEN e.small[floor({u_sql('b.cust_id')} * 2)::INTEGER + 1] ELSE f.offer_id END AS offer_id
  FROM base b JOIN (VALUES ('85_stretch_10_perc', 7), ('85_stretch_10_perc', 10), ('85_stretch_20_perc', 10)) AS p(t, r) ON p.t = b.test_type
  JOIN (SELECT reward_perc, list(offer_id ORDER BY hi DESC)[:2] AS large, list(offer_id ORDER BY lo)[:2] AS small FROM offer_bands WHERE target = 'full_basket' GROUP BY reward_perc) e ON e.reward_perc = p.r
  LEFT JOIN (SELECT * FROM offer_bands WHERE target = 'full_basket') f ON f.reward_perc = p.r AND spend >= f.lo AND spend < f.hi""")(_multi_reward)
query("exclude_high_spend", "SELECT cust_id, test_type FROM base WHERE spend <= 270")(lambda v: baselines(v).filter(F.col("baseline_plus_stretch") <= 270).select("cust_id", "test_type"))
query("min_baskets", "SELECT cust_id, p85 FROM p85 WHERE cust_id IN (SELECT cust_id FROM activity WHERE count_user_basket >= 8)")(
    lambda v: cust_p85(v).join(mt.cust_activity_counts(v.scoped).filter("count_user_basket >= 8").select("cust_id"), "cust_id", "left_semi").select("cust_id", F.col("85th_percentile").alias("p85"))
)


def unit_lines(v):
    """What prices, counts and ratings need of the counted lines."""
    return v.scoped.select("cust_id", "basket_id", "l2_id", "article_id", "win", "sales_amt", "item_qty", "unit_full_price")


def unit_prices(v):
    """cust_id, l2_id, p85 window spend, unit price and weekly count, with the category's price as fallback."""
    lines = v.hold("unit_lines", unit_lines)
    category = mt.category_unit_price(lines)
    own = mt.final_unit_price(mt.customer_unit_price(lines, win="win"), category).select("cust_id", "l2_id", "unit_price", "avg_weekly_article_count")
    base = predictions(v).select("cust_id", "l2_id", F.col("actual").alias("p85"))
    return jn.stretch_fallback_join(base, own, category, ("cust_id", "l2_id")).withColumn("unit_stretch", F.col("p85") + F.col("unit_price"))


SHARED["units_t"] = "SELECT cust_id, l2_id, sum(u)::DOUBLE / count(*) AS c FROM (SELECT cust_id, l2_id, win, sum(item_qty) AS u FROM scoped GROUP BY ALL) GROUP BY ALL"
SHARED["unit_t"] = "SELECT p.cust_id, p.l2_id, p.actual AS p85, coalesce(f.unit_price, c.category_price) AS unit_price, coalesce(u.c, 0) AS avg_weekly_article_count, p.actual + coalesce(f.unit_price, c.category_price) AS unit_stretch FROM preds p LEFT JOIN final_price f USING (cust_id, l2_id) LEFT JOIN units_t u USING (cust_id, l2_id) LEFT JOIN category_price_t c ON c.l2_id = p.l2_id"
SHARED["switched_fixed"] = "SELECT cust_id, l2_id, CASE WHEN avg_weekly_article_count < 20 THEN unit_stretch ELSE rating::DOUBLE * 1.2::DOUBLE END AS spend FROM rated JOIN unit_t USING (cust_id, l2_id)"
SHARED["switched"] = "SELECT cust_id, l2_id, CASE WHEN avg_weekly_article_count < 20 THEN unit_stretch ELSE spend_plus_stretch::DOUBLE END AS spend FROM used JOIN unit_t USING (cust_id, l2_id)"
query("stretch_fallback_join", "SELECT cust_id, l2_id, unit_price, avg_weekly_article_count FROM unit_t")(lambda v: unit_prices(v).select("cust_id", "l2_id", "unit_price", "avg_weekly_article_count"))
query("unit_stretch", "SELECT cust_id, l2_id, p85, unit_stretch FROM unit_t")(lambda v: unit_prices(v).select("cust_id", "l2_id", "p85", "unit_stretch"))


def switched(v):
    v.hold("unit_lines", unit_lines)
    rows = al.used_headroom(scored(v), not_bought=0.5).select("cust_id", "l2_id", F.col("spend_plus_stretch").cast("double").alias("spend_plus_stretch"))
    return jn.low_volume_switch(unit_prices(v), rows, ["cust_id", "l2_id"], 20).select("cust_id", "l2_id", F.col("baseline_plus_stretch").alias("spend"))


query("low_volume_switch", "SELECT cust_id, l2_id, spend FROM switched")(switched)


def switched_fixed(v):
    """As switched, beside the fixed stretch of the category's own percentile."""
    v.hold("unit_lines", unit_lines)
    rows = ratings(v).select("cust_id", "l2_id", (F.col("rating").cast("double") * 1.2).alias("spend_plus_stretch"))
    return jn.low_volume_switch(unit_prices(v), rows, ["cust_id", "l2_id"], 20).select("cust_id", "l2_id", F.col("baseline_plus_stretch").alias("spend"))


def _unit_cell(name, rows):
    return lambda v: al.allocate(rows(v), "spend", category_bands(v), ["l2_id"]).select("cust_id", "l2_id", F.lit(name).alias("test_type"), "offer_id")


def _unit_cell_sql(name, rows):
    return f"""SELECT s.cust_id, s.l2_id, '{name}' AS test_type, CASE WHEN s.spend >= 270 THEN l.large[floor({u_sql('s.cust_id')} * 2)::INTEGER + 1] WHEN o.offer_id IS NULL THEN l.small[floor({u_sql('s.cust_id')} * 2)::INTEGER + 1] ELSE o.offer_id END AS offer_id
  FROM {rows} s LEFT JOIN (SELECT * FROM offer_bands WHERE reward_perc = 10) o ON o.target = s.l2_id AND s.spend >= o.lo AND s.spend < o.hi
  LEFT JOIN (SELECT target, list(offer_id ORDER BY hi DESC)[:2] AS large, list(offer_id ORDER BY lo)[:2] AS small FROM offer_bands WHERE reward_perc = 10 GROUP BY target) l ON l.target = s.l2_id"""


query("unit_plus_headroom_cell", _unit_cell_sql("one_article_unit_plus_headroom", "switched"))(_unit_cell("one_article_unit_plus_headroom", switched))
query("unit_plus_fixed_cell", _unit_cell_sql("one_article_unit_plus_fixed", "switched_fixed"))(_unit_cell("one_article_unit_plus_fixed", switched_fixed))


def _caps(v):
    offers = v.offer_bands.select("offer_id").distinct()
    given = offers.filter("offer_id % 3 = 0").selectExpr("offer_id", "if(offer_id % 2 = 0, offer_id % 100, null) as input_max_cap", "cast(offer_id % 7 as bigint) as input_min_cap", "cast(offer_id % 5 as bigint) as input_markdown_cap")
    made = export(v).groupBy("offer_id").agg((F.count("*") * 1.5).alias("cap_generated"))
    return al.merge_caps(offers, given, made, control=0.1, impute=10.0, lower=5, upper=500)


query("merge_input_caps", """SELECT offer_id, max_cap::BIGINT AS max_cap, least(floor(coalesce(mn::DOUBLE, 0.0::DOUBLE)), max_cap)::BIGINT AS min_cap, md AS input_markdown_cap FROM (
  SELECT o.offer_id, ceil(coalesce(mx::DOUBLE, least(greatest(coalesce(g.c, 10.0::DOUBLE), 5.0::DOUBLE), 500.0::DOUBLE) * 1.1::DOUBLE)) AS max_cap, mn, md FROM (SELECT DISTINCT offer_id FROM offer_bands) o
  LEFT JOIN (SELECT DISTINCT offer_id, CASE WHEN offer_id % 2 = 0 THEN offer_id % 100 END AS mx, offer_id % 7 AS mn, offer_id % 5 AS md FROM offer_bands WHERE offer_id % 3 = 0) i USING (offer_id)
  LEFT JOIN (SELECT offer_id, count(*) * 1.5::DOUBLE AS c FROM exported GROUP BY offer_id) g USING (offer_id))""")(_caps)
query("redemption_cap_left", "SELECT o.offer_id, coalesce(r, 0.0::DOUBLE) AS redemption_cap FROM (SELECT DISTINCT offer_id FROM offer_bands) o LEFT JOIN (SELECT offer_id, count(*) * 0.25::DOUBLE AS r FROM exported GROUP BY offer_id) x USING (offer_id)")(
    lambda v: v.offer_bands.select("offer_id").distinct().join(export(v).groupBy("offer_id").agg((F.count("*") * 0.25).alias("redemption_cap")), "offer_id", "left").fillna(0.0, ["redemption_cap"])
)


def _remaining(v):
    variants = v.scoped.groupBy("l3_id", "l2_id").agg(F.countDistinct("article_id").alias("count"))
    units = variants.groupBy("l3_id").agg(F.sum("count").alias("all_variant_count"), F.count("*").alias("no_of_variants"))
    volumes = v.lu_article.select("l3_id").distinct().withColumn("min_volume", F.lit(40) + 5 * F.length("l3_id"))
    return al.offers_remaining(variants.join(units, "l3_id"), volumes, "l3_id").select("l3_id", "l2_id", "count", "expected_offer_count", "remaining_offers").orderBy(F.desc("count"))


query("cap_offers_remaining", """SELECT l3_id, l2_id, count, expected AS expected_offer_count, expected - count AS remaining_offers FROM (
  SELECT l3_id, l2_id, n AS count, all_n, (40 + 5 * length(l3_id)) AS least_n, (40 + 5 * length(l3_id))::DOUBLE / k AS expected FROM (
    SELECT l3_id, l2_id, n, sum(n) OVER (PARTITION BY l3_id) AS all_n, count(*) OVER (PARTITION BY l3_id) AS k FROM (SELECT l3_id, l2_id, count(DISTINCT article_id) AS n FROM scoped GROUP BY ALL)))
  WHERE all_n < least_n""")(_remaining)
query("swap_offers", f"SELECT cust_id, test_type, CASE WHEN offer_id = 111002 AND {u_sql('cust_id')} < 0.3 THEN 111003 ELSE offer_id END AS offer_id FROM offered")(lambda v: al.swap_offers(allocated(v), 111002, 111003, 0.3, known=basket_bands(v)).select("cust_id", "test_type", "offer_id"))
query("export_with_ids", "SELECT cust_id, test_type, account_id, uk_digital_id FROM exported JOIN (SELECT cust_id, min(account_id) AS account_id, arg_min(uk_digital_id, account_id) AS uk_digital_id FROM accounts GROUP BY cust_id) USING (cust_id)")(
    lambda v: al.with_ids(export(v), jn.first_account_link(v.table("customer").select(F.col("c_custkey").alias("cust_id")), v.accounts)).select("cust_id", "test_type", "account_id", "uk_digital_id")
)
query("offer_ladder", "SELECT l2_id, quantile_disc(unit_full_price, [0.5, 0.75, 0.85])::DOUBLE[] AS price_steps FROM scoped GROUP BY l2_id")(
    lambda v: percentiles(v.scoped, ["l2_id"], "unit_full_price", (0.5, 0.75, 0.85)).select("l2_id", F.col("steps").cast("array<double>").alias("price_steps"))
)


def _spend_steps(v, shares):
    spend = baselines(v).select("test_type", cents(F.col("baseline_plus_stretch")).cast("decimal(14,2)").alias("spend"))
    return percentiles(spend, ["test_type"], "spend", shares).select("test_type", F.col("steps").cast("array<double>").alias("spend_steps"))


query("offer_spend_steps", f"SELECT test_type, quantile_disc({cents_sql('spend')}::DECIMAL(14,2), [0.5, 0.75, 0.85])::DOUBLE[] AS spend_steps FROM base GROUP BY test_type")(
    lambda v: _spend_steps(v, (0.5, 0.75, 0.85))
)


# ---- distributions that offers are designed on
def _article_prices(v):
    """The highest full price of each counted article in its product group."""
    return v.scoped.groupBy("l2_id", "article_id").agg(F.max("unit_full_price").cast("double").alias("unit_price"))


def _histogram_sql(rows, by, value, bins):
    return f"""WITH_x AS (SELECT {by}, {value} AS x FROM {rows}), b AS (SELECT {by}, min(x) AS lo, max(x) AS hi FROM x GROUP BY {by}),
  h AS (SELECT {by}, CASE WHEN hi > lo THEN least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) ELSE 0 END::INTEGER AS bin, count(*) AS n FROM x JOIN b USING ({by}) GROUP BY ALL),
  e AS (SELECT *, unnest(range({bins}))::INTEGER AS bin FROM b)
  SELECT {by}, bin, lo + (hi - lo) * (bin / {float(bins)}::DOUBLE) AS lower, lo + (hi - lo) * ((bin + 1) / {float(bins)}::DOUBLE) AS upper, coalesce(n, 0) AS n_rows FROM e LEFT JOIN h USING ({by}, bin))""".replace("WITH_x", "SELECT * FROM (WITH x")


STEPS = (0.0, 0.25, 0.5, 0.75, 0.95, 0.97, 0.99, 1.0)
SHARED["article_prices"] = "SELECT l2_id, article_id, max(unit_full_price)::DOUBLE AS unit_price FROM scoped GROUP BY l2_id, article_id"
query("price_histogram", _histogram_sql("article_prices", "l2_id", "unit_price", 100))(lambda v: mt.histogram(_article_prices(v), ["l2_id"], "unit_price", 100))
query("price_ladder", f"SELECT l2_id, quantile_disc(unit_price, {[0.5, 0.75, 0.85]}) AS price_steps FROM article_prices GROUP BY l2_id")(
    lambda v: percentiles(_article_prices(v), ["l2_id"], "unit_price", (0.5, 0.75, 0.85)).withColumnRenamed("steps", "price_steps")
)
query("spend_histogram", _histogram_sql("base", "test_type", "spend", 700))(lambda v: mt.histogram(stored(baselines(v)), ["test_type"], "baseline_plus_stretch", 700))
query("spend_ladder", f"SELECT test_type, quantile_disc({cents_sql('spend')}::DECIMAL(14,2), {list(STEPS)})::DOUBLE[] AS spend_steps FROM base GROUP BY test_type")(
    lambda v: _spend_steps(v, STEPS)
)
query("union_cells", "SELECT cust_id, test_type, spend, NULL::VARCHAR AS l2_id FROM base UNION ALL SELECT cust_id, 'headroom', spend_plus_stretch::DOUBLE, l2_id FROM used")(
    lambda v: baselines(v).select("cust_id", "test_type", F.col("baseline_plus_stretch").alias("spend")).unionByName(al.used_headroom(scored(v), not_bought=0.5).select("cust_id", F.lit("headroom").alias("test_type"), F.col("spend_plus_stretch").cast("double").alias("spend"), "l2_id"), allowMissingColumns=True)
)
query("cohort_overlap", "SELECT cust_id, CASE WHEN a AND b THEN 'both' WHEN a THEN 'first' ELSE 'second' END AS part FROM (SELECT cust_id, bool_or(l2_id = 'SMALL') AS a, bool_or(l2_id = 'MEDIUM') AS b FROM scoped WHERE l2_id IN ('SMALL', 'MEDIUM') GROUP BY cust_id)")(
    lambda v: jn.cohort_overlap(v.scoped, "cust_id", F.col("l2_id") == "SMALL", F.col("l2_id") == "MEDIUM")
)

# ---- cells
query("shuffled_row_number", "SELECT cust_id, index FROM indexed")(lambda v: ce.shuffled_index(cust_p85(v).select("cust_id"), "cust_id").select("cust_id", "index"))
query("random_limit_sample", f"SELECT cust_id FROM p85 ORDER BY md5('{SEED}|' || cust_id), cust_id LIMIT 50")(lambda v: ce.random_rows_per_group(cust_p85(v).select("cust_id").withColumn("g", F.lit(1)), ["g"], 50).select("cust_id"))
query("random_rows_per_group", f"SELECT cust_id, cust_gender FROM (SELECT DISTINCT cust_id, cust_gender FROM scoped) QUALIFY row_number() OVER (PARTITION BY cust_gender ORDER BY md5('{SEED}|' || cust_id), cust_id) <= 3")(
    lambda v: ce.random_rows_per_group(v.scoped.select("cust_id", "cust_gender").distinct(), ["cust_gender"], 3)
)
query("assign_random", "SELECT * FROM celled")(assigned)
query("assign_percentage", "SELECT cust_id, test_type, test_group FROM indexed JOIN (SELECT t AS test_type, g AS test_group, sum(k) OVER (ORDER BY i) - k AS start, sum(k) OVER (ORDER BY i) AS stop FROM (SELECT i, t, g, floor(n * s * 0.5::DOUBLE)::BIGINT AS k FROM n_t, (VALUES (0, 'a', 'treatment', 0.5::DOUBLE), (1, 'a', 'control', 0.5::DOUBLE), (2, 'b', 'treatment', 0.25::DOUBLE), (3, 'b', 'control', 0.25::DOUBLE)) AS q(i, t, g, s))) ON index >= start AND index < stop")(
    lambda v: ce.assign(cust_p85(v), ce.quotas_percentage(cust_p85(v).count(), {"a": 0.5, "b": 0.25}, 0.5))
)
query("assign_volume", "SELECT cust_id, test_type, test_group FROM indexed JOIN (VALUES ('a', 'treatment', 0, 30), ('b', 'treatment', 30, 50), ('a', 'control', 50, 65), ('b', 'control', 65, 70)) AS q(test_type, test_group, start, stop) ON index >= start AND index < stop")(
    lambda v: ce.assign(cust_p85(v), ce.quotas_volume(cust_p85(v).count(), {"treatment": {"a": 30, "b": 20}, "control": {"a": 15, "b": 5}}))
)
query("assign_apply", "SELECT cust_id, test_type, test_group, spend FROM base JOIN celled USING (cust_id, test_type)")(lambda v: ce.apply_assignment(baselines(v), assigned(v)).select("cust_id", "test_type", "test_group", F.col("baseline_plus_stretch").alias("spend")))
query("assignment_sequence", "SELECT l2_id, count(DISTINCT cust_id) AS customers FROM scoped GROUP BY l2_id")(lambda v: v.scoped.groupBy("l2_id").agg(F.countDistinct("cust_id").alias("customers")).orderBy("customers", "l2_id"))


def _sequential_sql(order, n):
    ctes, used = [], []
    for i, c in enumerate(order):
        away = "".join(f" AND cust_id NOT IN (SELECT cust_id FROM s{j})" for j in used)
        ctes.append(f"s{i} AS (SELECT cust_id, '{c}' AS l2_id FROM (SELECT DISTINCT cust_id FROM scoped WHERE l2_id = '{c}'{away}) ORDER BY md5('{SEED}|' || cust_id), cust_id LIMIT {n})")
        used.append(i)
    return "SELECT * FROM (WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(f"SELECT * FROM s{i}" for i in used) + ")"


query("sequential_exclusive", _sequential_sql(sorted(L2), 20))(
    lambda v: ce.sequential_exclusive(v.scoped.groupBy("cust_id", "l2_id").agg(F.sum("sales_amt").alias("spend")), sorted(L2), 20, "l2_id", spend="spend").select("cust_id", "l2_id")
)
query("anti_already_assigned", f"SELECT DISTINCT cust_id FROM scoped WHERE l2_id = 'SMALL' AND cust_id NOT IN (SELECT cust_id FROM (SELECT DISTINCT cust_id FROM scoped WHERE l2_id = 'ECONOMY') ORDER BY md5('{SEED}|' || cust_id), cust_id LIMIT 20)")(
    lambda v: v.scoped.filter("l2_id = 'SMALL'").select("cust_id").distinct().join(ce.sequential_exclusive(v.scoped, ["ECONOMY"], 20, "l2_id").select("cust_id"), "cust_id", "left_anti")
)
query("anti_test_accounts", "SELECT cust_id, account_id FROM accounts WHERE uk_digital_id NOT IN (SELECT 'D' || c_custkey FROM customer WHERE c_custkey % 100 = 1)")(
    lambda v: v.accounts.join(v.table("customer").filter("c_custkey % 100 = 1").select(F.concat(F.lit("D"), "c_custkey").alias("digital_id")), F.col("uk_digital_id") == F.col("digital_id"), "left_anti").select("cust_id", "account_id")
)


def _test_account_offers(v):
    picked = ce.shuffled_index(ce.random_rows_per_group(export(v).select("scope", "offer_id", "cust_id"), ["scope", "offer_id"], 1), "cust_id", by=["scope"])
    fake = ce.shuffled_index(v.table("customer").filter("c_custkey % 100 = 1").select(F.concat(F.lit("D"), "c_custkey").alias("uk_digital_id")), "uk_digital_id")
    return fake.join(picked.withColumn("none", F.lit(None).cast("long")), "index").select("uk_digital_id", "scope", "offer_id", F.lit(None).cast("long").alias("cust_id"), F.lit("treatment").alias("test_group"), F.lit(True).alias("test_accounts"))


query("test_account_offers", f"""SELECT uk_digital_id, scope, offer_id, NULL::BIGINT AS cust_id, 'treatment' AS test_group, true AS test_accounts FROM
  (SELECT scope, offer_id, row_number() OVER (PARTITION BY scope ORDER BY md5('{SEED}|' || cust_id), cust_id) AS i FROM (SELECT scope, offer_id, cust_id FROM exported QUALIFY row_number() OVER (PARTITION BY scope, offer_id ORDER BY md5('{SEED}|' || cust_id), cust_id) = 1))
  JOIN (SELECT 'D' || c_custkey AS uk_digital_id, row_number() OVER (ORDER BY md5('{SEED}|D' || c_custkey), 'D' || c_custkey) AS i FROM customer WHERE c_custkey % 100 = 1) USING (i)""")(_test_account_offers)

# ---- checks
query("qa_scope_overview", "SELECT scope, test_group, count(DISTINCT cust_id) AS customers FROM exported GROUP BY ALL")(lambda v: ck.scope_overview(export(v), "test_group"))
_pct = lambda x: f"CASE WHEN estimated_spend = 0 THEN NULL ELSE {cents_sql(f'100.0::DOUBLE * ({x} - estimated_spend) / estimated_spend')} END"
query("qa_stretch_columns", f"SELECT cust_id, {_pct('spend_plus_stretch')} AS stretch_perc, {_pct('threshold')} AS threshold_stretch_perc FROM exported")(lambda v: ck.stretch_columns(export(v)).select("cust_id", "stretch_perc", "threshold_stretch_perc"))
query("qa_large_stretch", f"SELECT cust_id, stretch_perc FROM (SELECT cust_id, estimated_spend, {_pct('spend_plus_stretch')} AS stretch_perc FROM exported) WHERE stretch_perc > 15 AND estimated_spend > 15")(
    lambda v: ck.large_stretch(export(v), 15, 15).select("cust_id", "stretch_perc")
)
query("qa_cell_breakdown", "SELECT test_type, test_group, count(DISTINCT cust_id) AS customers, quantile_disc(estimated_spend::DECIMAL(14,2), 0.25)::DOUBLE AS p25, sum(estimated_spend::DECIMAL(14,2))::DOUBLE / count(*) AS avg, quantile_disc(estimated_spend::DECIMAL(14,2), 0.75)::DOUBLE AS p75, sum((spend_plus_stretch - estimated_spend)::DECIMAL(14,2))::DOUBLE / count(*) AS avg_stretch, " + f"sum(({_pct('spend_plus_stretch')})::DECIMAL(14,2))::DOUBLE / count({_pct('spend_plus_stretch')}) AS avg_stretch_perc, sum(({_pct('threshold')})::DECIMAL(14,2))::DOUBLE / count({_pct('threshold')}) AS avg_threshold_stretch_perc, " + ", ".join(f"count(DISTINCT cust_id) FILTER (WHERE cust_band_fd = '{b}') AS band_{i}" for i, b in enumerate(("1. Top", "2. Core", "3. Occ"))) + " FROM exported LEFT JOIN (SELECT cust_id, cust_band_fd FROM band_history WHERE yyyymmdd = 20010701) USING (cust_id) GROUP BY ALL")(
    lambda v: ck.cell_breakdown(export(v).join(jn.latest_snapshot(v.band_history, ETL_DATE).select("cust_id", F.col("cust_band_fd").alias("band")), "cust_id", "left"), ("1. Top", "2. Core", "3. Occ"))
)
query("qa_unallocated_offers", "SELECT DISTINCT offer_id FROM offer_bands WHERE offer_id NOT IN (SELECT offer_id FROM exported)")(lambda v: ck.not_in(v.offer_bands, export(v), "offer_id"))
query("qa_unknown_offers", "SELECT DISTINCT offer_id FROM offered WHERE offer_id NOT IN (SELECT offer_id FROM full_bands WHERE ord < 5)")(lambda v: ck.not_in(allocated(v), basket_bands(v).filter("ord < 5"), "offer_id"))
query("qa_large_offers", "SELECT cust_id, test_type, offer_id FROM offered WHERE spend > 200 AND offer_id NOT IN (SELECT offer_id FROM full_bands ORDER BY hi DESC, offer_id DESC LIMIT 2)")(
    lambda v: ck.large_without_large(allocated(v), "baseline_plus_stretch", basket_bands(v), 200).select("cust_id", "test_type", "offer_id")
)
query("qa_distinct_offers", "SELECT cust_id, count(offer_id) AS n, count(DISTINCT offer_id) AS n_distinct FROM offered GROUP BY cust_id HAVING count(offer_id) <> count(DISTINCT offer_id)")(
    lambda v: allocated(v).groupBy("cust_id").agg(F.count("offer_id").alias("n"), F.countDistinct("offer_id").alias("n_distinct")).filter("n != n_distinct")
)
query("qa_offer_count_range", "SELECT cust_id, 'x' AS scope, count(offer_id) AS n, count(DISTINCT offer_id) AS n_distinct FROM offered GROUP BY cust_id HAVING count(offer_id) NOT BETWEEN 3 AND 3 OR count(DISTINCT offer_id) NOT BETWEEN 3 AND 3")(lambda v: ck.counts_within(allocated(v).withColumn("scope", F.lit("x")), 3, 3))
query("qa_group_exclusive", "SELECT cust_id, count(DISTINCT l2_id) AS groups FROM cat_windows GROUP BY cust_id HAVING count(DISTINCT l2_id) > 1")(lambda v: ck.both_groups(mt.window_totals(v.scoped, "l2_id").withColumnRenamed("l2_id", "test_group")))
query("qa_cell_exclusive", "SELECT cust_id, offer_id, count(*) AS n FROM offered GROUP BY ALL HAVING count(*) > 1")(lambda v: ck.repeated(allocated(v), ["cust_id", "offer_id"]))


def _summary_sql(checks):
    return " UNION ALL ".join(f"SELECT '{name}' AS \"check\", count(*) AS failures, CASE WHEN count(*) = 0 THEN 'Passed' ELSE 'Failed' END AS status FROM ({body})" for name, body in checks.items())


def _summary(v):
    rows = v.hold("export", export)
    return ck.summary({
        "one cell": ck.repeated(rows, ["cust_id", "scope"]), "one group": ck.both_groups(rows), "all offers used": ck.not_in(v.offer_bands, rows, "offer_id"), "offers known": ck.not_in(rows, v.offer_bands, "offer_id"),
        "offer count": ck.counts_within(rows, 1, 1), "offer once": ck.repeated(rows, ["cust_id", "offer_id"]), "large stretch": ck.large_stretch(rows, 15, 15), "scopes": ck.scope_overview(rows).filter("customers = 0"),
    })


query("qa_summary", _summary_sql({
    "one cell": "SELECT cust_id FROM exported GROUP BY cust_id, scope HAVING count(*) > 1", "one group": "SELECT cust_id FROM exported GROUP BY cust_id HAVING count(DISTINCT test_group) > 1",
    "all offers used": "SELECT DISTINCT offer_id FROM offer_bands WHERE offer_id NOT IN (SELECT offer_id FROM exported)", "offers known": "SELECT DISTINCT offer_id FROM exported WHERE offer_id NOT IN (SELECT offer_id FROM offer_bands)",
    "offer count": "SELECT cust_id FROM exported GROUP BY cust_id, scope HAVING count(offer_id) <> 1 OR count(DISTINCT offer_id) <> 1", "offer once": "SELECT cust_id FROM exported GROUP BY cust_id, offer_id HAVING count(*) > 1",
    "large stretch": f"SELECT cust_id FROM exported WHERE {_pct('spend_plus_stretch')} > 15 AND estimated_spend > 15", "scopes": "SELECT scope FROM exported GROUP BY scope HAVING count(DISTINCT cust_id) = 0",
}))(_summary)
query("qa_assignment", _summary_sql({
    "assigned once": "SELECT cust_id FROM celled GROUP BY cust_id HAVING count(*) > 1", "known": "SELECT DISTINCT cust_id FROM celled WHERE cust_id NOT IN (SELECT cust_id FROM p85)", "covered": "SELECT DISTINCT cust_id FROM p85 WHERE cust_id NOT IN (SELECT cust_id FROM celled)",
    "sizes": "SELECT * FROM ranges r LEFT JOIN (SELECT test_type, test_group, count(*) AS have FROM celled GROUP BY ALL) c USING (test_type, test_group) WHERE stop > start AND have IS DISTINCT FROM stop - start",
    "uniform": "SELECT s FROM (SELECT max(n) - min(n) AS s FROM (SELECT count(*) AS n FROM celled GROUP BY test_type)) WHERE s > 2", "ratio": "SELECT x FROM (SELECT count(*) FILTER (WHERE test_group = 'treatment') AS x, count(*) AS n FROM celled) WHERE abs(x - 0.5 * n) > 0.05 * n + 3",
}))(lambda v: ck.assignment_checks(v.hold("p85", cust_p85), stored(assigned(v)), ce.quotas_random(cust_p85(v).count(), TYPES, 0.5)))
query("qa_allocation_matrix", "SELECT test_type, threshold, " + ", ".join(f"{cents_sql(f'100.0::DOUBLE * count(*) FILTER (WHERE reward = {r}) / any_value(n)')} AS reward_{r}" for r in (5, 7, 9, 11)) + " FROM exported JOIN (SELECT test_type, count(*) AS n FROM exported GROUP BY test_type) USING (test_type) GROUP BY test_type, threshold")(lambda v: ck.allocation_matrix(export(v), (5, 7, 9, 11)))
query("qa_offer_share", "SELECT offer_desc, n_rows, floor(1000.0::DOUBLE * n_rows / sum(n_rows) OVER () + 0.5) / 1000.0::DOUBLE AS share FROM (SELECT offer_desc, count(*) AS n_rows FROM exported GROUP BY offer_desc)")(lambda v: rl.share_of_total(mt.group_counts(export(v), "offer_desc")))
query("offer_volume", f"SELECT *, treatment + control AS total, {cents_sql('100.0::DOUBLE * control / (treatment + control)')} AS percentage_control FROM (SELECT offer_id, offer_desc, scope, count(DISTINCT cust_id) FILTER (WHERE test_group = 'treatment') AS treatment, count(DISTINCT cust_id) FILTER (WHERE test_group = 'control') AS control FROM exported GROUP BY ALL)")(
    lambda v: ck.offer_volumes(export(v))
)


def _spot(v):
    picked = ce.random_rows_per_group(export(v).select("scope", "cust_id"), ["scope"], 20)
    history = mt.window_totals(v.scoped).join(picked, "cust_id")
    return mt.baseline_percentiles(history, ["scope", "cust_id"], "total_spend_time_window", (50, 85, 95, 100))


query("qa_spot_history", f"SELECT scope, cust_id, " + ", ".join(f'quantile_disc(total_spend_time_window, {p / 100})::DOUBLE AS "{p}th_percentile"' for p in (50, 85, 95, 100)) + f" FROM windows JOIN (SELECT scope, cust_id FROM exported QUALIFY row_number() OVER (PARTITION BY scope ORDER BY md5('{SEED}|' || cust_id), cust_id) <= 20) USING (cust_id) GROUP BY ALL")(_spot)

# ---- models
_six = lambda x: f"(floor(({x}) * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE)"
_to6 = lambda x: F.floor(x * 1000000.0 + 0.5) / 1000000.0
SHARED["bounds_t"] = "SELECT l2_id, least(min(rating)::DOUBLE * 0.9::DOUBLE, 0.5::DOUBLE) AS lo, greatest(max(rating)::DOUBLE * 1.1::DOUBLE, 500.0::DOUBLE) AS hi FROM rated GROUP BY l2_id"


def _scaled(v):
    r = ratings(v).withColumn("r", F.col("rating").cast("double"))
    return r.join(F.broadcast(mo.lognorm_bounds(r, "r", ["l2_id"], 0.5, 500.0)), "l2_id").withColumn("y", mo.lognorm(F.col("r")))


query("lognorm_scale", f"SELECT cust_id, l2_id, {_six('ln(greatest((rating::DOUBLE - lo) / (hi - lo), 0.000001::DOUBLE))')} AS y FROM rated JOIN bounds_t USING (l2_id)")(lambda v: _scaled(v).select("cust_id", "l2_id", _to6(F.col("y")).alias("y")))
query("lognorm_inverse", f"SELECT cust_id, l2_id, {_six('exp(ln(greatest((rating::DOUBLE - lo) / (hi - lo), 0.000001::DOUBLE))) * (hi - lo) + lo')} AS x FROM rated JOIN bounds_t USING (l2_id)")(lambda v: _scaled(v).select("cust_id", "l2_id", _to6(mo.lognorm_inverse(F.col("y"))).alias("x")))
query("rating_scale", "SELECT cust_id, l2_id, least(greatest(prediction, lo), hi) AS prediction FROM biased JOIN (SELECT l2_id, min(rating)::DOUBLE AS lo, max(rating)::DOUBLE AS hi FROM rated GROUP BY l2_id) USING (l2_id)")(
    lambda v: mo.bias_baseline(ratings(v), "cust_id", "l2_id", "rating").join(F.broadcast(mo.lognorm_bounds(ratings(v), "rating", ["l2_id"], tol=0.0)), "l2_id").select("cust_id", "l2_id", F.least(F.greatest("prediction", "lo"), "hi").alias("prediction"))
)
query("split_by_customer", f"SELECT cust_id, l2_id, CASE WHEN u < 0.1 THEN 'test' WHEN u < 0.2 THEN 'dev' ELSE 'train' END AS part FROM (SELECT cust_id, l2_id, {u_sql('cust_id', 42)} AS u FROM rated)")(lambda v: mo.split_by_customer(ratings(v), "cust_id").select("cust_id", "l2_id", "part"))
query("rmse_mae", "SELECT sqrt(sum(((prediction - actual) * (prediction - actual))::DECIMAL(24,6))::DOUBLE / count(*)) AS rmse, sum(abs(prediction - actual)::DECIMAL(24,6))::DOUBLE / count(*) AS mae FROM preds WHERE actual IS NOT NULL")(lambda v: mo.rmse_mae(predictions(v), "actual", "prediction"))
query("arhr", "SELECT sum(score)::DOUBLE / count(*) AS arhr FROM (SELECT cust_id, coalesce(sum((1.0::DOUBLE / r)::DECIMAL(20,12)) FILTER (WHERE actual <> 0), 0) AS score FROM (SELECT *, CASE WHEN prediction <> 0 THEN count(*) OVER (PARTITION BY cust_id ORDER BY prediction DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS r FROM preds) GROUP BY cust_id)")(
    lambda v: mo.arhr(predictions(v), "cust_id", "actual", "prediction")
)
query("candidate_grid", "SELECT cust_id, l2_id, rating::DOUBLE AS rating FROM (SELECT DISTINCT cust_id FROM rated) CROSS JOIN (SELECT DISTINCT l2_id FROM rated) LEFT JOIN rated USING (cust_id, l2_id)")(
    lambda v: jn.customer_item_cross(ratings(v), "cust_id", ratings(v).select("l2_id").distinct()).join(ratings(v).withColumn("rating", F.col("rating").cast("double")), ["cust_id", "l2_id"], "left")
)
query("segment_profile", "SELECT cust_gender, count(*) AS n_rows, count(DISTINCT cust_id) AS customers FROM scoped GROUP BY ALL")(lambda v: v.scoped.groupBy("cust_gender").agg(F.count("*").alias("n_rows"), F.countDistinct("cust_id").alias("customers")))


def _by_segment(v, **how):
    """Ratings with customer gender, the segment that all lines carry; one factorisation for all segments."""
    spend = mt.window_totals(v.scoped, "l2_id", "cust_gender").groupBy("cust_id", "l2_id", "cust_gender")
    rows = spend.agg(F.percentile_approx("total_spend_time_window", 0.85, 10_000).alias("rating"))
    return fa.factorise(rows, "cust_id", "l2_id", "rating", segment="cust_gender", **how)


query("mf_recommender")(_by_segment)
query("nmf_recommender")(lambda v: _by_segment(v, nonnegative=True))


def _knn(kind):
    return lambda v: mo.knn(ratings(v), "cust_id", "l2_id", "rating", kind=kind).withColumn("prediction", _to6(F.col("prediction")))


def _knn_sql(shift, scale):
    """All pairs of users, for the small tables of the comparison."""
    return f"""SELECT * FROM (WITH one AS (SELECT cust_id, l2_id, rating::DOUBLE AS r FROM rated),
  per AS (SELECT cust_id, avg(r) AS m, stddev_pop(r) AS s FROM one GROUP BY cust_id), k AS (SELECT cust_id, l2_id, r, {shift} AS shift, {scale} AS scale FROM one JOIN per USING (cust_id)),
  alike AS (SELECT a.cust_id AS u, b.cust_id AS v, round(sum(a.r * b.r) / sqrt(sum(a.r * a.r) * sum(b.r * b.r)), 12) AS sim FROM k a JOIN k b ON a.l2_id = b.l2_id AND a.cust_id <> b.cust_id GROUP BY ALL),
  near AS (SELECT u, l2_id, sim, (r - shift) / scale AS z FROM alike JOIN k ON cust_id = v QUALIFY row_number() OVER (PARTITION BY u, l2_id ORDER BY sim DESC, v) <= 20)
  SELECT u AS cust_id, l2_id, {_six('p * scale + shift')} AS prediction FROM (SELECT u, l2_id, sum(sim * z) / sum(sim) AS p FROM near GROUP BY ALL) x JOIN (SELECT DISTINCT cust_id, shift, scale FROM k) mine ON mine.cust_id = u)"""


_SPREAD = "CASE WHEN s > 0 THEN s ELSE 1.0::DOUBLE END"
query("knn_basic", _knn_sql("0.0::DOUBLE", "1.0::DOUBLE"))(_knn("basic"))
query("knn_recommender", _knn_sql("m", "1.0::DOUBLE"))(_knn("means"))
query("knn_zscore", _knn_sql("m", _SPREAD))(_knn("zscore"))
query("batch_predict")(lambda v: mo.headroom(jn.prediction_left(_by_segment(v), ratings(v).withColumn("actual", F.col("rating").cast("double")), ["cust_id", "l2_id"], "actual")))
query("grid_search")(lambda v: fa.grid_search(ratings(v), "cust_id", "l2_id", "rating", [*({"rank": 4, "maxIter": 3, "regParam": x} for x in (0.1, 0.5)), {"rank": 50, "maxIter": 30, "regParam": 0.1}]))
query("kfold_eval")(lambda v: fa.kfold(ratings(v), "cust_id", "l2_id", "rating", run="mf"))

# ---- segmentation
SEG = ("FD_spend", "GM_spend", "FD_items", "GM_items", "FD_baskets", "GM_baskets")


def _seg_data(v):
    wide = mt.channel_pivot_spend(v.trx_line.filter(fl.common_filters()))
    return stored(wide.join(fl.clean_demographics(v.customer_master).select("cust_id", "gender"), "cust_id").select("cust_id", "gender", *(F.col(c).cast("double").alias(c) for c in SEG)))


SHARED["seg_t"] = "SELECT cust_id, gender, " + ", ".join(f"{c}::DOUBLE AS {c}" for c in SEG) + " FROM pivoted JOIN clean USING (cust_id) WHERE FD_spend >= 0.1"
query(
    "seg_standardise",
    "SELECT cust_id, "
    + ", ".join(f"floor(CASE WHEN s_{c} > 0 THEN {c} / s_{c} ELSE 0 END * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS {c}" for c in SEG)
    + " FROM seg_t JOIN (SELECT gender, "
    + ", ".join(f"coalesce(stddev_samp({c}), 0) AS s_{c}" for c in SEG)
    + " FROM seg_t GROUP BY gender) AS m ON seg_t.gender IS NOT DISTINCT FROM m.gender",
)(lambda v: sg.standardise(_seg_data(v), SEG, "gender").select("cust_id", *(((F.floor(F.col("scaled")[i] * 1000000.0 + 0.5)) / 1000000.0).alias(c) for i, c in enumerate(SEG))))
query("seg_moments", "SELECT gender, count(*) AS n, " + ", ".join(f"{_six(f'coalesce(covar_samp({SEG[i]}, {SEG[j]}), 0)')} AS cov_{i}_{j}" for i in range(len(SEG)) for j in range(i, len(SEG))) + " FROM seg_t GROUP BY gender")(
    lambda v: (lambda m: m.select("gender", "n", *(_to6(F.col(c)).alias(c) for c in m.columns[2:])))(sg.moments(_seg_data(v), SEG, "gender"))
)
query("seg_pca")(lambda v: sg.reduced(_seg_data(v), SEG, 2, "gender").select("cust_id", "gender", "pca_0", "pca_1"))
query("seg_kmeans_search")(lambda v: sg.search(_seg_data(v), "gender", SEG, 3, 5, lower=20))
query("seg_union")(lambda v: sg.search(_seg_data(v), "gender", SEG, 3, 6, pca_k=None, lower=20).join(mt.cust_activity_counts(v.scoped), "cust_id"))
query("cluster_size_check", "SELECT l2_id, n_rows, n_rows::DOUBLE / (sum(n_rows) OVER ())::DOUBLE AS fraction, n_rows::DOUBLE / (sum(n_rows) OVER ())::DOUBLE < 0.2::DOUBLE AS fails FROM (SELECT l2_id, count(*) AS n_rows FROM scoped GROUP BY l2_id)")(lambda v: sg.cluster_sizes(v.scoped, "l2_id", 0.2))


# ---- sinks: written to the shared folder and read back
def _slice(v):
    path, rows = shared_folder(v.spark), export(v).select("cust_id", "test_type", "offer_id")
    keys = {"campaign": ETL_DATE, "l1_id": "FD"}
    sinks.replace_slice(rows.withColumns({"campaign": F.lit(ETL_DATE), "l1_id": F.lit("FD")}), path, keys, ["offer_id"])
    sinks.replace_slice(rows.filter("test_type != '85_stretch_10_perc'").withColumns({"campaign": F.lit(ETL_DATE), "l1_id": F.lit("FD")}), path, keys, ["offer_id"])
    return v.spark.read.parquet(path).select("cust_id", "test_type", F.col("offer_id").cast("long").alias("offer_id"), F.col("campaign").cast("int").alias("campaign"), "l1_id")


query("replace_where", "SELECT cust_id, test_type, offer_id, 20010801 AS campaign, 'FD' AS l1_id FROM exported WHERE test_type <> '85_stretch_10_perc'")(_slice)
query("align_schema", "SELECT cust_id, NULL::VARCHAR AS gender, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id")(
    lambda v: sinks.align_schema(v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")), v.customer_master.select("cust_id", "gender"))
)


def _merged(v):
    """A table of the recent customers by band, into which all customers are merged, twice: the second run inserts nothing."""
    path = shared_folder(v.spark)
    rows = lambda lines, run: lines.select("cust_id").distinct().select("cust_id", (F.col("cust_id") % 7).alias("band"), F.lit(run).alias("run"))
    rows(v.recent, 0).write.partitionBy("band").parquet(path)
    source = stored(rows(v.scoped, 1))
    sinks.insert_new(source, path, ["cust_id", "band"], "band")
    if sinks.insert_new(source.withColumn("run", F.lit(2)), path, ["cust_id", "band"], "band"):
        raise ValueError("a second merge of the same rows inserted some")
    return v.spark.read.schema(source.schema).parquet(path)


query("insert_only_merge", "SELECT DISTINCT cust_id FROM scoped WHERE cust_id NOT IN (SELECT cust_id FROM recent)")(lambda v: _merged(v).filter("run > 0").select("cust_id"))
query("insert_only_merge_target", "SELECT cust_id, cust_id % 7 AS band, CASE WHEN cust_id IN (SELECT cust_id FROM recent) THEN 0 ELSE 1 END AS run FROM (SELECT DISTINCT cust_id FROM scoped)")(_merged)


def _written(write, *cols):
    def run(v):
        path = shared_folder(v.spark)
        rows = v.scoped.groupBy("cust_id", "l2_id").agg(F.sum("sales_amt").cast("double").alias("spend"))
        write(rows, path)
        return v.spark.read.parquet(path).select("cust_id", "spend", *cols)

    return run


_CAT = "SELECT cust_id, sum(sales_amt)::DOUBLE AS spend, l2_id FROM scoped GROUP BY cust_id, l2_id"
query("write_parquet", _CAT)(_written(lambda d, p: sinks.write_parquet(d, p), "l2_id"))
query("repartition_write", _CAT)(_written(lambda d, p: sinks.repartition_write(d, p, 4, ["l2_id"]), "l2_id"))
query("append_stamped", _CAT)(_written(lambda d, p: sinks.append_stamped(d, p, ["l2_id"]), "l2_id"))
query("export_partition", "SELECT cust_id, sum(sales_amt)::DOUBLE AS spend FROM scoped WHERE l2_id = 'SMALL' GROUP BY cust_id")(_written(lambda d, p: sinks.export_partition(d, "l2_id", "SMALL", p)))


def _csv(v):
    path = shared_folder(v.spark)
    sinks.write_csv_report(v.scoped.groupBy("l2_id").agg(F.count("*").alias("n_rows")), path)
    return sinks.load_static_table(v.spark, path, "l2_id string, n_rows long")


query("write_csv_report", "SELECT l2_id, count(*) AS n_rows FROM scoped GROUP BY l2_id")(_csv)
query("load_static_table", "SELECT l2_id, count(*) AS n_rows FROM scoped GROUP BY l2_id")(_csv)


def _created(v):
    path = shared_folder(v.spark)
    rows = v.scoped.select("cust_id", "l2_id")
    sinks.table_create(v.spark, path, rows, ["l2_id"])
    sinks.table_create(v.spark, path, rows, ["l2_id"], overwrite=True)
    sinks.append_stamped(rows.distinct(), path, ["l2_id"])
    return v.spark.read.parquet(path).select("cust_id", "l2_id")


query("table_create", "SELECT DISTINCT cust_id, l2_id FROM scoped")(_created)


def _truncated(v):
    path = shared_folder(v.spark)
    v.scoped.select("cust_id", "l2_id").write.parquet(path)
    sinks.truncate_staging(v.spark, path, "spend_staging")
    return v.spark.read.parquet(path).unionByName(v.recent.select("cust_id", "l2_id").distinct())


query("truncate_staging", "SELECT DISTINCT cust_id, l2_id FROM recent")(_truncated)


def flagship(v: Views):
    """Customers by offer and test group: windows, percentile, stretch, offer, limit, cells."""
    v.hold("p85", cust_p85)
    rows = al.within_upper_limit(allocated(v), "baseline_plus_stretch", al.limits_of(basket_bands(v)), None)
    cells = ce.apply_assignment(rows, assigned(v))
    return cells.groupBy("offer_id", "offer_desc").pivot("test_group", ["treatment", "control"]).agg(F.countDistinct("cust_id")).fillna(0)


query("flagship", "SELECT offer_id, offer_desc, count(DISTINCT cust_id) FILTER (WHERE test_group = 'treatment') AS treatment, count(DISTINCT cust_id) FILTER (WHERE test_group = 'control') AS control FROM offered JOIN celled USING (cust_id, test_type) JOIN full_bands USING (offer_id) WHERE spend <= 270 GROUP BY offer_id, offer_desc")(flagship)
