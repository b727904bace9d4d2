"""Queries over transaction lines, customers and articles: filters, joins, metrics, windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillweave.functions import numeric
from tillweave.operators import daily as dy
from tillweave.operators import filters as fl
from tillweave.operators import joins as jn
from tillweave.operators import metrics as mt
from tillweave.operators import rolling as rl
from tillweave.operators import sketches as sk
from tillweave.operators.ranks import percentiles
from tillweave.plans.registry import SHARED, query
from tillweave.sources.retail import ETL_DATE, HISTORY, LOOKBACK, WINDOW_DAYS
from tillweave.sources.scratch import shared_folder

L2 = ("ECONOMY", "SMALL", "STANDARD", "MEDIUM")
L2_SQL = "('ECONOMY', 'SMALL', 'STANDARD', 'MEDIUM')"
KEY = "cust_id, basket_id, article_id, sales_amt"


def profile_sql(name: str, percents=(50, 75, 85, 90, 100)) -> str:
    cols = [f"sum({name})::DOUBLE / count({name}) AS average_{name}"]
    return ", ".join(cols + [f'quantile_disc({name}, {p / 100.0})::DOUBLE AS "{p}percentile_{name}"' for p in percents])


SHARED |= {
    "baskets": "SELECT cust_id, basket_id, sum(sales_amt) AS total_spend_basket, count(*) AS items_per_basket FROM scoped GROUP BY ALL",
    "windows": "SELECT cust_id, win, sum(sales_amt) AS total_spend_time_window, count(DISTINCT basket_id) AS basket_per_time_window FROM scoped GROUP BY ALL",
    "cat_windows": "SELECT cust_id, l2_id, win, sum(sales_amt) AS total_spend_time_window, count(DISTINCT basket_id) AS basket_per_time_window FROM scoped GROUP BY ALL",
    "window_baskets": "SELECT cust_id, win, basket_id, sum(sales_amt) AS total_spend_basket FROM scoped GROUP BY ALL",
    "window_max": "SELECT cust_id, win, max(total_spend_basket) AS time_window_max_spend_basket FROM window_baskets GROUP BY ALL",
    "membership": f"""SELECT article_id, l2_id AS category, false AS synthetic FROM lu_article WHERE l2_id IN {L2_SQL}
        UNION ALL SELECT article_id, 'brand_mix', true FROM lu_article WHERE l3_id IN ('Brand#1', 'Brand#2')
        UNION ALL SELECT article_id, 'small_pack', true FROM lu_article WHERE l4_id IN ('Brand#1-0', 'Brand#3-0') OR l2_id IN ('SMALL')""",
    "weekly": "SELECT l2_id, cust_id, (date_diff('day', DATE '1995-01-02', d) // 7 + 1)::INTEGER AS week, sum(sales_amt) AS total FROM recent GROUP BY ALL",
    "cust_weekly": "SELECT cust_id, week, sum(total) AS total FROM weekly GROUP BY ALL",
    "present": "SELECT week, row_number() OVER (ORDER BY week) AS ordinal FROM (SELECT DISTINCT week FROM weekly)",
    "dense": """SELECT cust_id, ordinal, sum(coalesce(total, 0)) OVER (PARTITION BY cust_id ORDER BY ordinal ROWS BETWEEN 3 PRECEDING AND CURRENT ROW) AS rolling
        FROM (SELECT DISTINCT cust_id FROM cust_weekly) CROSS JOIN present LEFT JOIN cust_weekly USING (cust_id, week)""",
    "category_price_t": "SELECT l2_id, quantile_disc(price, 0.75)::DOUBLE AS category_price FROM (SELECT l2_id, article_id, max(unit_full_price) AS price FROM scoped GROUP BY ALL) GROUP BY l2_id",
    "customer_price_t": "SELECT cust_id, l2_id, quantile_disc(unit_full_price, 0.85)::DOUBLE AS customer_price, sum(item_qty)::BIGINT AS total_articles FROM scoped GROUP BY ALL",
    "final_price": """SELECT cust_id, l2_id, customer_price, total_articles, category_price,
        greatest(CASE WHEN total_articles <= 10 AND category_price IS NOT NULL THEN category_price ELSE customer_price END, category_price) AS unit_price FROM customer_price_t LEFT JOIN category_price_t USING (l2_id)""",
    "activity": "SELECT cust_id, count(DISTINCT basket_id)::INTEGER AS count_user_basket, count(DISTINCT win)::INTEGER AS count_user_time_window FROM scoped GROUP BY ALL",
}

query("scan_where", "SELECT l_orderkey, l_partkey, l_extendedprice FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")(
    lambda v: v.table("lineitem").where("l_quantity > 45 and l_returnflag = 'R'").select("l_orderkey", "l_partkey", "l_extendedprice")
)
query("scan_parquet", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders")(lambda v: v.table("orders").select("o_orderkey", "o_custkey", "o_orderstatus"))
query("int_date", "SELECT cust_id, basket_id, date, count(*) AS n FROM trx_line GROUP BY ALL")(lambda v: v.trx_line.groupBy("cust_id", "basket_id", fl.int_date().alias("date")).agg(F.count("*").alias("n")))
query("common_filters", f"SELECT {KEY}, l2_id, l3_id, l4_id FROM counted")(lambda v: v.trx_line.filter(fl.common_filters()).select(*KEY.split(", "), "l2_id", "l3_id", "l4_id"))
query("lookback_filter", f"SELECT {KEY}, date FROM trx_line WHERE date BETWEEN {fl.shifted(ETL_DATE, -LOOKBACK)} AND {ETL_DATE}")(
    lambda v: v.lines(fl.shifted(ETL_DATE, -LOOKBACK), ETL_DATE).filter(fl.lookback_filter(ETL_DATE, LOOKBACK)).select(*KEY.split(", "), "date")
)
query("channel_filter", f"SELECT {KEY}, l1_id FROM trx_line WHERE (l1_id = 'FD' AND purchase_channel = 'POS') OR l1_id = 'GM'")(
    lambda v: v.trx_line.filter(((F.col("l1_id") == "FD") & fl.channel_filter("FD")) | ((F.col("l1_id") == "GM") & fl.channel_filter("GM"))).select(*KEY.split(", "), "l1_id")
)
query("exclude_season", f"SELECT {KEY}, date FROM trx_line WHERE NOT (date % 10000 >= 1218 OR date % 10000 <= 101)")(lambda v: v.trx_line.filter(fl.outside_season()).select(*KEY.split(", "), "date"))
query("exclude_items", f"SELECT {KEY}, l2_id, l3_id FROM trx_line WHERE l3_id NOT IN ('Brand#3', 'Brand#4') AND l2_id NOT IN ('PROMO')")(
    lambda v: fl.exclude_items(v.trx_line, {"l3_id": ["Brand#3", "Brand#4"], "l2_id": ["PROMO"]}).select(*KEY.split(", "), "l2_id", "l3_id")
)
query("min_line_spend", "SELECT cust_id, cust_age, cust_gender, article_id, basket_id, sales_amt, unit_full_price, item_qty, date FROM trx_line WHERE sales_amt > 0.5")(
    lambda v: v.trx_line.select("cust_id", "cust_age", "cust_gender", "article_id", "basket_id", "sales_amt", "unit_full_price", "item_qty", "date").filter("sales_amt > 0.5")
)
query("registered_before", "SELECT account_id, cust_id FROM accounts WHERE registration_date <= TIMESTAMP '1999-01-03'")(lambda v: fl.registered_before(v.accounts, 20000101, 363).select("account_id", "cust_id"))
query("week_number", "SELECT cust_id, basket_id, (date_diff('day', DATE '1998-01-01', d) / 7.0)::DOUBLE AS w, (trunc(date_diff('day', DATE '1998-01-01', d) / 7.0))::INTEGER + 1 AS week_number FROM trx_line".replace("(date_diff('day', DATE '1998-01-01', d) / 7.0)::DOUBLE AS w, ", ""))(
    lambda v: v.trx_line.select("cust_id", "basket_id", fl.week_number("date", 19980101).alias("week_number"))
)
query("time_window_index", "SELECT DISTINCT date, floor(date_diff('day', d, DATE '2001-08-01') / 28.0)::INTEGER AS time_window_ind FROM trx_line")(
    lambda v: v.trx_line.select("date").distinct().select("date", fl.time_window_index("date", ETL_DATE, WINDOW_DAYS).alias("time_window_ind"))
)

SHARED["clean"] = """SELECT cust_id, gender, experian_hh_composition, experian_mosaic_uk_type, CASE WHEN age BETWEEN 18 AND 120 THEN age END AS age,
  coalesce(try_cast(experian_affluence AS INTEGER), 5) AS experian_affluence,
  coalesce(CASE WHEN age BETWEEN 18 AND 120 THEN age END, try_cast(substr(experian_age, 1, 2) AS INTEGER), 56) AS age_to_use FROM customer_master"""
query("clean_demographics", "SELECT cust_id, age, experian_affluence, age_to_use FROM clean")(lambda v: fl.clean_demographics(v.customer_master).select("cust_id", "age", "experian_affluence", "age_to_use"))
query(
    "age_bands",
    "SELECT cust_id, CASE WHEN age_to_use BETWEEN 18 AND 25 THEN '18-25' "
    + " ".join(f"WHEN age_to_use BETWEEN {a} AND {b} THEN '{a}-{b}'" for a, b in fl.AGE_BANDS[1:])
    + " WHEN age_to_use >= 76 THEN '76+' END AS age_band FROM clean",
)(lambda v: fl.clean_demographics(v.customer_master).select("cust_id", fl.age_band("age_to_use").alias("age_band")))
_flags = [("gender_F", "gender", "F"), ("gender_M", "gender", "M"), *((f"hh_comp_{i:02d}", "experian_hh_composition", f"{i:02d}") for i in range(12)), *((f"mosaic_{i:02d}", "experian_mosaic_uk_type", f"{i:02d}") for i in range(67))]
query(
    "one_hot_demographics",
    "SELECT cust_id, " + ", ".join(f"({c} IS NOT DISTINCT FROM '{x}')::INTEGER AS {n}" for n, c, x in _flags) + ", 'Cat_' || coalesce(experian_hh_composition, 'U') AS experian_hh_composition, 'Cat_' || coalesce(experian_mosaic_uk_type, 'U') AS experian_mosaic_uk_type FROM clean",
)(lambda v: fl.one_hot_demographics(fl.clean_demographics(v.customer_master)).drop("age", "experian_affluence", "age_to_use", "gender", "experian_age"))
query("tag_run", "SELECT cust_id, sum(sales_amt)::DOUBLE AS spend, 20010801 AS campaign, 'FD' AS l1_id, false AS category_level FROM scoped GROUP BY cust_id")(
    lambda v: fl.tag_run(v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")), campaign=20010801, l1_id="FD", category_level=False)
)
query("normalise_headers", "SELECT p_partkey AS offer_id, p_brand AS bu_id, p_name AS \"desc\" FROM part")(
    lambda v: fl.normalise_headers(v.table("part").select(F.col("p_partkey").alias("Offer Id"), F.col("p_brand").alias("Business Unit"), F.col("p_name").alias("Offer Text")), {"business_unit": "bu_id", "offer_text": "desc"})
)
# How business units are written in campaign inputs, and their codes.
UNIT_CODES = {
    "WW": "01", "LG": "02", "Lingerie": "02", "MW": "03", "KW": "04", "HF": "05", "HW": "05", "Home": "05", "CoreHome": "05",
    "HB": "07", "BT": "07", "Beauty": "07", "1": "01", "2": "02", "3": "03", "4": "04", "5": "05", "7": "07",
}
UNIT_NAMES = [*UNIT_CODES, "Core Home", "06"]
query("map_bu_codes", f"SELECT p_partkey, coalesce(element_at(MAP {UNIT_CODES!r}, b)[1], b) AS bu_id FROM (SELECT p_partkey, replace({UNIT_NAMES!r}[1 + p_partkey % {len(UNIT_NAMES)}], ' ', '') AS b FROM part)")(
    lambda v: v.table("part").select("p_partkey", F.concat(F.lit(" "), F.get(F.array(*map(F.lit, UNIT_NAMES)), (F.col("p_partkey") % len(UNIT_NAMES)).cast("int")), F.lit("\t")).alias("b")).select("p_partkey", fl.map_codes("b", UNIT_CODES).alias("bu_id"))
)
query("offer_category_hash", "SELECT p_partkey, md5(p_brand || regexp_replace(regexp_replace(lower(p_name), '[0-9]', '', 'g'), '[^a-z_ ]', '', 'g')) AS category_key, [p_size::INTEGER, (p_size + 1)::INTEGER] AS test_sets FROM part")(
    lambda v: v.table("part").select("p_partkey", F.md5(fl.offer_category_key("p_brand", "p_name").cast("binary")).alias("category_key"), F.expr("concat('[', p_size, ', ', p_size + 1, ']')").alias("t")).withColumn("test_sets", fl.parse_int_list("t")).drop("t")
)
query("parse_offer_limits", "SELECT offer_id, [lo, hi]::INTEGER[] AS limits, hi::INTEGER AS upper FROM offer_bands")(
    lambda v: v.offer_bands.select("offer_id", fl.parse_int_list("offer_limits").alias("limits")).withColumn("upper", F.get("limits", F.lit(1)))
)
query("desc_threshold", "SELECT offer_id, pay::DOUBLE AS reward, least::DOUBLE AS threshold FROM offer_bands JOIN bands USING (ord)")(
    lambda v: v.offer_bands.select("offer_id", fl.pounds("offer_desc", 1).alias("reward"), fl.pounds("offer_desc", 2).alias("threshold"))
)
query("clean_scope", "SELECT DISTINCT l2_id || '_fd' AS scope, l2_id AS clean FROM trx_line UNION ALL SELECT DISTINCT l3_id || '_x_gm', l3_id || '_x' FROM trx_line")(
    lambda v: v.trx_line.select(F.concat("l2_id", F.lit("_fd")).alias("scope")).distinct().unionByName(v.trx_line.select(F.concat("l3_id", F.lit("_x_gm")).alias("scope")).distinct()).withColumn("clean", fl.clean_scope("scope"))
)
query("scope_export_columns", "SELECT cust_id, l2_id || '_fd' AS scope, l2_id || '_fd_spend' AS mechanic, false AS test_accounts, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id, l2_id")(
    lambda v: v.scoped.groupBy("cust_id", "l2_id").agg(F.sum("sales_amt").cast("double").alias("spend")).select("cust_id", F.concat("l2_id", F.lit("_fd")).alias("scope"), F.concat("l2_id", F.lit("_fd_spend")).alias("mechanic"), F.lit(False).alias("test_accounts"), "spend")
)
query("null_counts", "SELECT * FROM (SELECT 'age' AS column_name, count(*) FILTER (WHERE age IS NULL) AS n_null FROM customer_master UNION ALL SELECT 'gender', count(*) FILTER (WHERE gender IS NULL) FROM customer_master UNION ALL SELECT 'experian_hh_composition', count(*) FILTER (WHERE experian_hh_composition IS NULL) FROM customer_master UNION ALL SELECT 'experian_mosaic_uk_type', count(*) FILTER (WHERE experian_mosaic_uk_type IS NULL) FROM customer_master) WHERE n_null > 0")(lambda v: fl.null_counts(v.customer_master))
query("gender_target", "SELECT cust_id, CASE WHEN m AND w THEN 'Both' WHEN m THEN 'Men' WHEN w THEN 'Women' END AS gender FROM (SELECT cust_id, bool_or(l3_id IN ('Brand#1', 'Brand#2')) AS m, bool_or(l3_id IN ('Brand#3', 'Brand#5')) AS w FROM scoped GROUP BY cust_id)")(
    lambda v: v.scoped.groupBy("cust_id").agg(F.collect_set("l3_id").alias("u")).select("cust_id", fl.gender_target("u", ("Brand#1", "Brand#2"), ("Brand#3", "Brand#5")).alias("gender"))
)

# joins
query("article_enrich", f"SELECT cust_id, basket_id, article_id, sales_amt, l2_id FROM trx_line WHERE l2_id IN {L2_SQL}")(lambda v: jn.article_enrich(v.trx_line.select(*KEY.split(", "), "l2_id"), v.lu_article, L2).select(*KEY.split(", "), "l2_id"))
query("category_membership", "SELECT article_id, category, synthetic FROM membership")(lambda v: jn.category_membership(v.lu_article, v.rules, L2))
query("segment_semi", f"SELECT {KEY} FROM scoped WHERE cust_id IN (SELECT cust_id FROM customer_master WHERE gender = 'F')")(lambda v: v.scoped.join(v.customer_master.filter("gender = 'F'").select("cust_id"), "cust_id", "left_semi").select(*KEY.split(", ")))
query("segment_attach", "SELECT cust_id, spend, segmentation, band FROM (SELECT cust_id, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id) JOIN (SELECT cust_id, min(yyyymmdd % 7) AS segmentation, arg_min(coalesce(cust_band_fd, 'none'), (yyyymmdd % 7, coalesce(cust_band_fd, 'none'))) AS band FROM band_history GROUP BY cust_id) USING (cust_id)")(
    lambda v: jn.segment_attach(v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")), v.band_history.select("cust_id", (F.col("yyyymmdd") % 7).alias("segmentation"), F.coalesce("cust_band_fd", F.lit("none")).alias("band")))
)
query("account_join", f"SELECT {KEY} FROM scoped WHERE cust_id IN (SELECT cust_id FROM accounts WHERE registration_date IS NOT NULL)")(lambda v: v.scoped.join(v.accounts.filter("registration_date is not null"), "cust_id", "left_semi").select(*KEY.split(", ")))
query("demographic_left", "SELECT cust_id, spend, age, gender FROM (SELECT cust_id, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id) LEFT JOIN customer_master USING (cust_id)")(
    lambda v: v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")).join(v.customer_master.select("cust_id", "age", "gender"), "cust_id", "left")
)
query("customer_item_cross", f"SELECT cust_id, item FROM (SELECT DISTINCT cust_id FROM scoped), (SELECT DISTINCT l2_id AS item FROM lu_article WHERE l2_id IN {L2_SQL})")(
    lambda v: jn.customer_item_cross(v.scoped, "cust_id", v.lu_article.filter(F.col("l2_id").isin(*L2)).select(F.col("l2_id").alias("item")).distinct())
)
SHARED["nation_spend"] = "SELECT area_name, l2_id, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY ALL"
query("audience_right", "SELECT cust_id, spend FROM (SELECT cust_id, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id) RIGHT JOIN (SELECT DISTINCT cust_id FROM customer_master WHERE gender = 'M') USING (cust_id)")(
    lambda v: v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")).join(v.customer_master.filter("gender = 'M'").select("cust_id").distinct(), "cust_id", "right")
)
query("eligible_inner", "SELECT cust_id, spend FROM (SELECT cust_id, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id) WHERE cust_id IN (SELECT cust_id FROM eligibility WHERE channel = 'Email' AND country = 'UK' AND type = 'Member' AND marketing_status = 'Opt-in Active')")(
    lambda v: jn.eligible(v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")), v.eligibility)
)
query("first_account_link", "SELECT cust_id, a.account_id AS account_id, a.uk_digital_id AS uk_digital_id FROM (SELECT DISTINCT cust_id FROM scoped) LEFT JOIN (SELECT cust_id, min((account_id, uk_digital_id)) AS m, min(account_id) AS account_id, arg_min(uk_digital_id, account_id) AS uk_digital_id FROM accounts GROUP BY cust_id) a USING (cust_id)")(
    lambda v: jn.first_account_link(v.scoped, v.accounts)
)
query("id_mapping", "SELECT DISTINCT cust_id, account_id, registration_date FROM accounts WHERE registration_date IS NOT NULL")(lambda v: v.accounts.filter("registration_date is not null").select("cust_id", "account_id", "registration_date").distinct())
query("latest_snapshot", "SELECT cust_id, yyyymmdd, cust_band_fd, cust_band_ch FROM band_history WHERE yyyymmdd = (SELECT max(yyyymmdd) FROM band_history WHERE yyyymmdd <= 20010801)")(lambda v: jn.latest_snapshot(v.band_history, ETL_DATE))
query("band_snapshot_left", "SELECT cust_id, spend, cust_band_fd FROM (SELECT cust_id, sum(sales_amt)::DOUBLE AS spend FROM scoped GROUP BY cust_id) LEFT JOIN (SELECT cust_id, cust_band_fd FROM band_history WHERE yyyymmdd = 20010701) USING (cust_id)")(
    lambda v: v.scoped.groupBy("cust_id").agg(F.sum("sales_amt").cast("double").alias("spend")).join(jn.latest_snapshot(v.band_history, ETL_DATE).select("cust_id", "cust_band_fd"), "cust_id", "left")
)

# metrics
query("cust_category_metrics", "SELECT cust_id, l2_id, count(l2_id)::INTEGER AS number_of_transactions, sum(sales_amt)::DOUBLE AS total_spend, count(article_id)::INTEGER AS items, count(DISTINCT basket_id)::INTEGER AS visits, sum(sales_amt)::DOUBLE / count(sales_amt) AS spend_per_item FROM scoped GROUP BY ALL")(lambda v: mt.cust_category_metrics(v.scoped))
query("cust_total_metrics", "SELECT cust_id, count(l2_id)::INTEGER AS total_number_of_transactions, sum(sales_amt)::DOUBLE AS total_spend_amount, count(DISTINCT basket_id)::INTEGER AS total_visits, count(article_id)::INTEGER AS total_items, count(DISTINCT basket_id)::INTEGER AS sum_baskets, count(DISTINCT l2_id) AS count_of_lx FROM scoped GROUP BY ALL")(lambda v: mt.cust_total_metrics(v.scoped))
query("cust_activity_counts", "SELECT * FROM activity")(lambda v: mt.cust_activity_counts(v.scoped))
query("percentile_profile", f"SELECT l2_id, {profile_sql('sales_amt')} FROM recent GROUP BY l2_id")(lambda v: mt.group_profile(v.recent, ["l2_id"], "sales_amt"))
query("basket_profile_by_category", f"SELECT cust_id, l2_id, {profile_sql('total_spend_basket')}, {profile_sql('items_per_basket')} FROM (SELECT cust_id, l2_id, basket_id, sum(sales_amt) AS total_spend_basket, count(*) AS items_per_basket FROM scoped GROUP BY ALL) GROUP BY ALL")(lambda v: mt.basket_profile(v.scoped, "l2_id"))
query("basket_profile", f"SELECT cust_id, {profile_sql('total_spend_basket')}, {profile_sql('items_per_basket')} FROM baskets GROUP BY ALL")(lambda v: mt.basket_profile(v.scoped))
query("window_profile", f"SELECT cust_id, l2_id, {profile_sql('total_spend_time_window')}, {profile_sql('basket_per_time_window')} FROM cat_windows GROUP BY ALL")(lambda v: mt.window_profile(v.scoped, "l2_id"))
query("window_max_basket_profile", f"SELECT cust_id, l2_id, {profile_sql('time_window_max_spend_basket')} FROM (SELECT cust_id, l2_id, win, max(t) AS time_window_max_spend_basket FROM (SELECT cust_id, l2_id, win, basket_id, sum(sales_amt) AS t FROM scoped GROUP BY ALL) GROUP BY ALL) GROUP BY ALL")(lambda v: mt.window_max_basket_profile(v.scoped, "l2_id"))
_labels = ["average_time_window_max_spend_basket", *(f"{p}percentile_time_window_max_spend_basket" for p in (50, 75, 85, 90, 100))]
SHARED["window_max_wide"] = f"SELECT cust_id, {profile_sql('time_window_max_spend_basket')} FROM window_max GROUP BY ALL"
query("window_max_basket_unpivot", " UNION ALL ".join(f"SELECT cust_id, '{x}' AS label, \"{x}\" AS weekly_max_basket_percentile FROM window_max_wide" for x in _labels))(lambda v: mt.window_max_basket_unpivot(v.scoped))
query("category_window_p85", "SELECT cust_id, l2_id, quantile_disc(total_spend_time_window, 0.85)::DOUBLE AS total_time_window_spend FROM cat_windows GROUP BY ALL")(lambda v: mt.category_window_percentile(v.scoped))


def _spans(v):
    return rl.rolling_days_sum(v.scoped.withColumn("day_no", F.datediff(fl.as_date(F.lit(fl.shifted(ETL_DATE, -HISTORY))), fl.as_date("date"))), 30, "backward").withColumn("spend_timespan", F.col("spend_timespan").cast("decimal(22,2)"))


_start = f"strptime('{fl.shifted(ETL_DATE, -HISTORY)}', '%Y%m%d')::DATE"
SHARED["spans"] = f"SELECT cust_id, basket_id, article_id, sum(sales_amt) OVER (PARTITION BY cust_id ORDER BY date_diff('day', d, {_start}) RANGE BETWEEN 30 PRECEDING AND CURRENT ROW) AS spend_timespan FROM scoped"
query("rolling_days_sum", "SELECT cust_id, basket_id, article_id, spend_timespan::DOUBLE AS spend_timespan FROM spans")(lambda v: _spans(v).select("cust_id", "basket_id", "article_id", F.col("spend_timespan").cast("double").alias("spend_timespan")))
query("timespan_spend_profile", f"SELECT cust_id, {profile_sql('spend_timespan')} FROM spans GROUP BY cust_id")(lambda v: _spans(v).groupBy("cust_id").agg(*numeric.profile("spend_timespan")))


def weekly(v, *keys):
    return v.recent.withColumn("week", fl.week_number("date", 19950102)).groupBy(*keys, "week").agg(F.sum("sales_amt").alias("total"))


query("weekly_sales", "SELECT l2_id, cust_id, week, total::DOUBLE AS total FROM weekly")(lambda v: weekly(v, "l2_id", "cust_id").withColumn("total", F.col("total").cast("double")))
query("weekly_units", "SELECT cust_id, (date_diff('day', DATE '1995-01-02', d) // 7 + 1)::INTEGER AS week, sum(item_qty)::BIGINT AS units FROM recent GROUP BY ALL")(
    lambda v: v.recent.groupBy("cust_id", fl.week_number("date", 19950102).alias("week")).agg(F.sum("item_qty").alias("units"))
)
query("rolling_weeks_sum", "SELECT cust_id, ordinal, rolling::DOUBLE AS rolling FROM dense WHERE ordinal >= 4")(lambda v: rl.rolling_weeks_dense(weekly(v, "cust_id"), ["cust_id"], 4).select("cust_id", F.col("ordinal").cast("long").alias("ordinal"), F.col("rolling").cast("double").alias("rolling")))
query("rolling_weeks_sparse", "SELECT cust_id, ordinal, rolling::DOUBLE AS rolling FROM dense WHERE ordinal >= 4 AND rolling > 0")(lambda v: rl.rolling_weeks_sparse(weekly(v, "cust_id"), ["cust_id"], 4).select("cust_id", F.col("at").cast("long").alias("ordinal"), F.col("rolling").cast("double").alias("rolling")))
query("baseline_percentiles", "SELECT cust_id, " + ", ".join(f'quantile_disc(rolling, {p / 100})::DOUBLE AS "{p}th_percentile"' for p in (50, 85, 95, 100)) + " FROM dense WHERE ordinal >= 4 GROUP BY cust_id")(
    lambda v: rl.rolling_weeks_percentiles(weekly(v, "cust_id"), ["cust_id"], 4, (50, 85, 95, 100))
)
query("category_unit_price", "SELECT * FROM category_price_t")(lambda v: mt.category_unit_price(v.scoped))
query("customer_unit_price", "SELECT * FROM customer_price_t")(lambda v: mt.customer_unit_price(v.scoped))
query("final_unit_price", "SELECT * FROM final_price")(lambda v: mt.final_unit_price(mt.customer_unit_price(v.scoped), mt.category_unit_price(v.scoped)))
query("avg_units_nonzero", "SELECT cust_id, coalesce(u, 0)::DOUBLE AS avg_weekly_article_count FROM (SELECT DISTINCT cust_id FROM scoped) LEFT JOIN (SELECT cust_id, sum(units)::DOUBLE / count(*) AS u FROM (SELECT cust_id, win, sum(item_qty) AS units FROM scoped GROUP BY ALL) WHERE units > 0 GROUP BY cust_id) USING (cust_id)")(
    lambda v: v.scoped.groupBy("cust_id", "win").agg(F.sum("item_qty").alias("units")).groupBy("cust_id").agg(F.coalesce(F.sum(F.when(F.col("units") > 0, F.col("units"))).cast("double") / F.count(F.when(F.col("units") > 0, 1)), F.lit(0.0)).alias("avg_weekly_article_count"))
)
_deps = ("FD", "GM")
SHARED["pivoted"] = "SELECT cust_id, " + ", ".join(f"coalesce(sum(sales_amt) FILTER (WHERE l1_id = '{x}'), 0)::DOUBLE AS {x}_spend, coalesce(sum(item_qty) FILTER (WHERE l1_id = '{x}'), 0)::BIGINT AS {x}_items, count(DISTINCT basket_id) FILTER (WHERE l1_id = '{x}') AS {x}_baskets" for x in _deps) + " FROM counted GROUP BY cust_id"
query(
    "channel_pivot_spend",
    "SELECT *, FD_spend + GM_spend AS total_spend, FD_items + GM_items AS total_items, FD_baskets + GM_baskets AS total_baskets, "
    + ", ".join(f"CASE WHEN FD_{p} + GM_{p} = 0 THEN NULL ELSE {x}_{p}::DOUBLE / (FD_{p} + GM_{p})::DOUBLE END AS {x}_{p}_share" for x in _deps for p in ("spend", "items", "baskets"))
    + " FROM pivoted WHERE FD_spend >= 0.1",
)(lambda v: mt.channel_pivot_spend(v.trx_line.filter(fl.common_filters())))
query("complete_cells_only", "SELECT cust_id, l2_id FROM cat_windows WHERE cust_id IN (SELECT cust_id FROM cat_windows GROUP BY cust_id HAVING count(*) = (SELECT max(n) FROM (SELECT count(*) AS n FROM cat_windows GROUP BY cust_id)))")(
    lambda v: mt.complete_only(mt.window_totals(v.scoped, "l2_id").select("cust_id", "l2_id"), ["cust_id"])
)
query("segment_counts", "SELECT area_name, cust_gender, count(*) AS n_rows FROM scoped GROUP BY ALL")(lambda v: mt.group_counts(v.scoped, "area_name", "cust_gender").orderBy(F.desc("n_rows")))
query("window_max_mark", "SELECT cust_id, win, basket_id, total_spend_basket::DOUBLE AS spend FROM window_baskets QUALIFY total_spend_basket = max(total_spend_basket) OVER (PARTITION BY cust_id, win)")(
    lambda v: rl.window_max_mark(mt.basket_totals(v.scoped, "win")).select("cust_id", "win", "basket_id", F.col("total_spend_basket").cast("double").alias("spend"))
)


def near_window(v):
    return rl.nearest_above_percentile(mt.window_totals(v.scoped).select("cust_id", "win", "total_spend_time_window"), "total_spend_time_window", ["win"])


SHARED["near_w"] = "SELECT cust_id, arg_min(win, (total_spend_time_window, win)) AS win FROM windows JOIN (SELECT cust_id, quantile_disc(total_spend_time_window, 0.85) AS p FROM windows GROUP BY cust_id) USING (cust_id) WHERE total_spend_time_window >= p GROUP BY cust_id"
SHARED["near_b"] = "SELECT cust_id, arg_min(basket_id, (total_spend_basket, basket_id)) AS basket_id FROM (SELECT * FROM window_baskets QUALIFY total_spend_basket = max(total_spend_basket) OVER (PARTITION BY cust_id, win)) JOIN (SELECT cust_id, quantile_disc(time_window_max_spend_basket, 0.85) AS p FROM window_max GROUP BY cust_id) USING (cust_id) WHERE total_spend_basket >= p GROUP BY cust_id"
query("nearest_p85_window", "SELECT cust_id, l2_id, sum(sales_amt)::DOUBLE AS total_time_window_spend FROM scoped JOIN near_w USING (cust_id, win) GROUP BY ALL")(
    lambda v: v.scoped.join(near_window(v).select("cust_id", "win"), ["cust_id", "win"]).groupBy("cust_id", "l2_id").agg(F.sum("sales_amt").cast("double").alias("total_time_window_spend"))
)


def _near_basket(v):
    marked = rl.window_max_mark(mt.basket_totals(v.scoped, "win"))
    p = mt.window_max_basket(v.scoped).groupBy("cust_id").agg(F.percentile_approx("time_window_max_spend_basket", 0.85, 10_000).alias("p"))
    near = marked.join(p, "cust_id").filter("total_spend_basket >= p").groupBy("cust_id").agg(F.min(F.struct("total_spend_basket", "basket_id")).alias("s"))
    return v.scoped.join(near.select("cust_id", "s.basket_id"), ["cust_id", "basket_id"]).groupBy("cust_id", "l2_id").agg(F.sum("sales_amt").cast("double").alias("total_spend_basket"))


query("nearest_p85_basket", "SELECT cust_id, l2_id, sum(sales_amt)::DOUBLE AS total_spend_basket FROM scoped JOIN near_b USING (cust_id, basket_id) GROUP BY ALL")(_near_basket)
query("percent_rank_of_baseline", "SELECT l2_id, v, percentile_rank FROM (SELECT l2_id, v, b, percent_rank() OVER (PARTITION BY l2_id ORDER BY v) AS percentile_rank FROM (SELECT l2_id, total_spend_time_window::DOUBLE AS v, 0 AS b FROM cat_windows UNION ALL SELECT l2_id, quantile_disc(total_spend_time_window, 0.5)::DOUBLE, 1 FROM (SELECT * FROM cat_windows WHERE win < 3) GROUP BY l2_id)) WHERE b = 1")(
    lambda v: rl.percent_rank_of_baseline(mt.window_totals(v.scoped, "l2_id"), percentiles(mt.window_totals(v.scoped, "l2_id").filter("win < 3"), ["l2_id"], "total_spend_time_window", [0.5]).select("l2_id", F.col("steps")[0].alias("v")), ["l2_id"], "total_spend_time_window")
)
query("share_of_total", "SELECT l2_id, n_rows, floor(1000.0::DOUBLE * n_rows / (sum(n_rows) OVER ()) + 0.5) / 1000.0::DOUBLE AS share FROM (SELECT l2_id, count(*) AS n_rows FROM scoped GROUP BY l2_id)")(lambda v: rl.share_of_total(mt.group_counts(v.scoped, "l2_id")))
query("distinct_rows", "SELECT DISTINCT cust_id, l2_id, purchase_channel FROM trx_line")(lambda v: v.trx_line.select("cust_id", "l2_id", "purchase_channel").distinct())
query("duplicate_rows", "SELECT cust_id, l2_id, purchase_channel, count(*) AS n FROM trx_line GROUP BY ALL HAVING count(*) > 1")(lambda v: v.trx_line.groupBy("cust_id", "l2_id", "purchase_channel").agg(F.count("*").alias("n")).filter("n > 1"))
query("etl_data", "SELECT c.cust_id, c.l2_id, number_of_transactions, total_spend, items, visits, spend_per_item, total_time_window_spend, count_user_basket, count_user_time_window FROM (SELECT cust_id, l2_id, count(l2_id)::INTEGER AS number_of_transactions, sum(sales_amt)::DOUBLE AS total_spend, count(article_id)::INTEGER AS items, count(DISTINCT basket_id)::INTEGER AS visits, sum(sales_amt)::DOUBLE / count(sales_amt) AS spend_per_item FROM scoped GROUP BY ALL) c JOIN (SELECT cust_id, l2_id, sum(sales_amt)::DOUBLE AS total_time_window_spend FROM scoped JOIN near_w USING (cust_id, win) GROUP BY ALL) USING (cust_id, l2_id) JOIN activity USING (cust_id)")(
    lambda v: mt.cust_category_metrics(v.scoped)
    .join(v.scoped.join(near_window(v).select("cust_id", "win"), ["cust_id", "win"]).groupBy("cust_id", "l2_id").agg(F.sum("sales_amt").cast("double").alias("total_time_window_spend")), ["cust_id", "l2_id"])
    .join(mt.cust_activity_counts(v.scoped), "cust_id")
)

# totals kept from day to day, and sketches kept by week
STEPS = 10


def _kept(v, by):
    """A store as of ten days before the campaign, moved on by so many days a step; the lines are read once."""
    columns = ("cust_id", "l2_id", "basket_id", "sales_amt", "item_qty", "date")
    first = fl.shifted(ETL_DATE, -LOOKBACK - STEPS)
    lines = v.hold("kept_lines", lambda v: v.counted_days(first, ETL_DATE).select(*columns))
    store = dy.Store(v.spark, shared_folder(v.spark), {"cust_id": "bigint", "l2_id": "string"}, LOOKBACK, WINDOW_DAYS)
    days = [fl.shifted(ETL_DATE, i - STEPS) for i in range(0, STEPS + 1, by)]
    dy.build(store, lines, days[0])
    for before, day in zip(days, days[1:], strict=False):
        dy.step(store, lines, before, day)
    return store


_SUMS = "sum(sales_amt)::DOUBLE AS spend, sum(item_qty)::BIGINT AS units, count(*) AS n_lines, count(DISTINCT basket_id) AS baskets"
query("kept_weekly_totals", f"SELECT cust_id, l2_id, (date_diff('day', DATE '1995-01-02', d) // 7 + 1)::INTEGER AS week, {_SUMS} FROM recent GROUP BY ALL")(
    lambda v: _kept(v, 1).weeks().withColumn("spend", F.col("spend").cast("double"))
)
query("kept_window_totals", f"SELECT cust_id, l2_id, win, {_SUMS} FROM recent GROUP BY ALL")(lambda v: _kept(v, 5).windows(ETL_DATE).withColumn("spend", F.col("spend").cast("double")))

SPANS = (4, 13, 52)
SHARED["cents"] = "SELECT l2_id, (date_diff('day', DATE '1995-01-02', d) // 7 + 1)::INTEGER AS week, (sales_amt * 100)::BIGINT AS c FROM recent"
SHARED["week_cents"] = "SELECT l2_id, week, (total * 100)::BIGINT AS c FROM weekly"


def _sketch_sql(cents: str) -> str:
    return f"""SELECT l2_id, span, percent, n_rows, lo / 100.0::DOUBLE AS lower, hi / 100.0::DOUBLE AS upper, n::DOUBLE / n_rows::DOUBLE AS rank_error
        FROM (SELECT *, (sum(n) OVER (PARTITION BY l2_id, span ORDER BY lo))::BIGINT AS upto, (sum(n) OVER (PARTITION BY l2_id, span))::BIGINT AS n_rows
          FROM (SELECT l2_id, span, c >> spare << spare AS lo, ((c >> spare) + 1 << spare) - 1 AS hi, count(*) AS n
            FROM (SELECT *, greatest(length(bin(c)) - 7, 0) AS spare FROM {cents}), (VALUES (4), (13), (52)) AS s(span)
            WHERE week > date_diff('day', DATE '1995-01-02', DATE '2001-08-01') // 7 + 1 - span GROUP BY ALL)),
        (VALUES (50), (75), (85), (95), (100)) AS p(percent) WHERE upto >= (percent * n_rows + 99) // 100 AND upto - n < (percent * n_rows + 99) // 100"""


def _sketched(v, rows, value):
    """Percentiles of the last weeks from sketches written once by week: every span without the lines."""
    path, last = shared_folder(v.spark), dy.Store(v.spark, "", {}).week_of(ETL_DATE)
    sk.put_weeks(rows, path, ["l2_id"], value)
    spans = [sk.over_weeks(v.spark, path, ["l2_id"], last - n + 1, last).withColumn("span", F.lit(n)) for n in SPANS]
    return sk.quantiles(spans[0].unionByName(spans[1]).unionByName(spans[2]), ["l2_id", "span"], (50, 75, 85, 95, 100))


query("sketched_percentile_profile", _sketch_sql("cents"))(lambda v: _sketched(v, v.recent.select("l2_id", "sales_amt", fl.week_number("date", 19950102).alias("week")), "sales_amt"))
query("sketched_weekly_percentiles", _sketch_sql("week_cents"))(lambda v: _sketched(v, weekly(v, "l2_id", "cust_id"), "total"))
