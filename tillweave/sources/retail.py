"""Retail views over the star schema: lines, articles, accounts, demographics, offers.

Config-like data (offer bands, category rules) are plain values; everything else follows the tables.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.functions.local import local_rows
from tillweave.operators import filters as fl
from tillweave.sources.scratch import stored

ETL_DATE, LOOKBACK, HISTORY, WINDOW_DAYS, SEED = 20010801, 363, 2400, 28, 7
# Spend bands (from, to), reward and threshold in pounds.
BANDS = (
    (0, 21, 5, 30), (21, 50, 5, 50), (50, 70, 7, 70), (70, 90, 9, 90), (90, 110, 11, 110), (110, 130, 13, 130), (130, 150, 15, 150),
    (150, 170, 17, 170), (170, 190, 19, 190), (190, 210, 21, 210), (210, 230, 23, 230), (230, 250, 25, 250), (250, 270, 27, 270),
)
CATEGORY_RULES = (("brand_mix", "l3_id", "Brand#1"), ("brand_mix", "l3_id", "Brand#2"), ("small_pack", "l4_id", "Brand#1-0"), ("small_pack", "l4_id", "Brand#3-0"), ("small_pack", "l2_id", "SMALL"))


def int_of(column: str) -> str:
    return f"year({column}) * 10000 + month({column}) * 100 + day({column})"


class Views:
    """Lazily built DataFrames of one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir, self.held = spark, sf_dir, {}

    def hold(self, name: str, build: Callable[[Views], DataFrame]) -> DataFrame:
        """The table that build makes, written once to the shared folder: for steps that several branches of a plan use."""
        if name not in self.held:
            self.held[name] = stored(build(self))
        return self.held[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @cached_property
    def trx_line(self) -> DataFrame:
        return self.lines()

    def lines(self, first: int | None = None, last: int | None = None) -> DataFrame:
        """Transaction lines; with bounds (yyyymmdd, inclusive) only orders of these days are scanned."""
        t = self.table
        orders = t("orders") if first is None else t("orders").filter(fl.days_between("o_orderdate", first, last))
        joined = (
            t("lineitem").join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t("part"), F.col("l_partkey") == F.col("p_partkey"))
            .join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        )
        lines = joined.selectExpr(
            "o_custkey as cust_id", "l_orderkey as basket_id", "l_partkey as article_id",
            "cast(floor(l_extendedprice * (1D - l_discount) / 10D + 0.5D) / 100D as decimal(12,2)) as sales_amt",
            "cast(floor(p_retailprice + p_size * 10D + 0.5D) / 100D as decimal(12,2)) as unit_full_price",
            "cast(l_quantity as int) as item_qty", "year(o_orderdate) as year", "month(o_orderdate) as month", "day(o_orderdate) as day",
            "if(l_returnflag = 'R', 'R', 'S') as trans_line_type", "if(l_linestatus = 'O', 'POS', 'ONLINE') as purchase_channel",
            "if(p_type in ('ECONOMY', 'SMALL', 'STANDARD', 'MEDIUM'), 'FD', 'GM') as l1_id", "if(p_size = 50, 'FOPA', p_type) as l2_id",
            "if(p_brand = 'Brand#25', '40', p_brand) as l3_id", "if(p_size = 49, 'T46', concat(p_brand, '-', cast(p_size div 10 as string))) as l4_id",
            "if(n_name = 'NATION_0', 'PETROL STATIONS', n_name) as area_name", "cast(18 + o_custkey % 75 as int) as cust_age",
            "case o_custkey % 3 when 0 then 'F' when 1 then 'M' end as cust_gender",
        )
        return lines.withColumn("date", fl.int_date())

    @cached_property
    def lu_article(self) -> DataFrame:
        out = self.table("part").selectExpr(
            "p_partkey as article_id", "if(p_type in ('ECONOMY', 'SMALL', 'STANDARD', 'MEDIUM'), 'FD', 'GM') as l1_id", "if(p_size = 50, 'FOPA', p_type) as l2_id",
            "if(p_brand = 'Brand#25', '40', p_brand) as l3_id", "if(p_size = 49, 'T46', concat(p_brand, '-', cast(p_size div 10 as string))) as l4_id",
            "concat(p_type, p_size) as l5_id", "cast(p_partkey as string) as l6_id",
        )
        return out.withColumns({f"l{i}_name": F.concat(F.lit("N_"), F.col(f"l{i}_id")) for i in range(1, 7)})

    @cached_property
    def accounts(self) -> DataFrame:
        first = self.table("customer").selectExpr(
            "concat('A', c_custkey) as account_id", "c_custkey as cust_id", "concat('D', c_custkey) as uk_digital_id",
            "if(c_custkey % 20 = 0, null, cast(date_add(date'1996-01-01', cast(c_custkey % 1500 as int)) as timestamp_ntz)) as registration_date",
        )
        return first.unionByName(first.filter("cust_id % 50 = 0").withColumn("account_id", F.concat(F.lit("B"), F.col("cust_id"))))

    @cached_property
    def customer_master(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as cust_id", "cast(case when c_custkey % 97 = 0 then 150 when c_custkey % 4 = 0 then null else 18 + c_custkey % 75 end as int) as age",
            "case c_custkey % 3 when 0 then 'F' when 1 then 'M' end as gender",
            "if(c_custkey % 13 = 0, 'U', concat(20 + 5 * (c_custkey % 10), '-', 24 + 5 * (c_custkey % 10))) as experian_age",
            "if(c_custkey % 17 = 0, 'x', cast(c_custkey % 20 as string)) as experian_affluence",
            "if(c_custkey % 19 = 0, null, lpad(cast(c_custkey % 13 as string), 2, '0')) as experian_hh_composition",
            "if(c_custkey % 23 = 0, null, lpad(cast(c_custkey % 67 as string), 2, '0')) as experian_mosaic_uk_type",
        )

    @cached_property
    def band_history(self) -> DataFrame:
        dates = F.explode(F.array(*map(F.lit, (20010101, 20010401, 20010701, 20011001))))
        band = "case when c_custkey % 29 = 0 then null when c_acctbal > {0} then '1. Top' when c_acctbal > {1} then '2. Core' else '3. Occ' end"
        return self.table("customer").select("c_custkey", "c_acctbal", dates.alias("yyyymmdd")).selectExpr(
            "c_custkey as cust_id", "yyyymmdd", f"{band.format(6000, 2000)} as cust_band_fd", f"{band.format(4000, 1000)} as cust_band_ch"
        )

    @cached_property
    def offer_bands(self) -> DataFrame:
        """Offer bands of the whole basket and of every product group that articles have."""
        return self._bands_of(self.lu_article.select(F.col("l2_id").alias("target")).distinct()).unionByName(self.basket_offers)

    @cached_property
    def basket_offers(self) -> DataFrame:
        """Offer bands of the whole basket: plain values, no scan."""
        return self._bands_of(local_rows(self.spark, [("full_basket",)], "target string"))

    def _bands_of(self, targets: DataFrame) -> DataFrame:
        bands = local_rows(self.spark, [(i, *b, r) for i, b in enumerate(BANDS) for r in (7, 10)], "ord int, lo int, hi int, pay int, least int, reward_perc int")
        return targets.crossJoin(F.broadcast(bands)).selectExpr(
            "'FD' as l1_id", "target", "reward_perc", "cast(ord + 1 + 100 * reward_perc + 10000 * length(target) as bigint) as offer_id",
            "concat('[', lo, ',', hi, ']') as offer_limits", "concat('£', pay, ' off when you spend £', least, ' on food in store') as offer_desc", "lo", "hi", "ord",
        )

    @cached_property
    def eligibility(self) -> DataFrame:
        return self.table("customer").selectExpr(
            "c_custkey as cust_id", "if(c_custkey % 5 = 0, 'Post', 'Email') as channel", "if(c_custkey % 7 = 0, 'IE', 'UK') as country",
            "if(c_custkey % 11 = 0, 'Other', 'Member') as type", "if(c_custkey % 6 = 0, 'Opt-out', 'Opt-in Active') as marketing_status",
        )

    def counted_days(self, first: int, last: int) -> DataFrame:
        """Counted food lines of the days first to last."""
        lines = self.lines(first, last)
        lines = lines.filter(fl.common_filters() & F.col("date").between(first, last) & fl.channel_filter("FD") & (F.col("l1_id") == "FD") & fl.outside_season())
        return lines.filter(F.col("sales_amt") > 0.5)

    def _counted(self, days: int) -> DataFrame:
        return self.counted_days(fl.shifted(ETL_DATE, -days), ETL_DATE).withColumn("win", fl.time_window_index("date", ETL_DATE, WINDOW_DAYS))

    @cached_property
    def scoped(self) -> DataFrame:
        """Counted food lines of the long history, with window index."""
        return self._counted(HISTORY)

    @cached_property
    def recent(self) -> DataFrame:
        return self._counted(LOOKBACK)

    @cached_property
    def rules(self) -> DataFrame:
        return local_rows(self.spark, list(CATEGORY_RULES), "offer string, level string, id string")


#: The same views for the checking engine, as bodies of common table expressions.
DUCK = {
    "trx_line": """SELECT o_custkey AS cust_id, l_orderkey AS basket_id, l_partkey AS article_id,
      CAST(floor(l_extendedprice * (1::DOUBLE - l_discount) / 10::DOUBLE + 0.5::DOUBLE) / 100::DOUBLE AS DECIMAL(12,2)) AS sales_amt,
      CAST(floor(p_retailprice + p_size * 10::DOUBLE + 0.5::DOUBLE) / 100::DOUBLE AS DECIMAL(12,2)) AS unit_full_price,
      CAST(l_quantity AS INTEGER) AS item_qty, year(o_orderdate)::INTEGER AS year, month(o_orderdate)::INTEGER AS month, day(o_orderdate)::INTEGER AS day,
      CASE WHEN l_returnflag = 'R' THEN 'R' ELSE 'S' END AS trans_line_type, CASE WHEN l_linestatus = 'O' THEN 'POS' ELSE 'ONLINE' END AS purchase_channel,
      CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'STANDARD', 'MEDIUM') THEN 'FD' ELSE 'GM' END AS l1_id, CASE WHEN p_size = 50 THEN 'FOPA' ELSE p_type END AS l2_id,
      CASE WHEN p_brand = 'Brand#25' THEN '40' ELSE p_brand END AS l3_id, CASE WHEN p_size = 49 THEN 'T46' ELSE p_brand || '-' || (p_size // 10) END AS l4_id,
      CASE WHEN n_name = 'NATION_0' THEN 'PETROL STATIONS' ELSE n_name END AS area_name, CAST(18 + o_custkey % 75 AS INTEGER) AS cust_age,
      CASE o_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS cust_gender,
      (year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate))::INTEGER AS date, o_orderdate::DATE AS d
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "lu_article": """SELECT p_partkey AS article_id, CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'STANDARD', 'MEDIUM') THEN 'FD' ELSE 'GM' END AS l1_id,
      CASE WHEN p_size = 50 THEN 'FOPA' ELSE p_type END AS l2_id, CASE WHEN p_brand = 'Brand#25' THEN '40' ELSE p_brand END AS l3_id,
      CASE WHEN p_size = 49 THEN 'T46' ELSE p_brand || '-' || (p_size // 10) END AS l4_id, p_type || p_size AS l5_id, p_partkey::VARCHAR AS l6_id FROM part""",
    "accounts": """SELECT 'A' || c_custkey AS account_id, c_custkey AS cust_id, 'D' || c_custkey AS uk_digital_id,
      CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE (DATE '1996-01-01' + (c_custkey % 1500)::INTEGER)::TIMESTAMP END AS registration_date FROM customer
      UNION ALL SELECT 'B' || c_custkey, c_custkey, 'D' || c_custkey, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE (DATE '1996-01-01' + (c_custkey % 1500)::INTEGER)::TIMESTAMP END FROM customer WHERE c_custkey % 50 = 0""",
    "customer_master": """SELECT c_custkey AS cust_id, (CASE WHEN c_custkey % 97 = 0 THEN 150 WHEN c_custkey % 4 = 0 THEN NULL ELSE 18 + c_custkey % 75 END)::INTEGER AS age,
      CASE c_custkey % 3 WHEN 0 THEN 'F' WHEN 1 THEN 'M' END AS gender,
      CASE WHEN c_custkey % 13 = 0 THEN 'U' ELSE (20 + 5 * (c_custkey % 10)) || '-' || (24 + 5 * (c_custkey % 10)) END AS experian_age,
      CASE WHEN c_custkey % 17 = 0 THEN 'x' ELSE (c_custkey % 20)::VARCHAR END AS experian_affluence,
      CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE lpad((c_custkey % 13)::VARCHAR, 2, '0') END AS experian_hh_composition,
      CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE lpad((c_custkey % 67)::VARCHAR, 2, '0') END AS experian_mosaic_uk_type FROM customer""",
    "band_history": """SELECT c_custkey AS cust_id, yyyymmdd,
      CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_acctbal > 6000 THEN '1. Top' WHEN c_acctbal > 2000 THEN '2. Core' ELSE '3. Occ' END AS cust_band_fd,
      CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_acctbal > 4000 THEN '1. Top' WHEN c_acctbal > 1000 THEN '2. Core' ELSE '3. Occ' END AS cust_band_ch
      FROM customer, (VALUES (20010101), (20010401), (20010701), (20011001)) AS t(yyyymmdd)""",
    "bands": "SELECT * FROM (VALUES " + ", ".join(f"({i}, {', '.join(map(str, b))})" for i, b in enumerate(BANDS)) + ") AS t(ord, lo, hi, pay, least)",
    "offer_bands": """SELECT 'FD' AS l1_id, target, reward_perc, (ord + 1 + 100 * reward_perc + 10000 * length(target))::BIGINT AS offer_id,
      '[' || lo || ',' || hi || ']' AS offer_limits, '£' || pay || ' off when you spend £' || least || ' on food in store' AS offer_desc, lo, hi, ord
      FROM bands, (VALUES (7), (10)) AS r(reward_perc), (SELECT DISTINCT l2_id AS target FROM lu_article UNION ALL SELECT 'full_basket') AS t""",
    "eligibility": """SELECT c_custkey AS cust_id, CASE WHEN c_custkey % 5 = 0 THEN 'Post' ELSE 'Email' END AS channel, CASE WHEN c_custkey % 7 = 0 THEN 'IE' ELSE 'UK' END AS country,
      CASE WHEN c_custkey % 11 = 0 THEN 'Other' ELSE 'Member' END AS type, CASE WHEN c_custkey % 6 = 0 THEN 'Opt-out' ELSE 'Opt-in Active' END AS marketing_status FROM customer""",
    "counted": """SELECT * FROM trx_line WHERE l2_id NOT IN ('FOPA') AND trans_line_type = 'S' AND l4_id NOT IN ('F98A', 'F88A', 'T46', 'T63')
      AND area_name <> 'PETROL STATIONS' AND sales_amt >= 0.1 AND l3_id NOT IN ('40', '41') AND cust_id IS NOT NULL""",
    "scoped": f"""SELECT *, floor(date_diff('day', d, DATE '2001-08-01') / 28.0)::INTEGER AS win FROM counted
      WHERE date BETWEEN {fl.shifted(ETL_DATE, -HISTORY)} AND {ETL_DATE} AND purchase_channel = 'POS' AND l1_id = 'FD' AND NOT (date % 10000 >= 1218 OR date % 10000 <= 101) AND sales_amt > 0.5""",
    "recent": f"SELECT * FROM scoped WHERE date BETWEEN {fl.shifted(ETL_DATE, -LOOKBACK)} AND {ETL_DATE}",
}
