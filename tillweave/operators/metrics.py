"""Aggregations of lines: per customer, category, basket and window. Money is summed as decimals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillweave.functions.numeric import exact_mean, profile
from tillweave.operators.ranks import percentiles, same


def _spend(name: str):
    return F.sum("sales_amt").alias(name)


def cust_category_metrics(lines: DataFrame, lx: str = "l2_id") -> DataFrame:
    return lines.groupBy("cust_id", lx).agg(
        F.count(lx).cast("int").alias("number_of_transactions"), F.sum("sales_amt").cast("double").alias("total_spend"),
        F.count("article_id").cast("int").alias("items"), F.countDistinct("basket_id").cast("int").alias("visits"), exact_mean("sales_amt").alias("spend_per_item"),
    )


def cust_total_metrics(lines: DataFrame, lx: str = "l2_id") -> DataFrame:
    baskets = F.countDistinct("basket_id").cast("int")
    return lines.groupBy("cust_id").agg(
        F.count(lx).cast("int").alias("total_number_of_transactions"), F.sum("sales_amt").cast("double").alias("total_spend_amount"),
        baskets.alias("total_visits"), F.count("article_id").cast("int").alias("total_items"), baskets.alias("sum_baskets"), F.countDistinct(lx).alias("count_of_lx"),
    )


def cust_activity_counts(lines: DataFrame) -> DataFrame:
    return lines.groupBy("cust_id").agg(F.countDistinct("basket_id").cast("int").alias("count_user_basket"), F.countDistinct("win").cast("int").alias("count_user_time_window"))


def basket_totals(lines: DataFrame, *keys: str) -> DataFrame:
    """Spend and items of every basket (within further keys)."""
    return lines.groupBy("cust_id", *keys, "basket_id").agg(_spend("total_spend_basket"), F.count("basket_id").cast("decimal(12,0)").alias("items_per_basket"))


def basket_profile(lines: DataFrame, *keys: str) -> DataFrame:
    return basket_totals(lines, *keys).groupBy("cust_id", *keys).agg(*profile("total_spend_basket"), *profile("items_per_basket"))


def window_totals(lines: DataFrame, *keys: str) -> DataFrame:
    return lines.groupBy("cust_id", *keys, "win").agg(_spend("total_spend_time_window"), F.countDistinct("basket_id").cast("decimal(12,0)").alias("basket_per_time_window"))


def window_profile(lines: DataFrame, *keys: str) -> DataFrame:
    return window_totals(lines, *keys).groupBy("cust_id", *keys).agg(*profile("total_spend_time_window"), *profile("basket_per_time_window"))


def window_max_basket(lines: DataFrame, *keys: str) -> DataFrame:
    """The largest basket of every window."""
    baskets = lines.groupBy("cust_id", *keys, "win", "basket_id").agg(_spend("total_spend_basket"))
    return baskets.groupBy("cust_id", *keys, "win").agg(F.max("total_spend_basket").alias("time_window_max_spend_basket"))


def window_max_basket_profile(lines: DataFrame, *keys: str) -> DataFrame:
    return window_max_basket(lines, *keys).groupBy("cust_id", *keys).agg(*profile("time_window_max_spend_basket"))


def window_max_basket_unpivot(lines: DataFrame) -> DataFrame:
    wide = window_max_basket_profile(lines)
    return wide.unpivot("cust_id", wide.columns[1:], "label", "weekly_max_basket_percentile").filter("label is not null")


def category_window_percentile(lines: DataFrame, percent: int = 85, lx: str = "l2_id") -> DataFrame:
    spend = F.percentile_approx("total_spend_time_window", percent / 100.0, 10_000).cast("double")
    return window_totals(lines, lx).groupBy("cust_id", lx).agg(spend.alias("total_time_window_spend"))


def baseline_percentiles(rolling: DataFrame, keys: Sequence[str], column: str, percents: Sequence[int]) -> DataFrame:
    return rolling.groupBy(*keys).agg(*(F.percentile_approx(column, p / 100.0, 10_000).cast("double").alias(f"{p}th_percentile") for p in percents))


def group_profile(df: DataFrame, keys: Sequence[str], column: str, percents: Sequence[int] = (50, 75, 85, 90, 100)) -> DataFrame:
    """The mean of a column and its percentiles in groups of any size."""
    mean = df.groupBy(*keys).agg(exact_mean(column).alias("mean"))
    steps = percentiles(df.select(*keys, column), keys, column, [p / 100.0 for p in percents])
    both = mean.alias("m").join(steps.alias("s"), same("m", "s", keys))
    return both.select(*(F.col(f"m.{k}") for k in keys), F.col("m.mean").alias(f"average_{column}"), *(F.col("s.steps")[i].cast("double").alias(f"{p}percentile_{column}") for i, p in enumerate(percents)))


def category_unit_price(lines: DataFrame, percentile: float = 0.75, lx: str = "l2_id") -> DataFrame:
    """A typical price in each category: a percentile of its articles' highest full prices."""
    top = lines.groupBy(lx, "article_id").agg(F.max("unit_full_price").alias("price"))
    return percentiles(top, [lx], "price", [percentile]).select(lx, F.col("steps")[0].cast("double").alias("category_price"))


def customer_unit_price(lines: DataFrame, percentile: float = 0.85, lx: str = "l2_id", win: str | None = None) -> DataFrame:
    """A customer's price in each category and articles bought; with win, also the mean count of articles in the windows with any."""
    total = F.sum("item_qty").cast("long")
    mean = [(total.cast("double") / F.countDistinct(win)).alias("avg_weekly_article_count")] if win else []
    return lines.groupBy("cust_id", lx).agg(
        F.percentile_approx("unit_full_price", percentile, 10_000).cast("double").alias("customer_price"), total.alias("total_articles"), *mean
    )


def final_unit_price(customer: DataFrame, category: DataFrame, threshold: int = 10, lx: str = "l2_id") -> DataFrame:
    """Few articles: the category's price if known. Never below the category's price."""
    both = customer.join(category, lx, "left")
    price = F.when((F.col("total_articles") <= threshold) & F.col("category_price").isNotNull(), F.col("category_price")).otherwise(F.col("customer_price"))
    return both.withColumn("unit_price", F.greatest(price, "category_price"))


def channel_pivot_spend(lines: DataFrame, departments: Sequence[str] = ("FD", "GM"), target: str = "FD", least: float = 0.1) -> DataFrame:
    """Spend, items and baskets by department, totals, and shares; customers with enough in the target."""
    wide = lines.groupBy("cust_id").pivot("l1_id", list(departments)).agg(
        F.coalesce(F.sum("sales_amt"), F.lit(0)).cast("double").alias("spend"), F.coalesce(F.sum("item_qty"), F.lit(0)).cast("long").alias("items"), F.countDistinct("basket_id").alias("baskets")
    )
    wide = wide.fillna(0)
    parts = ("spend", "items", "baskets")
    wide = wide.withColumns({f"total_{p}": sum((F.col(f"{d}_{p}") for d in departments[1:]), F.col(f"{departments[0]}_{p}")) for p in parts})
    shares = {f"{d}_{p}_share": F.try_divide(F.col(f"{d}_{p}").cast("double"), F.col(f"total_{p}").cast("double")) for d in departments for p in parts}
    return wide.withColumns(shares).filter(F.col(f"{target}_spend") >= least)


def group_counts(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_rows"))


def complete_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of the keys that have as many rows as the fullest key."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("__n"))
    most = sizes.agg(F.max("__n").alias("__n"))
    return df.join(sizes.join(F.broadcast(most), "__n", "left_semi"), list(keys), "left_semi")


def histogram(df: DataFrame, by: Sequence[str], value: str, bins: int) -> DataFrame:
    """by, bin, lower, upper, n_rows: equal-width bins from the group's smallest to its largest value, empty ones included.

    The last bin holds the largest value; where all values are equal they are in the first. Rows without a value count nowhere."""
    x = df.select(*by, F.col(value).cast("double").alias("__x")).filter("__x is not null")
    bounds = x.groupBy(*by).agg(F.min("__x").alias("__lo"), F.max("__x").alias("__hi"))
    share = (F.col("__x") - F.col("__lo")) / (F.col("__hi") - F.col("__lo"))
    place = F.when(F.col("__hi") > F.col("__lo"), F.least(F.floor(share * bins), F.lit(bins - 1))).otherwise(0).cast("int")
    held = x.alias("x").join(bounds.alias("b"), same("x", "b", by)).select(*(F.col(f"x.{c}") for c in by), place.alias("bin")).groupBy(*by, "bin").agg(F.count("*").alias("n_rows"))
    every = bounds.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    edge = lambda i: F.col("e.__lo") + (F.col("e.__hi") - F.col("e.__lo")) * (i / float(bins))
    both = every.alias("e").join(held.alias("h"), same("e", "h", [*by, "bin"]), "left")
    return both.select(*(F.col(f"e.{c}") for c in by), "e.bin", edge(F.col("e.bin")).alias("lower"), edge(F.col("e.bin") + 1).alias("upper"), F.coalesce("h.n_rows", F.lit(0)).alias("n_rows"))
