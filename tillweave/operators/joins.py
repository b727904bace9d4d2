"""Joins of lines, articles, customers, offers and predictions.

Small configured sides (rules, bands) are broadcast; tables that grow with the data are left to
Catalyst and adaptive execution.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.operators.ranks import same

#: Steps of one key are fewer than two to this power.
STEP_BITS = 16


def article_enrich(lines: DataFrame, articles: DataFrame, l2_ids: Sequence[str], keep: Sequence[str] = ("l2_id",)) -> DataFrame:
    """Lines of articles in the given groups, with the article's levels."""
    wanted = articles.filter(F.col("l2_id").isin(*l2_ids)).select("article_id", *keep)
    return lines.drop(*keep).join(wanted, "article_id")


def category_membership(articles: DataFrame, rules: DataFrame, l2_ids: Sequence[str], lx: str = "l2_id") -> DataFrame:
    """article_id and category: an article's own group, and every offer that one of its levels is listed for.

    An article may lie in several categories on purpose."""
    levels = [f"l{i}_id" for i in range(1, 7) if f"l{i}_id" in articles.columns]
    tall = articles.select("article_id", *levels).unpivot("article_id", levels, "level", "id")
    offers = tall.join(F.broadcast(rules), ["level", "id"]).select("article_id", F.col("offer").alias("category"), F.lit(True).alias("synthetic")).distinct()
    own = articles.filter(F.col("l2_id").isin(*l2_ids)).select("article_id", F.col(lx).alias("category"), F.lit(False).alias("synthetic"))
    return own.unionByName(offers)


def segment_attach(df: DataFrame, segments: DataFrame, key: str = "cust_id") -> DataFrame:
    """One segment row per key, the smallest by its other columns."""
    others = [c for c in segments.columns if c != key]
    one = segments.groupBy(key).agg(F.min(F.struct(*others)).alias("s")).select(key, "s.*")
    return df.join(one, key)


def first_account_link(customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Each distinct customer with the lowest account and its digital id, null without one."""
    first = accounts.groupBy("cust_id").agg(F.min(F.struct("account_id", "uk_digital_id")).alias("a"))
    return customers.select("cust_id").distinct().join(first, "cust_id", "left").select("cust_id", "a.*")


def customer_item_cross(ratings: DataFrame, user: str, items: DataFrame) -> DataFrame:
    """Every user with every item of a short, configured item list."""
    return ratings.select(user).distinct().crossJoin(F.broadcast(items))


def prediction_left(predictions: DataFrame, actuals: DataFrame, keys: Sequence[str], actual: str) -> DataFrame:
    """Predictions with what was really spent, 0 where nothing was."""
    return predictions.join(actuals.select(*keys, actual), list(keys), "left").fillna(0, [actual])


def eligible(customers: DataFrame, eligibility: DataFrame) -> DataFrame:
    """Customers who may be mailed about the campaign."""
    wanted = eligibility.filter("channel = 'Email' and country = 'UK' and type = 'Member' and marketing_status = 'Opt-in Active'")
    return customers.join(wanted.select("cust_id"), "cust_id", "left_semi")


def in_band(spend: Column, lo: str = "lo", hi: str = "hi") -> Column:
    """Half-open: the band's lower end counts, its upper end does not."""
    return (spend >= F.col(lo)) & (spend < F.col(hi))


def elementary_bands(bands: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """on, steps: the bands' endpoints in order, each with the offer that holds from there to the next.

    Of overlapping bands the last defined (largest ord) holds; in a gap, and beyond the last end, none does."""
    b = bands.select(*on, F.col("lo").cast("double").alias("lo"), F.col("hi").cast("double").alias("hi"), "ord", "offer_id")
    ends = b.select(*on, F.explode(F.array("lo", "hi")).alias("at")).distinct()
    inside = same("e", "b", on) & (F.col("e.at") >= F.col("b.lo")) & (F.col("e.at") < F.col("b.hi"))
    held = ends.alias("e").join(b.alias("b"), inside, "left").groupBy(*(F.col(f"e.{c}") for c in on), "e.at").agg(F.max_by("b.offer_id", "b.ord").alias("offer_id"))
    return held.groupBy(*on).agg(F.sort_array(F.collect_list(F.struct("at", "offer_id"))).alias("steps"))


def offer_at(steps: Column, spend: Column) -> Column:
    """The offer that holds at the spend, by binary search in the sorted steps; null before the first and without a spend."""
    jumps = F.array(*(F.lit(1 << k) for k in range(STEP_BITS - 1, -1, -1)))
    further = lambda at, jump: (at + jump <= F.size(steps)) & (F.get(steps, at + jump - 1)["at"] <= spend)
    place = F.aggregate(jumps, F.lit(0), lambda at, jump: F.when(further(at, jump), at + jump).otherwise(at))
    return F.when(F.size(steps) >= 1 << STEP_BITS, F.raise_error(F.lit("too many bands"))).otherwise(F.get(steps, place - 1)["offer_id"])


def offer_band_range(df: DataFrame, spend: str, bands: DataFrame, on: Sequence[str] = ()) -> DataFrame:
    """df with the offer_id whose band holds the spend; of overlapping bands the last defined (largest ord).

    bands is a configured list: without keys its steps are values of the plan, with keys they meet the rows
    by an equality join. Rows are neither multiplied nor regrouped; those without a band have a null offer."""
    if on:
        steps = elementary_bands(bands, on)
        both = df.alias("x").join(steps.alias("b"), same("x", "b", on), "left").select("x.*", F.col("b.steps").alias("__steps"))
        return both.withColumn("offer_id", offer_at(F.col("__steps"), F.col(spend).cast("double"))).drop("__steps")
    kind = bands.schema["offer_id"].dataType
    found = elementary_bands(bands).first()
    if found is None or not found.steps:
        return df.withColumn("offer_id", F.lit(None).cast(kind))
    steps = F.array(*(F.struct(F.lit(s["at"]).alias("at"), F.lit(s["offer_id"]).cast(kind).alias("offer_id")) for s in found.steps))
    return df.withColumn("offer_id", offer_at(steps, F.col(spend).cast("double")))


def stretch_fallback_join(base: DataFrame, customer_price: DataFrame, category_price: DataFrame, keys: Sequence[str] = ("cust_id", "lx_id")) -> DataFrame:
    """One more unit's price: the customer's own, else the category's; article counts default to 0."""
    out = base.join(customer_price, list(keys), "left").join(category_price, keys[-1], "left")
    return out.withColumns({"unit_price": F.coalesce("unit_price", "category_price"), "avg_weekly_article_count": F.coalesce("avg_weekly_article_count", F.lit(0.0))})


def low_volume_switch(units: DataFrame, allocation: DataFrame, keys: Sequence[str], threshold: float = 6) -> DataFrame:
    """For customers who buy fewer articles a week than the threshold (none, where no count is known) the unit stretch, else the allocation's."""
    both = units.join(allocation, list(keys), "right")
    few = F.coalesce(F.col("avg_weekly_article_count"), F.lit(0.0)) < threshold
    return both.withColumn("baseline_plus_stretch", F.when(few, F.col("unit_stretch")).otherwise(F.col("spend_plus_stretch")))


def cohort_overlap(df: DataFrame, key: str, first: Column, second: Column) -> DataFrame:
    """key, part: in which of two cohorts a key has rows (first, second or both); keys of neither are left out."""
    flags = df.filter(first | second).groupBy(key).agg(F.bool_or(F.coalesce(first, F.lit(False))).alias("a"), F.bool_or(F.coalesce(second, F.lit(False))).alias("b"))
    return flags.select(key, F.when(F.col("a") & F.col("b"), "both").when(F.col("a"), "first").otherwise("second").alias("part"))


def latest_snapshot(history: DataFrame, date: int, column: str = "yyyymmdd") -> DataFrame:
    """Rows of the last snapshot that is not after date."""
    last = history.filter(F.col(column) <= date).agg(F.max(column).alias("__last"))
    return history.join(F.broadcast(last), F.col(column) == F.col("__last"), "left_semi")


def nth(df: DataFrame, by: Sequence[str], order: Sequence[Column | str], name: str = "row") -> DataFrame:
    return df.withColumn(name, F.row_number().over(W.partitionBy(*by).orderBy(*order)))
