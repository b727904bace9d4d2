"""Window functions: rolling sums over days and weeks, marks, ranks and nearest percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.operators.ranks import percent_rank, ranked_values, same, with_ranks


def rolling_days_sum(lines: DataFrame, days: int = 30, direction: str = "forward", value: str = "sales_amt", day: str = "day_no") -> DataFrame:
    """spend_timespan: the sum over the days after each line ('forward', the reference's frame) or before it."""
    lo, hi = (0, days) if direction == "forward" else (-days, 0)
    w = W.partitionBy("cust_id").orderBy(F.col(day).cast("long")).rangeBetween(lo, hi)
    return lines.withColumn("spend_timespan", F.sum(value).over(w))


def present_weeks(weekly: DataFrame, week: str = "week") -> DataFrame:
    """Weeks that occur, numbered without gaps. One row per week of the history: a small table."""
    weeks = weekly.select(week).distinct()
    return weeks.withColumn("ordinal", F.row_number().over(W.orderBy(week)))


def rolling_weeks_dense(weekly: DataFrame, keys: Sequence[str], n: int, value: str = "total", week: str = "week") -> DataFrame:
    """Rolling sums of n weeks over the grid of all keys and present weeks, from the nth week on.

    Reference form. Its grid is keys x weeks; rolling_weeks_percentiles gives percentiles without it."""
    weeks = present_weeks(weekly, week)
    grid = weekly.select(*keys).distinct().crossJoin(F.broadcast(weeks))
    full = grid.join(weekly, [*keys, week], "left").fillna(0, [value])
    w = W.partitionBy(*keys).orderBy("ordinal").rowsBetween(-(n - 1), 0)
    return full.withColumn("rolling", F.sum(value).over(w)).filter(F.col("ordinal") >= n)


def rolling_weeks_sparse(weekly: DataFrame, keys: Sequence[str], n: int, value: str = "total", week: str = "week") -> DataFrame:
    """The non-zero rows of the dense form: each weekly total is sent to the n windows that hold it."""
    weeks = present_weeks(weekly, week)
    last = weeks.agg(F.max("ordinal").alias("last"))
    placed = weekly.join(F.broadcast(weeks), week).crossJoin(F.broadcast(last))
    spread = placed.withColumn("at", F.explode(F.sequence("ordinal", F.col("ordinal") + n - 1))).filter(F.col("at").between(n, F.col("last")))
    return spread.groupBy(*keys, "at").agg(F.sum(value).alias("rolling"), F.first("last").alias("last"))


def rolling_weeks_percentiles(weekly: DataFrame, keys: Sequence[str], n: int, percents: Sequence[int], value: str = "total", week: str = "week") -> DataFrame:
    """Percentiles of the dense form's rolling sums, zeros implied: no grid, one exchange per step.

    Sums of positive totals are positive, so the sorted dense values are (N - k) zeros and the k sparse ones."""
    sparse = rolling_weeks_sparse(weekly, keys, n, value, week)
    total = present_weeks(weekly, week).agg(F.greatest(F.max("ordinal") - n + 1, F.lit(0)).alias("__all"))
    some = sparse.groupBy(*keys).agg(F.sort_array(F.collect_list("rolling")).alias("v"))
    every = weekly.select(*keys).distinct().join(some, list(keys), "left").crossJoin(F.broadcast(total)).filter("__all > 0")
    v = F.coalesce("v", F.array().cast("array<decimal(22,2)>"))

    def at(p: int):
        rank = F.ceil(F.lit(p / 100.0) * F.col("__all"))
        k = (rank - (F.col("__all") - F.size(v))).cast("int")
        return F.when(k <= 0, 0.0).otherwise(F.get(v, k - 1).cast("double"))

    return every.select(*keys, *(at(p).alias(f"{p}th_percentile") for p in percents))


def window_max_mark(baskets: DataFrame, value: str = "total_spend_basket") -> DataFrame:
    """The baskets that are the largest of their customer's window."""
    top = F.max(value).over(W.partitionBy("cust_id", "win"))
    return baskets.withColumn("time_window_max", top).filter(F.col(value) == F.col("time_window_max"))


def nearest_above_percentile(values: DataFrame, value: str, tie: Sequence[str], percent: int = 85) -> DataFrame:
    """Per customer the smallest row at or above the percentile of the customer's values; ties by `tie`."""
    p = values.groupBy("cust_id").agg(F.percentile_approx(value, percent / 100.0, 10_000).alias("__p"))
    near = values.join(p, "cust_id").filter(F.col(value) >= F.col("__p"))
    return near.groupBy("cust_id").agg(F.min(F.struct(value, *tie)).alias("s")).select("cust_id", "s.*")


def headroom_rank(df: DataFrame, item: str, value: str = "headroom", descending: bool = False) -> DataFrame:
    """Dense rank within an item, ascending by default as in the reference."""
    return with_ranks(df, [item], value, descending).withColumnRenamed("dense_rank", "headroom_item_rank").drop("before", "total")


def percent_rank_of_baseline(observed: DataFrame, baselines: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Where each baseline falls among its group's observed values (baselines counted among them)."""
    mine = baselines.select(*keys, F.col("v").cast("double").alias("v"))
    both = observed.select(*keys, F.col(column).cast("double").alias("v")).unionByName(mine)
    ranks = ranked_values(both, keys, "v")
    found = mine.alias("m").join(ranks.alias("r"), same("m", "r", [*keys, "v"])).select("m.*", "r.before", "r.total")
    return found.withColumn("percentile_rank", percent_rank()).drop("before", "total")


def share_of_total(counts: DataFrame, count: str = "n_rows") -> DataFrame:
    """Share of each row of a small aggregate, to three decimals."""
    total = counts.agg(F.sum(count).alias("__all"))
    share = F.floor(1000.0 * F.col(count) / F.col("__all") + 0.5) / 1000.0
    return counts.crossJoin(F.broadcast(total)).withColumn("share", share).drop("__all")
