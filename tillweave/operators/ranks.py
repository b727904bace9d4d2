"""Ranks within groups of any size: sorted ranges of distinct values with prefix offsets, no window over a group.

Equal values are counted first, so a value that many rows share is one row. The distinct values are dealt by
range of (group, value) and numbered within a range; the ranges' sizes give each range's offset in its group.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.sources.scratch import stored


def same(a: str, b: str, columns: Sequence[str]) -> Column:
    """Rows of the aliases a and b agree in the columns, nulls included."""
    out = F.lit(True)
    for c in columns:
        out = out & F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}"))
    return out


def ranked_values(df: DataFrame, by: Sequence[str], value: str, descending: bool = False) -> DataFrame:
    """by, value, dense_rank, before (rows of the group with an earlier value), total (rows of the group): a row per distinct value.

    Nulls are values: first when ascending, last when descending."""
    keys, order = list(by), F.desc(value) if descending else F.asc(value)
    counts = df.groupBy(*keys, value).agg(F.count("*").alias("__n"))
    placed = stored(counts.repartitionByRange(*keys, order).withColumn("__range", F.spark_partition_id()))
    sizes = placed.groupBy(*keys, "__range").agg(F.count("*").alias("__values"), F.sum("__n").alias("__rows"))
    earlier = W.partitionBy(*keys).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)  # a row per range of the group
    starts = sizes.select(
        *keys, "__range", F.coalesce(F.sum("__values").over(earlier), F.lit(0)).alias("__values"), F.coalesce(F.sum("__rows").over(earlier), F.lit(0)).alias("__rows"),
        F.sum("__rows").over(W.partitionBy(*keys)).alias("total"),
    )
    within = W.partitionBy(*keys, "__range").orderBy(order)
    counted = placed.select(
        *keys, value, "__range", F.row_number().over(within).alias("__place"), F.coalesce(F.sum("__n").over(within.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__before")
    )
    both = counted.alias("c").join(starts.alias("s"), same("c", "s", [*keys, "__range"]))
    rank, before = F.col("c.__place") + F.col("s.__values"), F.col("c.__before") + F.col("s.__rows")
    return both.select(*(F.col(f"c.{k}") for k in keys), F.col(f"c.{value}"), rank.cast("int").alias("dense_rank"), before.alias("before"), F.col("s.total"))


def percentiles(df: DataFrame, by: Sequence[str], value: str, shares: Sequence[float]) -> DataFrame:
    """by, steps: the group's smallest values that at least each share of its values does not exceed, exact for groups of any size.

    Nulls are no values; a group without values has null."""
    ranked = ranked_values(df.withColumn("__none", F.col(value).isNull()), [*by, "__none"], value)

    def step(share: float) -> Column:
        x = Fraction(str(share))
        place = F.expr(f"greatest(1L, (total * {x.numerator}L + {x.denominator - 1}L) div {x.denominator}L)")
        return F.max(F.when(~F.col("__none") & (F.col("before") < place), F.col(value)))

    return ranked.groupBy(*by).agg(F.when(F.min("__none"), None).otherwise(F.array(*map(step, shares))).alias("steps"))


def with_ranks(df: DataFrame, by: Sequence[str], value: str, descending: bool = False) -> DataFrame:
    """df with dense_rank, before and total of its value in its group."""
    ranks = ranked_values(df, by, value, descending)
    both = df.alias("d").join(ranks.alias("r"), same("d", "r", [*by, value]))
    return both.select("d.*", "r.dense_rank", "r.before", "r.total")


def percent_rank() -> Column:
    """0 for the first value of a group, the share of the other rows that come before for the rest."""
    return F.when(F.col("total") > 1, F.col("before").cast("double") / (F.col("total") - 1)).otherwise(0.0)
