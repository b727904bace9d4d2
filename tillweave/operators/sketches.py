"""Mergeable quantile sketches: counts of rows by value buckets of bounded relative width, kept by week.

A value, in whole cents, falls into the bucket of its first `bits` binary digits: below 2**bits cents a bucket is one value,
above it is narrower than 2**(1 - bits) of its value. Counts of buckets add up, so the sketches of any weeks and groups
make the sketch of their union without the lines. A quantile's rank is exact in the counts: the bucket that is returned
holds the exact quantile (the value at rank ceil(p * n)) and its share of the rows bounds the error in rank of any value in it.
All is integer arithmetic, alike in any engine and any order. A group has at most 2**bits * 64 * 2 buckets, whatever its rows.

Defined results: rows without a value count nowhere; a null group is a group; a group without values has no sketch; the quantile of 0 is
the smallest value's bucket. Values are decimals of two places, negative ones too.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tillweave.sources import sinks

BITS = 7


def bucket(value: Column, bits: int = BITS) -> tuple[Column, Column]:
    """The smallest and largest number of cents in the value's bucket."""
    cents = (value.cast("decimal(20,2)") * 100).cast("bigint")
    size = F.abs(cents)
    spare = F.greatest(F.length(F.bin(size)) - bits, F.lit(0)).cast("int")
    low = F.call_function("shiftleft", F.call_function("shiftright", size, spare), spare)
    high = low + F.call_function("shiftleft", F.lit(1).cast("bigint"), spare) - 1
    return F.when(cents < 0, -high).otherwise(low), F.when(cents < 0, -low).otherwise(high)


def sketch(df: DataFrame, by: Sequence[str], value: str, bits: int = BITS) -> DataFrame:
    """by, lo, hi (cents), n: rows of each group in each bucket."""
    lo, hi = bucket(F.col(value), bits)
    return df.filter(F.col(value).isNotNull()).groupBy(*by, lo.alias("lo"), hi.alias("hi")).agg(F.count("*").alias("n"))


def merged(sketches: DataFrame, by: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups."""
    return sketches.groupBy(*by, "lo", "hi").agg(F.sum("n").alias("n"))


def quantiles(sketches: DataFrame, by: Sequence[str], percents: Sequence[int]) -> DataFrame:
    """by, percent, n_rows, lower, upper (bounds of the exact quantile), rank_error (most rows between, as a share).

    The window is over a group's buckets, whose number has a bound."""
    w = W.partitionBy(*by)
    upto = sketches.withColumns({"upto": F.sum("n").over(w.orderBy("lo").rowsBetween(W.unboundedPreceding, 0)), "n_rows": F.sum("n").over(w)})
    each = upto.withColumn("percent", F.explode(F.array(*map(F.lit, percents))))
    rank = F.greatest(F.expr("(percent * n_rows + 99) div 100"), F.lit(1))
    held = each.filter((F.col("upto") >= rank) & (F.col("upto") - F.col("n") < rank))
    share = F.col("n").cast("double") / F.col("n_rows").cast("double")
    return held.select(*by, "percent", "n_rows", (F.col("lo") / 100.0).alias("lower"), (F.col("hi") / 100.0).alias("upper"), share.alias("rank_error"))


def put_week(df: DataFrame, path: str, week: int, by: Sequence[str], value: str, bits: int = BITS) -> None:
    """Make the sketch of a week's rows all there is of that week."""
    sinks.replace_slice(sketch(df.filter(F.col("week") == week), by, value, bits), path, {"week": week})


def put_weeks(df: DataFrame, path: str, by: Sequence[str], value: str, bits: int = BITS) -> None:
    """A new store of sketches of all weeks in df, in one pass."""
    sketch(df, [*by, "week"], value, bits).repartition("week").write.mode("overwrite").partitionBy("week").parquet(path)


def over_weeks(spark: SparkSession, path: str, by: Sequence[str], first: int, last: int) -> DataFrame:
    """The sketches of weeks first to last as one; other weeks' slices are not read."""
    return merged(spark.read.parquet(path).filter(F.col("week").between(first, last)), by)
