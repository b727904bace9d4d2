"""Test cells: distributed random order, exact quotas, exclusive assignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tillweave.functions.hashing import shuffle_key
from tillweave.functions.local import local_rows
from tillweave.sources.scratch import shared_folder

BUCKET_DIGITS = 3


def shuffled_index(df: DataFrame, key: str, seed: int = 7, by: Sequence[str] = ()) -> DataFrame:
    """index: 0-based place of each row in a keyed-random order (within by), without a one-task window.

    Rows are numbered within 4096 hash buckets; the buckets' sizes give each one's offset."""
    d = df.withColumn("__h", shuffle_key(seed, key)).withColumn("__b", F.substring("__h", 1, BUCKET_DIGITS))
    sizes = d.groupBy(*by, "__b").agg(F.count("*").alias("__n"))
    before = W.partitionBy(*by).orderBy("__b").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select(*by, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    place = F.row_number().over(W.partitionBy(*by, "__b").orderBy("__h", key)) - 1
    return d.withColumn("__place", place).join(starts, [*by, "__b"]).withColumn("index", F.col("__place") + F.col("__start")).drop("__h", "__b", "__n", "__place", "__start")


def quotas_random(total: int, types: Sequence[str], ratio: float) -> list[tuple[str, str, int]]:
    """Equal sizes, what is left over to the first types; each split by the treatment ratio."""
    out = []
    for i, t in enumerate(types):
        n = total // len(types) + (i < total % len(types))
        out += [(t, "treatment", int(n * ratio)), (t, "control", n - int(n * ratio))]
    return out


def quotas_percentage(total: int, shares: Mapping[str, float], ratio: float) -> list[tuple[str, str, int]]:
    if sum(shares.values()) > 1 + 1e-9:
        raise ValueError("shares sum to more than 1")
    return [(t, g, int(total * p * r)) for t, p in shares.items() for g, r in (("treatment", ratio), ("control", 1 - ratio))]


def quotas_volume(total: int, volumes: Mapping[str, Mapping[str, int]]) -> list[tuple[str, str, int]]:
    out = [(t, g, n) for g, cells in volumes.items() for t, n in cells.items()]
    if sum(n for _, _, n in out) > total:
        raise ValueError("more customers asked for than there are")
    return out


def assign(df: DataFrame, quotas: Sequence[tuple[str, str, int]], key: str = "cust_id", seed: int = 7) -> DataFrame:
    """key, test_type, test_group: consecutive runs of the random order, one per quota."""
    at, ranges = 0, []
    for t, g, n in quotas:
        ranges.append((t, g, at, at + n))
        at += n
    cells = F.broadcast(local_rows(df.sparkSession, ranges, "test_type string, test_group string, start long, stop long"))
    people = shuffled_index(df.select(key).distinct(), key, seed)
    return people.join(cells, (F.col("index") >= F.col("start")) & (F.col("index") < F.col("stop"))).select(key, "test_type", "test_group")


def apply_assignment(rows: DataFrame, cells: DataFrame, key: str = "cust_id") -> DataFrame:
    """Each customer keeps the rows of the test type it was assigned to."""
    return rows.join(cells, [key, "test_type"])


def exclusive_round(pools: DataFrame, used: DataFrame | None, value: object, n: int, category: str, key: str, seed: int) -> DataFrame:
    """The first n keys of one category's slice, in keyed-random order, that no earlier round has used."""
    pool = pools.filter(F.col(category) == F.lit(value)).select(key)
    if used is not None:
        pool = pool.join(used.select(key), key, "left_anti")
    return shuffled_index(pool, key, seed).filter(F.col("index") < n).select(key, F.lit(value).alias(category))


def sequential_exclusive(rows: DataFrame, order: Sequence[str], n: int, category: str, key: str = "cust_id", seed: int = 7, spend: str | None = None, enough: bool = False) -> DataFrame:
    """n customers of each category in turn, none twice; order is a short configured list.

    The categories' members are written once, sliced by category; each round reads its slice and the settled
    set of all that earlier rounds have used, and adds its own part to that set, so every round has the same plan.
    With a spend column only rows above zero count; with enough, a category that cannot give n customers is an error."""
    spark = rows.sparkSession
    if spend:
        rows = rows.filter(F.col(spend) > 0)
    members = rows.filter(F.col(category).isin(*order)).select(key, category).distinct()
    pools_at, used_at = shared_folder(spark), shared_folder(spark)
    members.write.partitionBy(category).parquet(pools_at)
    pools, used = spark.read.schema(members.schema).parquet(pools_at), None
    schema = StructType([members.schema[key], members.schema[category], StructField("round", IntegerType())])
    for i, c in enumerate(order):
        exclusive_round(pools, used, c, n, category, key, seed).write.parquet(f"{used_at}/round={i}")
        used = spark.read.schema(schema).parquet(used_at)
    if used is None:
        return members
    if enough:
        have = {r[0]: r[1] for r in used.groupBy(category).count().collect()}
        few = [c for c in order if have.get(c, 0) < n]
        if few:
            raise ValueError(f"fewer than {n} customers left for {few}")
    return used.select(key, category)


def random_rows_per_group(df: DataFrame, by: Sequence[str], n: int, key: str = "cust_id", seed: int = 7) -> DataFrame:
    """n keyed-random rows of each group: pre-aggregated top n, not a sort of whole groups."""
    h = df.withColumn("__h", shuffle_key(seed, key))
    row = F.row_number().over(W.partitionBy(*by).orderBy("__h", key))
    return h.withColumn("__r", row).filter(F.col("__r") <= n).drop("__h", "__r")
