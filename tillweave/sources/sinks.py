"""Tables and files: create, replace a slice, append, merge, export.

Tables are folders of partitioned Parquet; a slice is replaced by overwriting its partition folder, so
that trailing partitions that the new rows lack go too, and a repeated run changes nothing.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillweave.operators.ranks import same
from tillweave.sources.scratch import stored


def table_create(spark: SparkSession, path: str, schema: T.StructType | DataFrame, partition_by: Sequence[str] = (), stamp: bool = True, overwrite: bool = False) -> DataFrame:
    """Create an empty table of the schema (or of a DataFrame's) and return it; one that is there stays, or goes with overwrite."""
    schema = schema.schema if isinstance(schema, DataFrame) else schema
    if stamp and "load_timestamp" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("load_timestamp", T.TimestampType())])
    spark.createDataFrame([], schema).write.mode("overwrite" if overwrite else "ignore").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)
    return spark.read.schema(schema).parquet(path)


def replace_slice(df: DataFrame, path: str, keys: Mapping[str, object], partition_by: Sequence[str] = ()) -> None:
    """Make the rows of df all there is for the given leading partition values."""
    folder = "/".join([path, *(f"{k}={v}" for k, v in keys.items())])
    df.drop(*keys).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(folder)


def align_schema(df: DataFrame, target: DataFrame) -> DataFrame:
    """df with the target's columns first (typed nulls where missing), new ones last."""
    have = set(df.columns)
    kept = [F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    return df.select(*kept, *(c for c in df.columns if c not in target.columns))


def insert_only(source: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The source rows that a merge would insert: those whose keys the target lacks."""
    return source.join(target.select(*keys).distinct(), list(keys), "left_anti")


def key_bits(source: DataFrame, keys: Sequence[str], bits: int = 20) -> Column:
    """A condition on rows of any table: false only where the row's keys are surely not among the source's.

    2**bits flags, built by bit_or over 64-bit words; at most 2**(bits - 6) words reach the driver."""
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    word, flag = F.shiftright(place, 6).cast("int"), F.expr("shiftleft(1L, cast(__place % 64 as int))")
    words = source.select(place.alias("__place"), word.alias("__word")).groupBy("__word").agg(F.bit_or(flag).alias("bits")).collect()
    flags = [0] * (1 << (bits - 6))
    for r in words:
        flags[r["__word"]] = r["bits"]
    held = F.get(F.from_json(F.lit(json.dumps(flags)), "array<bigint>"), word)
    return F.call_function("shiftright", held, F.pmod(place, F.lit(64)).cast("int")).bitwiseAND(F.lit(1)) == 1


def insert_new(source: DataFrame, path: str, keys: Sequence[str], slice_by: str, most: int = 10_000) -> int:
    """Append the source rows whose keys their slice of the target table lacks; how many were inserted.

    The target is a folder partitioned by slice_by, one of the keys. Only slices that the source has are read, and of
    these only rows that the source's key bits let pass. Of source rows with equal keys one is inserted, the
    smallest. What is inserted is settled first, so a failed write is repeated with the same rows, and a rerun inserts nothing."""
    spark = source.sparkSession
    if slice_by not in keys:
        raise ValueError(f"{slice_by} must be one of the keys")
    rest = [c for c in source.columns if c not in keys]
    one = source.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("__row")).select(*keys, "__row.*") if rest else source.select(*keys).distinct()
    one = stored(one)
    slices = [r[0] for r in one.select(slice_by).distinct().limit(most + 1).collect()]
    if len(slices) > most:
        raise ValueError(f"the source has more than {most} slices")
    target = spark.read.schema(one.schema).parquet(path).select(*keys)
    wanted = F.lit(False)
    if None in slices:
        wanted = F.col(slice_by).isNull()
    if len(slices) > (None in slices):
        wanted = wanted | F.col(slice_by).isin(*(s for s in slices if s is not None))
    held = target.filter(wanted).filter(key_bits(one, keys))
    new = stored(one.alias("s").join(held.alias("t"), same("s", "t", keys), "left_anti"))
    new.write.mode("append").partitionBy(slice_by).parquet(path)
    return new.count()


def repartition_write(df: DataFrame, path: str, n: int, partition_by: Sequence[str]) -> None:
    df.repartition(n, *partition_by).write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def append_stamped(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.withColumn("load_timestamp", F.current_timestamp()).write.mode("append").partitionBy(*partition_by).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_csv_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One CSV file with a header, for report-sized results."""
    df.coalesce(1).write.mode(mode).option("header", True).csv(path)


def export_partition(df: DataFrame, column: str, value: object, path: str, drop: Sequence[str] = ()) -> None:
    df.where(F.col(column) == F.lit(value)).drop(column, *drop).write.mode("overwrite").parquet(path)


def truncate_staging(spark: SparkSession, path: str, name: str) -> None:
    """Empty a table, only if its name says that it is a staging table."""
    if "staging" not in name:
        raise ValueError(f"{name} is not a staging table")
    schema = spark.read.parquet(path).schema
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)


def load_static_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
