"""Configured lists as tables: they reach the plan as local rows, so reading them starts no job."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def local_rows(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A short list of rows (one at least) with the columns of a DDL schema."""
    schema = StructType.fromDDL(ddl)
    return spark.createDataFrame(pa.table(dict(zip(schema.names, map(list, zip(*rows, strict=True)), strict=True))), schema)
