"""What the training-data operators share: scratch tables and portable task code."""

from __future__ import annotations

import ctypes
import sys
import tempfile
import types
import uuid

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: One word: a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\f\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ship(module: str) -> None:
    """Send a module's task functions by value, so executors need no copy of the repository."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)


def kept() -> dict:
    """What a worker process keeps between tasks (shipped modules are made anew for each)."""
    return sys.modules.setdefault("_tillweave_kept", types.ModuleType("_tillweave_kept")).__dict__


def released() -> None:
    """Give back to the system what this worker has freed: Arrow's pool, and the C heap where the library can."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def scratch(spark: SparkSession) -> str:
    """The shared folder of spark.checkpoint.dir; a temporary one only in local mode."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def settled(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts lineage, survives lost executors."""
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def sha256(column: Column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def ascii_lower(column: Column) -> Column:
    """A-Z to a-z only; lower() does the same where all is ASCII, and is quicker."""
    plain = F.octet_length(column) == F.char_length(column)
    return F.when(plain, F.lower(column)).otherwise(F.translate(column, UPPER, LOWER))


def need(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")


def fresh(df: DataFrame, name: str) -> str:
    """name, with underscores added until no column of df has it."""
    held = {c.lower() for c in df.columns}
    while name.lower() in held:
        name += "_"
    return name
