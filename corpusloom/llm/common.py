"""Shared helpers of the training-data operators: tables, shared folders, resilient materialisation."""

from __future__ import annotations

import contextlib
import ctypes
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.sources.tables import discard, shared_folder, table

__all__ = ["discard", "fresh_path", "kept", "materialize", "shared_folder", "spare", "spare_heaps", "table"]


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back, so a lost executor loses nothing."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.written_path = path
    return found


#: What a worker process keeps between tasks: one value at most, by its kind and key. Workers serve one stage after another, and
#: what earlier ones left would count against the memory of later ones.
_kept: dict = {}


def kept(kind: str, key: object, make):
    """make()'s value for key, made once in a worker process; another kind or key replaces it."""
    if (kind, key) not in _kept:
        _kept.clear()
        spare()
        _kept[kind, key] = make()
    return _kept[kind, key]


def spare() -> None:
    """Give freed memory back to the system, as far as the allocators of this process can."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def spare_heaps(spark: SparkSession) -> None:
    """Have the driver's heap and those of the executors collected, by one short task a core. A heap that has grown in one stage
    stays as large while the Python workers of the next ones grow beside it; only a full collection lets it shrink."""
    spark.sparkContext._jvm.System.gc()
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.reflect(F.lit("java.lang.System"), F.lit("gc")).alias("done")).write.format("noop").mode("overwrite").save()
