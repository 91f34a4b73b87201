"""Tables: scans of a share for every core, and written intermediate tables, which cut the lineage of iterative plans in a
folder that all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A Parquet table. One that is read in fewer splits than there are cores (a file of one row group is one split, whatever its
    size) is dealt out to all; a table of many splits is read as it stands."""
    rows, cores = spark.read.parquet(f"{sf_dir}/{name}.parquet"), spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def shared_folder(spark: SparkSession) -> str:
    """A folder below spark.checkpoint.dir. Where that is unset, a temporary one if all run in one process (tests), else an error:
    executors would not see each other's files."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/corpusloom-tables"


def checkpointed(df: DataFrame) -> DataFrame:
    """df written as Parquet in the shared folder and read back."""
    spark, path = df.sparkSession, f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.written_path = path
    return found


def discard(df: DataFrame) -> None:
    """Remove what checkpointed() wrote, once nothing reads it any more."""
    spark, path = df.sparkSession, getattr(df, "written_path", None)
    if path:
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
