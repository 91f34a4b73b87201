"""Scans of JSON lines, whole texts and JSON documents, with line numbers where these are data.

Line numbers are file order. Spark has none, so they are made from a file's byte order: increasing row numbers within a read
split, shifted by the running counts of the splits before it (one small row a split). Files of a folder follow one another by name.
"""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions import text as T

CORRUPT = "_corrupt"


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no (from 1, blank lines count) and value of every line of a file, or of a folder's files one after another."""
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    lines = spark.read.text(path).select("value", *place, F.monotonically_increasing_id().alias("n"))
    blocks = lines.groupBy("file", "block").agg(F.min("n").alias("first"), F.count("*").alias("count"))
    before = F.sum("count").over(Window.orderBy("file", "block").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.select("file", "block", (F.coalesce(before, F.lit(0)) - F.col("first") + 1).alias("shift"))
    # one row a split: the lines stay where they are read
    return lines.join(F.broadcast(blocks), ["file", "block"]).select((F.col("n") + F.col("shift")).alias("line_no"), "value")


def parsed_lines(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """line_no, value, row (null where the line holds no JSON object) of every line that is not blank."""
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    row = F.from_json("value", schema, {"mode": "PERMISSIVE"})
    there = F.startswith(F.trim("value"), F.lit("{")) & F.try_parse_json("value").isNotNull()
    return lines.select("line_no", "value", F.when(there, row).alias("row"))


def read_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """line_no and the columns of schema; raises with the first line number that holds no JSON object."""
    rows = parsed_lines(spark, path, schema)
    if bad := rows.where("row is null").agg(F.min("line_no")).first()[0]:
        raise ValueError(f"no JSON object in {path} at line {bad}")
    return rows.select("line_no", "row.*")


def read_lenient(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """As read_strict, with lines that hold no JSON object left out."""
    return parsed_lines(spark, path, schema).where("row is not null").select("line_no", "row.*")


def read_inputs(spark: SparkSession, path: str, schema: StructType | str, text: str = "text", least: int = 160) -> DataFrame:
    """As read_lenient, only rows whose text has `least` characters at least without white space at its ends."""
    return read_lenient(spark, path, schema).where(F.length(T.strip(F.col(text))) >= least)


def line_count(spark: SparkSession, path: str) -> int:
    """Lines of a text file or folder of them, 0 where there is none."""
    try:
        return spark.read.text(path).count()
    except AnalysisException:
        return 0


def read_audited(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """As read_strict, with a last column error: invalid_json, or null."""
    error = F.when(F.col("row").isNull(), "invalid_json")
    return parsed_lines(spark, path, schema).select("line_no", "row.*", error.alias("error"))


def read_texts(spark: SparkSession, pattern: str) -> DataFrame:
    """source_file (the name without folders) and value (the whole text) of each file; raises if none fits the pattern."""
    try:
        files = spark.read.text(pattern, wholetext=True)
    except AnalysisException as error:
        raise FileNotFoundError(pattern) from error
    return files.select(F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source_file"), "value")


def read_document(spark: SparkSession, path: str) -> dict:
    """One JSON object, read by Spark so that any of its stores will do."""
    value = json.loads(spark.read.text(path, wholetext=True).first()[0])
    if not isinstance(value, dict):
        raise ValueError(f"no object in {path}")
    return value


def read_documents(spark: SparkSession, pattern: str, schema: StructType | str) -> DataFrame:
    """path and columns of every JSON document that fits the pattern."""
    return spark.read.schema(schema).option("multiLine", True).json(pattern).withColumn("path", F.input_file_name())


def optional(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A Parquet table, or no rows where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet table, 0 where there is none."""
    try:
        return spark.read.parquet(path).count()
    except AnalysisException:
        return 0
