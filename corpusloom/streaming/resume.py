"""An extension: model passes as streams. Queue files that arrive are answered once each, in micro-batches that append.

The stream's checkpoint remembers which files were read; a batch that runs again after a failure asks only for the records
that are not there yet, so each row has one record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from corpusloom.operators import generation
from corpusloom.operators.consensus import pending


def answer_stream(
    spark: SparkSession, queue_path: str, schema: str, records_path: str, checkpoint: str, factory: Callable[[], generation.Backend], key: str = "candidate_id",
    prompt: str = "prompt", batch: int = 8,
) -> StreamingQuery:
    """Start a stream that answers all queue rows there are and ends. Queue and records are folders of Parquet files."""

    def append(rows: DataFrame, _: int) -> None:
        session = rows.sparkSession
        try:
            rows = pending(rows, session.read.parquet(records_path), key)
        except AnalysisException:  # no record yet
            pass
        generation.run_generation(rows.dropDuplicates([key]), None, factory, batch, key, prompt).write.mode("append").parquet(records_path)

    rows = spark.readStream.schema(schema).parquet(queue_path)
    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
