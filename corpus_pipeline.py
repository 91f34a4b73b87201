"""The corpus pipeline: five stages over documents, each written as Parquet and read again as the next one's documents.

toxicity drops toxic documents, near_duplicates keeps one document of each group, decontamination drops documents that hold
benchmark items, secrets masks what the secret scan reports, and byte_bpe encodes and decodes what is left.
"""

from __future__ import annotations

import functools

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import byte_bpe, decontaminate, secrets, simhash, toxicity
from corpusloom.llm.common import materialize, spare, spare_heaps, table


#: Rows of whole texts that go to a Python worker at once. Spark's 10,000 are some ten MB of texts on either side of each worker,
#: in buffers that neither side gives back; the heap of an executor that has grown in earlier stages leaves no room for them.
ARROW_ROWS = 1000


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under 0.5, by a field fitted to all labelled documents."""
    return toxicity.without_toxic(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, that of the least doc_id."""
    return simhash.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with every reported span masked; n_chars is that of the masked text where there was a span."""
    columns = docs.columns
    rows = secrets.scan_secrets(docs)
    text = secrets.mask_spans(F.col("doc.text"), F.col("spans"))
    rows = rows.select("doc", "spans", text.alias("text"))
    count = F.when(F.size("spans") > 0, F.length("text").cast("bigint")).otherwise(F.col("doc.n_chars"))
    own = {"text": F.col("text"), "n_chars": count}
    return rows.select(*(own.get(c, F.col(f"doc.`{c}`")).alias(c) for c in columns))


def byte_bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of every document, and digests of its ids and of what they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    # executors' heaps have grown in the stages before: smaller blocks, which fold more words, for the memory
    return byte_bpe.round_trip(docs, path, public_tokenizers.PATTERN, block_words=1 << 16, block_codes=1 << 22)


def _in_small_batches(stage):
    @functools.wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        # of the session, since a stage's plan runs when its result is written
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
        spare_heaps(spark)  # of what the stage before left
        out = stage(spark, docs, sf_dir)
        spare()  # what fitting and building tables took of the driver's memory
        spare_heaps(spark)  # of what it took of the executors', before the result is written
        return out

    return run_stage


STAGES = [
    ("toxicity", _in_small_batches(toxicity_stage)),
    ("near_duplicates", _in_small_batches(near_duplicate_stage)),
    ("decontamination", _in_small_batches(decontamination_stage)),
    ("secrets", _in_small_batches(secret_stage)),
    ("byte_bpe", _in_small_batches(byte_bpe_stage)),
]
#: SQL expresses neither the trained field nor components or merges; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages' result over sf_dir's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
