"""The corpus pipeline: filter, dedup, decontaminate, mix and encode the documents table.

Each stage reads what the one before kept, as a written table, and all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontaminate, minhash, mixing, quality, tokens
from millrace.llm.queries import table, tokenizer_path
from millrace.llm.tables import written


#: Rows and bytes of an Arrow batch. Executors hold a few batches for each task, in and beside the JVM, and keep that memory
#: from stage to stage; Spark's default of 10,000 rows makes batches of 70 MB of these documents.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


def small_batches(spark: SparkSession) -> None:
    """Set BATCHES for the session; results are the same for any batches."""
    for name, value in BATCHES.items():
        spark.conf.set(name, value)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier learnt from the labels table accepts."""
    small_batches(spark)
    return quality.keep_quality(docs, table(spark, sf_dir, "labels"))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate group (five-word shingles, similarity 0.8), that with the smallest id.

    Groups are judged by row: rows that share an id, or have none, are compared by their texts.
    """
    small_batches(spark)
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that aren't contaminated by the benchmark table."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their raked rates; those with a rate above one come up more than once."""
    small_batches(spark)
    drawn = mixing.document_mix(docs).filter("copies > 0")
    drawn = drawn.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return drawn.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents that are left; one row for each document, read back from them."""
    small_batches(spark)
    return tokens.token_output(docs, tokenizer_path())


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("tokens", token_stage),
]

#: None of the stages but mixing can be told in SQL; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
