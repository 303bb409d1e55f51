"""A training-corpus pipeline over ``documents``: quality, near duplicates, benchmark passages, secrets, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the one before kept; what it returns is written as Parquet in the
shared folder and read again, and what it read is deleted then, so that two stages' outputs at most are there. All stages but the last return the columns of ``documents``.

The pipeline is an application: it sets how many rows go to a Python worker at once (BATCH_ROWS), which the operators leave alone.

Cases. A null text is scored by the intercept, has no shingles, passages or secrets, and is packed as its end token; a null id is no
near duplicate of any. Repeated rows are each scored; of rows that repeat an id all stay or go together. Extra columns, whatever their names,
pass through all stages but the last. Empty tables give empty results.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, jaccard_join, packing, quality, secret_scan
from tidemark.llm.queries import VOCABULARY
from tidemark.llm.shared import Scratch, table


#: Rows of whole texts in an Arrow batch.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    small_batches(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays."""
    small_batches(spark)
    return jaccard_join.keep_one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages shared with the benchmark are cut out."""
    small_batches(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked."""
    return secret_scan.redact(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences, one row per piece of a document, with its ids."""
    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), with_ids=True)


STAGES = [
    ("quality_classifier", quality_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("secret_scans", secret_stage),
    ("packing", packing_stage),
]

#: SQL can't express the classifier, the joins' components or the tokenizer; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        before, docs = docs, scratch.keep(stage(spark, docs, sf_dir), name)
        scratch.drop(before)  # the table of documents isn't the scratch's and stays
    return docs
