"""The corpus pipeline: five stages from ``documents`` to a training mix.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All but the
last return the columns of ``documents``.

1. ``quality``: documents above their language's perplexity threshold go.
2. ``near_duplicates``: of each component of linked documents, the one with
   the smallest id stays.
3. ``decontaminate``: documents that hold a window of a benchmark item go.
4. ``secrets``: reported spans are replaced; every document stays.
5. ``mix``: documents are drawn to their sources' target weights, with their
   shard, their position in it and the number of the copy.

Nulls, empty texts, ties, repeated rows and empty tables: as the operators'
docstrings define them; extra columns of ``documents`` pass through.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ludolake.llm import decontaminate as decontamination
from ludolake.llm import mixing, ngram_join, quality_model, secret_scan
from ludolake.llm.common import prepare, table
from ludolake.session import checkpoint_dir


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return quality_model.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return ngram_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return decontamination.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return secret_scan.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mixed_documents(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates),
          ("decontaminate", decontaminate), ("secrets", secrets), ("mix", mix)]

# The first stage's language model can't be written in SQL; the whole run is
# tested against the stages in plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns is written to the
    shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
