"""Stages on the small table: columns, decisions, and what they must keep."""
import corpus_pipeline as C
from pyspark.sql import functions as F

from ludolake.llm.common import table
from tests.conftest import SF_SMALL


def test_stages(spark, tmp_path):
    docs = table(spark, SF_SMALL, "documents").withColumn("text", F.when(F.col("doc_id") != 5, F.col("text")))
    columns, before = docs.columns, docs
    counts = []
    for name, stage in C.STAGES:
        stage(spark, docs, SF_SMALL).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        counts.append(docs.count())
        if name != "mix":
            assert docs.columns == columns
    assert counts[0] >= counts[1] >= counts[2] == counts[3]
    assert docs.filter("text LIKE '%token = \"%'").count() == 0
    assert docs.join(before, "doc_id", "left_anti").count() == 0
    assert {"shard", "position", "copy"} < set(docs.columns)
