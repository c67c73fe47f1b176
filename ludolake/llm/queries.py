"""The registered queries of the training-data operators, and their SQL.

Each query runs one operator, with its production parameters, over its whole
table. Where SQL can't express the operator there is no SQL here; the tests
hold the query against a brute-force version instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (decontaminate, fingerprint, language_id, mixing, ngram_join, quality_model, resampling, secret_scan,
               sentencepiece_bpe, suffix_dedup, url_rules, warc, whitening)
from .common import cut, table

#: The model of op13, one of the public tokenizers; a parameter of the operator.
PIECE_MODEL = "piece_bpe_32k.model"

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(table(spark, sf_dir, "documents"))


def op2_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


def op3_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    rules = cut(url_rules.mine(url_rules.labelled_urls(pages, table(spark, sf_dir, "labels"))))
    return url_rules.judge(pages, rules)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.scan(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digest(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.find(table(spark, sf_dir, "documents")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.digest(resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.digest(whitening.whiten(table(spark, sf_dir, "embeddings")))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = str(public_tokenizers.path(PIECE_MODEL))
    return sentencepiece_bpe.digest(sentencepiece_bpe.decode(
        sentencepiece_bpe.encode(table(spark, sf_dir, "documents"), path), path))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Query]:
    return {f.__name__: f for f in (
        op1_mixing, op2_fingerprint, op3_quality_model, op4_url_rules, op5_language_id, op6_ngram_jaccard_join,
        op7_decontaminate, op8_suffix_dedup, op9_secret_scan, op10_warc,
        op11_importance_resampling, op12_whitening, op13_sentencepiece, pipeline)}


def all_oracle_sql() -> dict[str, str]:
    return {"op6_ngram_jaccard_join": ngram_join.ORACLE, "op7_decontaminate": decontaminate.ORACLE,
            "op8_suffix_dedup": suffix_dedup.ORACLE, "op9_secret_scan": secret_scan.ORACLE, "op10_warc": warc.ORACLE,
            "op11_importance_resampling": resampling.ORACLE}
