"""The operators as queries over whole tables, and SQL for those that it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, filters, language, lexical, license, neighbours, perplexity, pii, quality, simhash, tokenfile, toxicity, winnow


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(_table(spark, sf_dir, "documents"))


def op3_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_table(spark, sf_dir, "documents"))


def op4_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perplexity.scores(_table(spark, sf_dir, "documents"))


def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(_table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(_table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op8_tokenfile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.token_file_digest(_table(spark, sf_dir, "documents"))


def op9_winnow(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(_table(spark, sf_dir, "embeddings"), "vec_id % 100 = 0")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op12_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_toxicity, op2_pii, op3_license, op4_perplexity, op5_bpe, op6_language, op7_simhash, op8_tokenfile, op9_winnow, op10_neighbours, op11_quality, op12_lexical, op13_filters)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op10_neighbours": neighbours.ORACLE, "op12_lexical": lexical.ORACLE, "op13_filters": filters.ORACLE}
