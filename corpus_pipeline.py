"""A corpus pipeline: toxicity, near-duplicates, benchmark decontamination, personal data, token counts.

Each stage takes the documents that the one before has kept, written as Parquet and read again.

In every stage a null doc_id is an id like any other, own columns of any name stay as they are, texts are worked on whole, and an empty table
gives an empty one. Null, empty and wordless texts pass the toxicity stage, are copies of one another in the second (one of them stays), hold no
passage of the benchmark and no personal data, and have no tokens. Of repeated rows one stays after the second stage; the others treat each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from kwloom.llm import bpe, nearcopies, pii, toxicity, winnow
from kwloom.llm._util import remove, scratch


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; it learns from the labelled ones among docs."""
    return toxicity.acceptable(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (SimHash at four bits, and five-word shingles at Jaccard 0.8), that with the smallest doc_id."""
    return nearcopies.keep_one(docs, fingerprints=True)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no passage with the benchmark."""
    return winnow.decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts masked."""
    return pii.masked(docs)


def count_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the number and digest of their token ids and the digest of the text that these decode to."""
    return bpe.token_counts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("tokens", count_tokens),
]

#: SQL can express neither the classifier nor the network nor the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to the table documents; each result goes to the shared folder, where the next stage reads it, and is deleted when that has written its own."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        path = scratch(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
