"""Document frequencies kept up to date by a stream of files (an addition: the batch plans have no streams)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import KeywordConfig
from ..operators import terms
from ..plans import keywords as plans


def add_batch(batch: DataFrame, batch_id: int, path: str, key: str, cfg: KeywordConfig) -> None:
    """Write one batch's frequencies under its own number: a batch that is run again replaces itself, so none counts twice."""
    batch = batch.persist()
    df = terms.document_frequency(plans.description_terms(batch, key, cfg), key)
    n = batch.agg(F.lit(None).cast("string").alias("term"), F.count("*").alias("df"))
    df.unionByName(n).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
    batch.unpersist()


def document_frequencies(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(term, df) over all batches, and a row with the number n of documents."""
    every = spark.read.parquet(path)
    return every.filter("term is not null").groupBy("term").agg(F.sum("df").alias("df")), every.filter("term is null").agg(F.sum("df").alias("n"))


def watch(spark: SparkSession, source: str, schema: str, path: str, checkpoint: str, key: str, cfg: KeywordConfig):
    """Take in the files that have come since the last run, then stop; the checkpoint remembers which those are."""
    stream = spark.readStream.schema(schema).json(source)
    return stream.writeStream.foreachBatch(lambda b, i: add_batch(b, i, path, key, cfg)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 day", late: str = "2 hours") -> DataFrame:
    """Events(ts, event_type) by tumbling window and type; with a watermark on a stream, so state stays bounded."""
    if events.isStreaming:
        events = events.withWatermark("ts", late)
    return events.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
