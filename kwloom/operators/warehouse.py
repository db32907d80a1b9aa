"""Idempotent loads into the four warehouse tables, as DataFrames of old and new rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .ops import numbered

OVERWRITTEN = ["name", "url", "rank", "subscribers_count", "source_page", "source_path"]
NON_EMPTY = ["full_url", "displayed_count", "description", "icon_url"]


def upsert_communities(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row a community_id: the newest row's values, the newest that isn't empty for texts, the latest scrape, the first sight.

    Both have an order column `seq`; of old and new rows the higher is newer.
    """
    every = old.unionByName(new, allowMissingColumns=True)
    last = lambda c: F.max_by(c, "seq").alias(c)
    full = lambda c: F.max_by(c, F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("seq"))).alias(c)
    have = set(every.columns)
    return every.groupBy("community_id").agg(
        *[last(c) for c in OVERWRITTEN if c in have],
        *[full(c) for c in NON_EMPTY if c in have],
        F.min_by("seen_at", "seq").alias("first_seen_at"),
        F.max_by("seen_at", "seq").alias("last_seen_at"),
        F.max("scraped_at").alias("last_scraped_at"),
    )


def extend_dictionary(known: DataFrame, terms: DataFrame) -> DataFrame:
    """known(id, term) and new terms with ids that follow the highest, in the terms' order; a term keeps its id."""
    new = numbered(terms.select("term").distinct().join(known, "term", "left_anti"), ["term"])
    top = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("top"))
    return known.select("id", "term").unionByName(new.crossJoin(F.broadcast(top)).select((F.col("top") + F.col("at") + 1).cast("long").alias("id"), "term"))  # one row


def upsert_links(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row a (community_id, keyword_id), the newest by `seq`."""
    every = old.unionByName(new)
    order = Window.partitionBy("community_id", "keyword_id").orderBy(F.desc("seq"))
    return every.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def latest_ingests(log: DataFrame) -> DataFrame:
    """The last row of each input_file, by processed_at, then id."""
    order = Window.partitionBy("input_file").orderBy(F.desc("processed_at"), F.desc("id"))
    return log.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def changed_files(files: DataFrame, log: DataFrame) -> DataFrame:
    """Files(input_file, file_hash) that the log doesn't have as loaded with the same hash."""
    done = latest_ingests(log).filter("status = 'ok'").select("input_file", "file_hash")
    return files.join(done, ["input_file", "file_hash"], "left_anti")


def orphans(links: DataFrame, communities: DataFrame, keywords: DataFrame) -> DataFrame:
    """How many links name a community or keyword that isn't there."""
    a = links.join(communities.select("community_id"), "community_id", "left_anti").agg(F.count("*").alias("no_community"))
    return a.crossJoin(links.join(keywords.select(F.col("id").alias("keyword_id")), "keyword_id", "left_anti").agg(F.count("*").alias("no_keyword")))


def one_per_page(rows: DataFrame) -> DataFrame:
    """Of rows of a page with the same community_id (or name and url without one) the first by `seq`."""
    ident = F.coalesce(F.nullif(F.col("community_id"), F.lit("")), F.concat_ws("\u0001", "name", "url"))
    order = Window.partitionBy("page", ident).orderBy("seq")
    return rows.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def log_rows(loads: DataFrame, log: DataFrame) -> DataFrame:
    """Rows for the ingest log from loads(input_file, file_hash, processed_at, error): ids follow the log's highest in order of file; a load with an error says so."""
    top = log.agg(F.coalesce(F.max("id"), F.lit(0)).alias("_top"))
    new = numbered(loads, ["input_file", "processed_at"], "_at").crossJoin(F.broadcast(top))  # one row
    bad = F.coalesce("error", F.lit("")) != ""
    return new.select((F.col("_top") + F.col("_at") + 1).cast("long").alias("id"), "input_file", "file_hash", "processed_at", F.when(bad, "error").otherwise("ok").alias("status"), F.when(bad, F.col("error")).alias("error"))


def file_hashes(contents: DataFrame) -> DataFrame:
    """(input_file, file_hash): SHA-256 of whole files as the binaryFile source reads them (path, content)."""
    return contents.select(F.col("path").alias("input_file"), F.sha2("content", 256).alias("file_hash"))


def key_set_hash(keys: DataFrame, column: str) -> DataFrame:
    """One row: a hash of the set of keys, whatever their order: the sum and the exclusive-or of the hashes of distinct keys, hashed once more."""
    h = keys.select(F.col(column).cast("string").alias("k")).distinct().select(F.xxhash64("k").alias("h"))
    return h.agg(F.count("*").alias("n"), F.bit_xor("h").alias("x"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s")).select("n", F.sha1(F.concat_ws(":", "n", "x", "s")).alias("key_hash"))


def integrity(communities: DataFrame, dictionary: DataFrame, links: DataFrame) -> DataFrame:
    """One row of counts: the three tables' rows and the links without a community or keyword."""
    counts = communities.agg(F.count("*").alias("communities")).crossJoin(dictionary.agg(F.count("*").alias("keywords"))).crossJoin(links.agg(F.count("*").alias("links")))  # one row each
    return counts.crossJoin(orphans(links, communities, dictionary))
