"""Keyword tables laid out for point lookups: bucketed by community key and sorted in each bucket, so that asking for a few reads a few buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text
from ..operators import measures, quality

BUCKETS = 64


def write_lookup(keywords: DataFrame, key: str, table: str, buckets: int = BUCKETS, path: str | None = None) -> None:
    """Save keywords(key, rank, ...) as a table of `buckets` buckets by key, one file each, sorted by key and rank."""
    out = keywords.repartition(buckets, key).write.mode("overwrite").bucketBy(buckets, key).sortBy(key, "rank")
    (out.option("path", path) if path else out).saveAsTable(table)


def find(spark: SparkSession, table: str, key: str, values: list) -> DataFrame:
    """The rows of a few keys, in order; only their buckets are read."""
    return spark.table(table).filter(F.col(key).isin(values)).orderBy(key, "rank")


def inspect(keywords: DataFrame, communities: DataFrame, posts: DataFrame, key: str, k: int = 40, titles: int = 8, theme_k: int = 6) -> DataFrame:
    """One row a community of communities(key, name, url): its best terms, the share of each source among them, its theme's words and its best posts' texts.

    The theme's words are those of the community's key and of its first `theme_k` terms from descriptions.
    """
    best = keywords.filter(F.col("rank") <= k)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("rank", "term", "score", "source"))), lambda x: F.struct(x["term"].alias("term"), x["score"].alias("score"), x["source"].alias("source")))
    share = [F.avg(F.when(measures.has_source(s), 1.0).otherwise(0.0)).alias(s) for s in ("name", "description", "posts", "posts_composed")]
    per = best.groupBy(key).agg(listed.alias("terms"), *share)
    own = themes(keywords, communities, key, theme_k)
    top = measures.top_posts(posts, key, titles).groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("place", "text"))), lambda x: x["text"]).alias("titles"))
    return communities.join(per, key, "left").join(own, key, "left").join(top, key, "left")


def themes(keywords: DataFrame, communities: DataFrame, key: str, k: int = 6) -> DataFrame:
    """(key, theme): the words of each community's canonical key, cut at changes of letters and digits, and of its first k terms from descriptions; sorted, once each."""
    bare = text.community_key(F.col("name"), F.col("url"))
    parts = F.transform(text.camel_split(F.when(bare != "", bare).otherwise(text.canonical_key(F.col("name")))), F.lower)
    own = communities.select(key, parts.alias("own"))
    from_desc = keywords.filter(F.col("source").contains("description"))
    first = quality.first_rows(from_desc, key, k).groupBy(key).agg(F.flatten(F.collect_list(text.tokens(F.col("term")))).alias("words"))
    none = F.array().cast("array<string>")
    return own.join(first, key, "left").select(key, F.array_sort(F.array_distinct(F.concat("own", F.coalesce("words", none)))).alias("theme"))
