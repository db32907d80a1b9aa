"""Snapshots and what changed between two of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def snapshot_id(ts: Column, granularity: str) -> Column:
    """The name of the week (ISO), day, month or second that a time is in."""
    if granularity == "week":
        return F.concat(F.date_part(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))
    return F.date_format(ts, {"day": "yyyy-MM-dd", "month": "yyyy-MM", "timestamp": "yyyyMMdd'T'HHmmss"}[granularity])


def is_week_id(s: Column) -> Column:
    return s.rlike("^[0-9]{4}-W[0-9]{2}$")


def snapshots(listing: DataFrame) -> DataFrame:
    """(name, week, at): of folder names(name) those of weekly snapshots, a suffix of the time allowed, oldest first by week, then suffix."""
    week = F.regexp_extract("name", r"^([0-9]{4}-W[0-9]{2})(?:_[0-9]{6})?$", 1)
    return listing.select("name", week.alias("week"), F.regexp_extract("name", "_([0-9]{6})$", 1).alias("at")).filter(is_week_id(F.col("week")))


def compare(before: DataFrame, after: DataFrame) -> DataFrame:
    """name, status, ranks, subscribers, their changes and growth of (name, rank, subscribers) in two snapshots.

    A rank change is positive for a community that rose. Growth is in per cent, 0 from nothing.
    """
    b = before.select("name", F.col("rank").alias("old_rank"), F.col("subscribers").alias("old_subscribers"), F.lit(True).alias("was"))
    a = after.select("name", F.col("rank").alias("new_rank"), F.col("subscribers").alias("new_subscribers"), F.lit(True).alias("is_now"))
    j = b.join(a, "name", "full_outer")
    change = F.col("new_subscribers") - F.col("old_subscribers")
    return j.select(
        "name",
        F.when(F.col("was").isNull(), "new").when(F.col("is_now").isNull(), "disappeared").when(F.col("old_rank") != F.col("new_rank"), "moved").otherwise("same").alias("status"),
        "old_rank", "new_rank", (F.col("old_rank") - F.col("new_rank")).alias("rank_change"),
        "old_subscribers", "new_subscribers", change.alias("subscriber_change"),
        F.when(F.col("old_subscribers") > 0, change / F.col("old_subscribers") * 100).when(change.isNotNull(), 0.0).alias("growth"),
    )


def summary(changes: DataFrame, large: int = 1000) -> DataFrame:
    """Counts over a comparison."""
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    return changes.agg(
        n(F.col("status") != "new").alias("before"), n(F.col("status") != "disappeared").alias("after"), n(F.col("status") == "moved").alias("moved"),
        n(F.abs("subscriber_change") > large).alias("large_changes"), n(F.col("status") == "new").alias("new"), n(F.col("status") == "disappeared").alias("disappeared"),
    )


def largest(changes: DataFrame, column: str, k: int = 50) -> DataFrame:
    """The k rows whose column changed most, either way."""
    return changes.filter(F.col(column) != 0).orderBy(F.abs(F.col(column)).desc(), "name").limit(k)
