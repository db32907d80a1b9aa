"""Work lists: order, split, resume, errors and retries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NO_RANK = 10**12


def best_ranks(rows: DataFrame, ranked_only: bool = False) -> DataFrame:
    """(name, rank) with each name's smallest rank; without any it sorts last, or is left out."""
    rows = rows.filter(F.col("rank").try_cast("long").isNotNull()) if ranked_only else rows
    return rows.groupBy(F.lower("name").alias("name")).agg(F.min(F.coalesce(F.col("rank").cast("long"), F.lit(NO_RANK))).alias("rank"))


def crawl_order(targets: DataFrame, by: str = "rank", offset: int = 0, limit: int | None = None) -> DataFrame:
    """Targets by rank, then name, or by name alone; a part of them."""
    out = targets.orderBy(*(["rank", F.lower("name")] if by == "rank" else [F.lower("name")])).offset(offset)
    return out if limit is None else out.limit(limit)


def pending(targets: DataFrame, done: DataFrame) -> DataFrame:
    """Targets without a result that is free of errors."""
    return targets.join(done.filter("error is null or error = ''").select("name"), "name", "left_anti")


def numbered(rows: DataFrame, order: list[str], name: str = "at", per_bin: int = 250_000, most: int = 4096) -> DataFrame:
    """rows with their place (from 0) in `order`.

    Rows are dealt to bins of some `per_bin` rows (`most` bins at most), between cuts that are rows themselves: of those with the smallest hashes, some 64 a bin,
    each so many-th in order. Bins are counted, and numbered each by itself, so no task sorts all rows, whatever the values have in common (but for rows alike in
    all of `order`). Cuts depend on values alone, so it doesn't matter how often or where they are computed.
    """
    dealt = binned(rows, order, per_bin, most)
    sizes = dealt.groupBy("_bin").agg(F.count("*").alias("_size"))
    before = sizes.select("_bin", (F.sum("_size").over(Window.orderBy("_bin")) - F.col("_size")).alias("_before"))  # a row a bin
    placed = dealt.withColumn("_i", F.row_number().over(Window.partitionBy("_bin").orderBy(*order)))
    return placed.join(F.broadcast(before), "_bin").withColumn(name, (F.col("_before") + F.col("_i") - 1).cast("long")).drop("_bin", "_i", "_before")


def binned(rows: DataFrame, order: list[str], per_bin: int, most: int = 4096) -> DataFrame:
    """rows with `_bin`, a number that grows with `order`: see numbered."""
    place = F.struct(*order)
    bins = F.least(F.lit(most), F.floor(F.col("_n") / per_bin) + 1).cast("int")
    n = rows.agg(F.count("*").alias("_n"))
    some = rows.select(*order).crossJoin(F.broadcast(n))  # one row
    some = some.filter(F.xxhash64(*order) / F.lit(2.0**64) + 0.5 <= 64.0 * bins / F.col("_n")).select(place.alias("_p"), "_n").distinct()
    cuts = some.agg(F.array_sort(F.collect_list("_p")).alias("_s"), F.max("_n").alias("_n"))
    nth = F.transform(F.sequence(F.lit(1), F.greatest(bins - 1, F.lit(1))), lambda i: F.try_element_at("_s", F.ceil(i * F.size("_s") / bins).cast("int")))
    cuts = cuts.select(F.when(bins > 1, nth).otherwise(F.slice("_s", 1, 0)).alias("_cuts"))
    return rows.crossJoin(F.broadcast(cuts)).withColumn("_bin", _below("_cuts", place, most)).drop("_cuts")  # one row


def _below(cuts: str, value: Column, most: int) -> Column:
    """How many of the sorted cuts are less than the value, by halving; 0 without cuts."""
    whole = F.struct(F.lit(0).alias("lo"), F.coalesce(F.size(cuts), F.lit(0)).alias("hi"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        less = F.coalesce(F.get(cuts, mid) < value, F.lit(False))
        done = s["lo"] >= s["hi"]
        return F.struct(F.when(~done & less, mid + 1).otherwise(s["lo"]).alias("lo"), F.when(~done & ~less, mid).otherwise(s["hi"]).alias("hi"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(most.bit_length())), whole, halve, lambda s: s["lo"])


def _by_rank(targets: DataFrame) -> DataFrame:
    return numbered(targets, ["rank", "name"], "_at")


def split_interleaved(targets: DataFrame, workers: int) -> DataFrame:
    """worker: targets dealt in turn by rank and name."""
    return _by_rank(targets).withColumn("worker", (F.col("_at") % workers).cast("int")).drop("_at")


def split_contiguous(targets: DataFrame, workers: int) -> DataFrame:
    """worker: runs of targets whose sizes differ by one at most, longer ones first."""
    n = targets.agg(F.count("*").alias("_n"))
    t = _by_rank(targets).crossJoin(F.broadcast(n))  # one row
    size, longer = F.floor(F.col("_n") / workers), F.col("_n") % workers
    first = longer * (size + 1)
    worker = F.when(F.col("_at") < first, F.floor(F.col("_at") / (size + 1))).otherwise(longer + F.floor((F.col("_at") - first) / F.greatest(size, F.lit(1))))
    return t.withColumn("worker", worker.cast("int")).drop("_at", "_n")


def split_chunks(targets: DataFrame, size: int) -> DataFrame:
    """chunk: runs of `size` targets."""
    return _by_rank(targets).withColumn("chunk", F.floor(F.col("_at") / size).cast("int")).drop("_at")


def error_class(message: Column) -> Column:
    """The first kind of failure that a message names."""
    m = F.lower(F.coalesce(message, F.lit("")))
    has = lambda *words: F.coalesce(m.rlike("|".join(words)), F.lit(False))
    return (
        F.when(m == "", "none").when(has("connection refused", "err_connection_refused", "econnrefused"), "refused")
        .when(has("err_internet_disconnected", "err_name_not_resolved", "err_network", "getaddrinfo", "enotfound"), "connectivity")
        .when(has("target closed", "has been closed", "browser closed"), "closed").when(has("crash"), "crashed")
        .when(has("timeout", "timed out"), "timeout").otherwise("other")
    )


def error_counts(results: DataFrame) -> DataFrame:
    return results.groupBy(error_class(F.col("error")).alias("kind")).agg(F.count("*").alias("n"))


def retry_list(results: DataFrame) -> DataFrame:
    """Sorted r/<name> lines of failed targets, once each."""
    return results.filter(F.coalesce("error", F.lit("")) != "").select(F.concat(F.lit("r/"), "name").alias("value")).distinct().orderBy("value")


def _drawn(column: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(column).cast("string")))


def hashed_sample(files: DataFrame, column: str, n: int, seed: int = 13) -> DataFrame:
    """n rows in an order that a seed decides, then sorted: a sampling operator."""
    return files.orderBy(_drawn(column, seed), column).limit(n).orderBy(column)


def stratified_sample(files: DataFrame, column: str, per_third: int, seed: int = 13) -> DataFrame:
    """As many rows of the early, middle and late third by a column (longer thirds first): a sampling operator."""
    n = files.agg(F.count("*").alias("_n"))
    size, longer = F.floor(F.col("_n") / 3), F.col("_n") % 3
    first = longer * (size + 1)
    third = F.when(F.col("_at") < first, F.floor(F.col("_at") / (size + 1))).otherwise(longer + F.floor((F.col("_at") - first) / F.greatest(size, F.lit(1)))) + 1
    thirds = numbered(files, [column], "_at").crossJoin(F.broadcast(n)).withColumn("third", third.cast("int")).drop("_at", "_n")  # one row
    order = Window.partitionBy("third").orderBy(_drawn(column, seed), column)
    return thirds.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= per_third).drop("_r")


def candidate_posts(posts: DataFrame, min_score: int, kinds: list[str], max_age_days: float, limit: int) -> DataFrame:
    """Of each community's posts (community, pos, score, kind, age_days) the first that pass; a null kind does."""
    ok = (F.col("score") >= min_score) & (F.col("kind").isNull() | F.col("kind").isin(kinds)) & (F.coalesce("age_days", F.lit(0.0)) <= max_age_days)
    order = Window.partitionBy("community").orderBy("pos")
    return posts.filter(ok).withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= limit).drop("_r")


def required_fields(rows: DataFrame, fields: list[str], key: str = "community_id") -> DataFrame:
    """Per field how often it is missing or empty, how many keys repeat, and the subscribers' range and floored mean."""
    missing = [F.sum(F.when(F.coalesce(F.col(f).cast("string"), F.lit("")) == "", 1).otherwise(0)).cast("long").alias(f"missing_{f}") for f in fields]
    stats = rows.agg(F.count("*").alias("n"), *missing, F.min("subscribers").alias("least"), F.max("subscribers").alias("most"), F.floor(F.sum("subscribers") / F.count("subscribers")).cast("long").alias("mean"))
    twice = rows.groupBy(key).count().filter("count > 1").agg(F.count("*").alias("repeated"))
    return stats.crossJoin(twice)
