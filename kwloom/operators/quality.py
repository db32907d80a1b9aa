"""Quality measures of keyword lists, and comparisons of two versions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Words that hold a phrase together; words of adverts; places where addresses show.
CONNECTORS = "the and of in to for with or but on at by".split()
PROMOTION = "buy sale discount coupon promo deal offer shop store free shipping".split()
ADDRESS = r"https?|www\.|\.com|\.org|\.net"


def words(term: Column) -> Column:
    return F.split(term, " ")


def repeats(term: Column) -> Column:
    w = words(F.lower(term))
    return F.size(F.array_distinct(w)) < F.size(w)


def mechanical(term: Column) -> Column:
    """Four words or more without a connector or a repeat."""
    w = words(F.lower(term))
    return (F.size(w) >= 4) & ~F.arrays_overlap(w, F.array(*[F.lit(c) for c in CONNECTORS])) & ~repeats(term)


def promotional(term: Column) -> Column:
    return F.exists(words(F.lower(term)), lambda w: w.isin(PROMOTION))


def quality_issue(term: Column) -> Column:
    """Repeats, more than five words without a connector, or a piece of an address."""
    w = words(F.lower(term))
    long = (F.size(w) > 5) & ~F.arrays_overlap(w, F.array(*[F.lit(c) for c in CONNECTORS]))
    return repeats(term) | long | F.lower(term).rlike(ADDRESS)


def coherence(term: Column) -> Column:
    """Mean likeness of neighbouring words: 0.3 for similar lengths, 0.4 by shared letters, 0.3 for a common first or last two letters."""
    w = words(F.lower(term))

    def like(a: Column, b: Column) -> Column:
        longer = F.greatest(F.length(a), F.length(b))
        near = F.when(F.abs(F.length(a) - F.length(b)) / F.greatest(longer, F.lit(1)) < 0.5, 0.3).otherwise(0.0)
        x, y = F.array_distinct(F.split(a, "")), F.array_distinct(F.split(b, ""))
        share = 0.4 * F.size(F.array_intersect(x, y)) / F.greatest(F.size(F.array_union(x, y)), F.lit(1))
        affix = F.when((F.substring(a, 1, 2) == F.substring(b, 1, 2)) | (F.substring(a, -2, 2) == F.substring(b, -2, 2)), 0.3).otherwise(0.0)
        return near + share + affix

    pairs = F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), like)
    return F.when(F.size(w) < 2, 1.0).otherwise(F.aggregate(pairs, F.lit(0.0), lambda s, v: s + v) / F.greatest(F.size(w) - 1, F.lit(1)))


def jaccard(a: Column, b: Column) -> Column:
    x, y = words(F.lower(a)), words(F.lower(b))
    return F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y))


def size_bucket(n: Column, inclusive: bool = True) -> Column:
    """1M, 100K, 10K, 1K or smaller; the limits belong to the upper bucket if inclusive."""
    at = lambda v: (n >= v) if inclusive else (n > v)
    return F.when(at(1_000_000), "1M").when(at(100_000), "100K").when(at(10_000), "10K").when(at(1_000), "1K").otherwise("small")


def score_tier(score: Column) -> Column:
    return F.when(score >= 50, "50+").when(score >= 20, "20-50").when(score >= 10, "10-20").when(score >= 5, "5-10").otherwise("0-5")


def shares(keywords: DataFrame) -> DataFrame:
    """Shares of unigrams, phrases and sources among keywords(term, source)."""
    n, rate = F.size(words(F.col("term"))), lambda c: F.avg(F.when(c, 1.0).otherwise(0.0))
    has = lambda s: F.array_contains(F.split("source", r"\+"), s)
    return keywords.agg(F.count("*").alias("n"), rate(n == 1).alias("unigrams"), rate(n >= 2).alias("phrases"), *[rate(has(s)).alias(s) for s in ("name", "description", "posts", "posts_composed")])


def quantile_nearest(values: DataFrame, column: str, p: float) -> DataFrame:
    """The value at place round-half-even(p * (n - 1)) of the sorted column."""
    return at_places(values, column, {"value": F.expr(f"cast(bround({p}D * (n - 1)) as bigint)")}).filter("value is not null")


def quantile_floor(values: DataFrame, column: str, p: float) -> DataFrame:
    """The value at place floor(n * p), the last at most."""
    return at_places(values, column, {"value": F.least(F.floor(F.lit(p) * F.col("n")).cast("bigint"), F.col("n") - 1)}).filter("value is not null")


def at_places(values: DataFrame, column: str, places: dict[str, Column], bins: int = 64, by: tuple[str, ...] = ()) -> DataFrame:
    """One row with the values at places (from 0, by the number n of values) of the sorted column; null without values. by: a row for each group, of a few.

    Values are dealt to bins between approximate quantiles and the bins counted; only bins that hold a place are sorted, each in a task of its own.
    """
    v = values.select(*by, F.col(column).alias("value")).filter("value is not null")
    head = v.groupBy(*by).agg(F.count("*").alias("n"), F.percentile_approx("value", F.array(*[F.lit(i / bins) for i in range(1, bins)]), F.lit(10_000)).alias("cuts"))
    runs = v.groupBy(*by, "value").agg(F.count("*").alias("c"))
    runs = runs.join(F.broadcast(head), list(by)) if by else runs.crossJoin(F.broadcast(head))  # a row a group
    runs = runs.withColumn("bin", F.size(F.filter("cuts", lambda x: x < F.col("value")))).drop("cuts")
    sizes = runs.groupBy(*by, "bin").agg(F.sum("c").alias("size"), F.first("n").alias("n"))
    sizes = sizes.withColumn("before", F.sum("size").over(Window.partitionBy(*by).orderBy("bin")) - F.col("size"))  # a row a bin
    held = F.lit(False)
    for place in places.values():
        held = held | ((place >= F.col("before")) & (place < F.col("before") + F.col("size")))
    some = runs.join(F.broadcast(sizes.filter(held).select(*by, "bin", "before")), [*by, "bin"])
    some = some.withColumn("to", F.col("before") + F.sum("c").over(Window.partitionBy(*by, "bin").orderBy("value")))
    found = [F.max(F.when((place < F.col("to")) & (place >= F.col("to") - F.col("c")), F.col("value"))).alias(name) for name, place in places.items()]
    return some.groupBy(*by).agg(*found, F.max("n").alias("n")) if by else some.agg(*found)


def quantile_linear(values: DataFrame, column: str, *ps: float, by: tuple[str, ...] = ()) -> DataFrame:
    """One row (by: a row a group): for each p the value at p * (n - 1) of the sorted column, between two neighbours in proportion."""
    spots = {f"{side}{i}": getattr(F, f)(F.lit(p) * (F.col("n") - 1)).cast("bigint") for i, p in enumerate(ps) for side, f in (("low", "floor"), ("high", "ceil"))}
    found = at_places(values, column, spots, by=by)
    found = found if by else found.crossJoin(values.agg(F.count(column).alias("n")))  # one row each
    part = lambda p: F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1))
    return found.select(*by, *[(F.col(f"low{i}") + (F.col(f"high{i}") - F.col(f"low{i}")) * part(p)).alias(f"p{round(100 * p)}") for i, p in enumerate(ps)])


def describe(values: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return values.agg(F.count(c).alias("n"), F.avg(c).alias("mean"), F.stddev_pop(c).alias("stdev"), F.min(c).alias("least"), F.max(c).alias("most"))


def retention(keywords: DataFrame, key: str, thresholds: list[float]) -> DataFrame:
    """For each threshold: kept keywords and their share, and the mean and median kept per document."""
    t = F.explode(F.array(*[F.lit(float(x)) for x in thresholds])).alias("threshold")
    per = keywords.select(key, "score", t).groupBy("threshold", key).agg(F.sum(F.when(F.col("score") >= F.col("threshold"), 1).otherwise(0)).alias("kept"), F.count("*").alias("n"))
    return per.groupBy("threshold").agg(F.sum("kept").alias("kept"), (F.sum("kept") / F.sum("n")).alias("share"), F.avg("kept").alias("mean_kept"), F.percentile("kept", F.lit(0.5)).alias("median_kept"))


#: What each category of sources asks of a keyword's sources.
CATEGORIES = {
    "all": lambda s: F.lit(True), "posts_composed": lambda s: F.array_contains(s, "posts_composed"), "posts": lambda s: F.array_contains(s, "posts") & ~F.array_contains(s, "posts_composed"),
    "description": lambda s: F.array_contains(s, "description"), "name": lambda s: F.array_contains(s, "name"),
}


def retention_by_category(keywords: DataFrame, key: str, thresholds: list[float]) -> DataFrame:
    """(category, threshold, kept, share, mean_kept, median_kept): retention for each category of sources, over all documents, those without a term of it too."""
    s, score = F.split(F.coalesce("source", F.lit("")), r"\+"), F.coalesce("score", F.lit(0.0))
    count = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    each = [
        F.struct(F.lit(name).alias("category"), count(test(s)).alias("n"), F.array(*[F.struct(F.lit(float(t)).alias("threshold"), count(test(s) & (score >= t)).alias("kept")) for t in thresholds]).alias("at"))
        for name, test in CATEGORIES.items()
    ]
    per = keywords.groupBy(key).agg(*[c.alias(f"c{i}") for i, c in enumerate(each)])
    rows = per.select(F.explode(F.array(*[f"c{i}" for i in range(len(each))])).alias("c")).select("c.category", "c.n", F.explode("c.at").alias("a")).select("category", "n", "a.threshold", "a.kept")
    # lists are short, so their counts are few values
    return rows.groupBy("category", "threshold").agg(F.sum("kept").alias("kept"), (F.sum("kept") / F.greatest(F.sum("n"), F.lit(1))).alias("share"), F.avg("kept").alias("mean_kept"), F.percentile("kept", F.lit(0.5)).alias("median_kept"))


def source_effect(keywords: DataFrame, least: int = 100) -> DataFrame:
    """(source, n, mean, median, stdev) of sources with `least` keywords or more."""
    k = keywords.withColumn("source", F.coalesce("source", F.lit("unknown")))
    per = k.groupBy("source").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("stdev")).filter(F.col("n") >= least)
    # a row a source, of which there are few
    return per.join(F.broadcast(quantile_linear(k, "score", 0.5, by=("source",)).withColumnRenamed("p50", "median")), "source", "left")


def source_by_rank(keywords: DataFrame) -> DataFrame:
    """(rank, source, share): the most frequent source at each rank (of equals the first by name) and its share there."""
    n = keywords.groupBy("rank", "source").agg(F.count("*").alias("n"))
    per = n.groupBy("rank").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    first = n.join(per, "rank").filter(F.col("n") == F.col("most"))
    return first.groupBy("rank").agg(F.min("source").alias("source"), F.max(F.col("most") / F.col("all")).alias("share"))


def rank_decay(keywords: DataFrame, step: int = 5) -> DataFrame:
    """Mean score by rank, how far it falls to the rank `step` below, and from the rank above (per cent)."""
    by = keywords.groupBy("rank").agg(F.avg("score").alias("mean"), F.count("*").alias("n"))
    order = Window.orderBy("rank")  # a row a rank
    m = F.col("mean")
    return by.select("rank", "n", "mean", (F.try_divide(m - F.lead("mean", step).over(order), m) * 100).alias("drop_ahead"), F.when(F.col("n") >= 10, F.try_divide(F.lag("mean", 1).over(order) - m, F.lag("mean", 1).over(order)) * 100).alias("drop_before"))


def zipf(counts: DataFrame) -> DataFrame:
    """(word, zipf) of (word, n): the decimal logarithm of a word's occurrences in 10**9 words."""
    total = counts.agg(F.sum("n").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select("word", F.log10(F.lit(1e9) * F.col("n") / F.col("_all")).alias("zipf"))  # one row


def frequent_words(frequencies: DataFrame, threshold: float, kept: list[str]) -> list[str]:
    """The words of frequencies(word, zipf) at or above a threshold, but those that are kept in any case.

    Frequencies sum to one, so at most 10**(9 - threshold) words reach it: a list of proven size, refused where that could pass 10**6.
    """
    if threshold < 3:
        raise ValueError("a threshold below 3 lets too many words through for a list")
    return sorted(r.word for r in frequencies.filter((F.col("zipf") >= threshold) & ~F.col("word").isin(kept)).select("word").distinct().toLocalIterator())


def generic_unigrams(keywords: DataFrame, frequencies: DataFrame, threshold: float, stopwords: list[str]) -> DataFrame:
    """The rows of keywords with a flag `generic`: a single word that is a stopword or as frequent as the threshold; each distinct word meets the table once."""
    low = F.lower(F.trim("term"))
    words = keywords.select(low.alias("word")).filter((F.col("word") != "") & ~F.col("word").contains(" ")).distinct()
    listed = words.join(frequencies.select("word", "zipf"), "word", "left").select("word", (F.col("word").isin(list(stopwords)) | F.coalesce(F.col("zipf") >= threshold, F.lit(False))).alias("generic"))
    out = keywords.withColumn("_w", low).join(listed.filter("generic").withColumnRenamed("word", "_w"), "_w", "left").drop("_w")
    return out.withColumn("generic", F.coalesce("generic", F.lit(False)))


def variant_groups(keywords: DataFrame) -> DataFrame:
    """(dkey, variants): spellings that differ only by case, spaces or punctuation."""
    d = F.regexp_replace(F.lower("term"), "[^0-9a-z]+", "").alias("dkey")
    return keywords.groupBy(d).agg(F.array_sort(F.collect_set("term")).alias("variants")).filter("size(variants) > 1 and dkey <> ''")


def first_rows(keywords: DataFrame, key: str, k: int) -> DataFrame:
    """The first k rows of each document's list, by rank."""
    return keywords.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy("rank"))).filter(F.col("_r") <= k).drop("_r")


def redundant_pairs(keywords: DataFrame, key: str, limit: float = 0.7) -> DataFrame:
    """Pairs of a document's keywords (ranked, so of a bounded list) of which one holds the other or most words are shared."""
    a = keywords.select(key, F.col("rank").alias("rank_a"), F.col("term").alias("a"))
    b = keywords.select(key, F.col("rank").alias("rank_b"), F.col("term").alias("b"))
    j = a.join(b, key).filter("rank_a < rank_b")
    kind = F.when(F.col("a").contains(F.col("b")) | F.col("b").contains(F.col("a")), "substring").when(jaccard(F.col("a"), F.col("b")) >= limit, "overlap")
    return j.withColumn("kind", kind).filter("kind is not null")


def source_mix(keywords: DataFrame) -> DataFrame:
    """Per source pattern: keywords, mean score, and whether it joins several sources."""
    return keywords.groupBy("source").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), F.first(F.col("source").contains("+")).alias("several"))


def tier_issues(keywords: DataFrame) -> DataFrame:
    """Per score tier: keywords and the share with an issue."""
    return keywords.groupBy(score_tier(F.col("score")).alias("tier")).agg(F.count("*").alias("n"), F.avg(F.when(quality_issue(F.col("term")), 1.0).otherwise(0.0)).alias("issues"))


def dominant_word(keywords: DataFrame, key: str, share: float = 0.3) -> DataFrame:
    """Words that make more than a share of all words in a document's keywords."""
    w = keywords.select(key, F.explode(words(F.lower(F.col("term")))).alias("word")).groupBy(key, "word").agg(F.count("*").alias("n"))
    return w.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(key))).filter(F.col("share") > share)


def version_diff(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Per document in both versions: terms gained, lost and kept, mechanical ones before and after, and which way they went."""
    both = a.select(key).distinct().join(b.select(key).distinct(), key, "left_semi")
    x = a.select(key, "term", F.lit(1).alias("in_a")).distinct().join(b.select(key, "term", F.lit(1).alias("in_b")).distinct(), [key, "term"], "full_outer").join(both, key, "left_semi")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).cast("long")
    was, now, m = F.col("in_a").isNotNull(), F.col("in_b").isNotNull(), mechanical(F.col("term"))
    d = x.groupBy(key).agg(n(now & ~was).alias("gained"), n(was & ~now).alias("lost"), n(was & now).alias("same"), n(was & m).alias("mechanical_before"), n(now & m).alias("mechanical_after"))
    return d.withColumn("verdict", F.when(F.col("mechanical_after") < F.col("mechanical_before"), "better").when(F.col("mechanical_after") > F.col("mechanical_before"), "worse").otherwise("same"))


def theme_alignment(keywords: DataFrame, themes: DataFrame, key: str) -> DataFrame:
    """Sum over ranks up to 10 of the share of a term's words in the theme, times score over rank."""
    j = keywords.filter("rank <= 10").join(themes.select(key, "theme"), key)
    w = words(F.col("term"))
    return j.groupBy(key).agg(F.sum(F.size(F.filter(w, lambda t: F.array_contains(F.col("theme"), t))) / F.size(w) * F.col("score") / F.col("rank")).alias("alignment"))


def separation(keywords: DataFrame, key: str) -> DataFrame:
    """How far the mean of the five best scores is above that of the five last, as a share of it; and source diversity in the top ten."""
    n = F.count("*").over(Window.partitionBy(key))
    k = keywords.withColumn("n", n)
    top, last = F.avg(F.when(F.col("rank") <= 5, F.col("score"))), F.avg(F.when(F.col("rank") > F.col("n") - 5, F.col("score")))
    return k.groupBy(key).agg(F.try_divide(top - last, top).alias("separation"), (F.countDistinct(F.when(F.col("rank") <= 10, F.col("source"))) / 10).alias("diversity"))
