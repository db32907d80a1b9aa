"""Measures over finished keyword lists, communities and posts that reports are made of.

keywords has a row a term: key, rank (from 1), term, score, source. Ranks bound what a document holds, so windows by document are small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text
from . import quality

# Words that lists should not hold, by category, and words of adverts in list tails.
LOW_VALUE = {
    "generic_conversation": "guys thing stuff things something someone anything".split(),
    "time_references": "today yesterday tomorrow now then recently".split(),
    "vague_quantifiers": "lot much many some few little bit".split(),
    "generic_actions": "doing getting going coming looking trying".split(),
    "informal_language": "lol lmao tbh imo btw omg".split(),
    "discourse_markers": "like just really pretty quite very".split(),
    "promotional": "check click visit subscribe follow buy".split(),
}
TAIL_ADVERTS = "buy sale discount promo".split()


def has_source(name: str) -> Column:
    return F.array_contains(F.split("source", r"\+"), name)


def _rate(c: Column) -> Column:
    return F.avg(F.when(c, 1.0).otherwise(0.0))


# --- themes and composed terms -----------------------------------------------------------------------------------------------


def off_theme(keywords: DataFrame, themes: DataFrame, key: str) -> DataFrame:
    """The terms from posts (not composed) with a flag `off`: no word of theirs is in the document's theme (key, theme); without a theme all are."""
    mine = keywords.filter(has_source("posts") & ~has_source("posts_composed")).join(themes.select(key, "theme"), key, "left")
    return mine.withColumn("off", ~F.coalesce(F.arrays_overlap(F.split("term", " "), "theme"), F.lit(False))).drop("theme")


def off_theme_rate(flagged: DataFrame) -> DataFrame:
    return flagged.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col("off").cast("long")), F.lit(0)).alias("off"), F.coalesce(_rate(F.col("off")), F.lit(0.0)).alias("rate"))


def off_theme_terms(flagged: DataFrame, most: int = 40, per_length: int = 30) -> DataFrame:
    """(kind, place, term, n): the most frequent terms off the theme, of all lengths and of one, two and more words; ties by term."""
    n = flagged.filter("off").groupBy("term").agg(F.count("*").alias("n"))
    words = F.size(F.split("term", " "))
    kinds = F.array(F.lit("all"), F.when(words == 1, "unigram").when(words == 2, "bigram").otherwise("trigram"))
    order = Window.partitionBy("kind").orderBy(F.desc("n"), "term")
    placed = n.select("term", "n", F.explode(kinds).alias("kind")).withColumn("place", F.row_number().over(order))
    # the plain limit is one that Spark applies in each task before terms are dealt out by kind
    placed = placed.filter(F.col("place") <= max(most, per_length))
    return placed.filter(F.col("place") <= F.when(F.col("kind") == "all", most).otherwise(per_length)).select("kind", "place", "term", "n")


def composed_seeds(keywords: DataFrame, anchors: DataFrame, key: str) -> DataFrame:
    """Composed terms with the seed behind their anchor (key, phrase, token), the score of the best term from posts that is that seed, and the ratio of both."""
    k = keywords.join(anchors.select(key, F.lower("phrase").alias("phrase"), F.lower("token").alias("token")), key, "left")
    low = F.lower("term")
    behind = lambda a: F.when((F.col(a) != "") & low.startswith(F.concat(a, F.lit(" "))), F.expr(f"substring(lower(term), length({a}) + 2)"))
    made = k.filter(F.col("source").contains("posts_composed")).select(key, "rank", "term", "score", F.coalesce(behind("phrase"), behind("token")).alias("seed"))
    seeds = keywords.filter(F.col("source").contains("posts") & ~F.col("source").contains("composed"))
    seeds = seeds.groupBy(key, F.lower("term").alias("seed")).agg(F.min_by("score", "rank").alias("seed_score"))
    return made.join(seeds, [key, "seed"], "left").withColumn("ratio", F.when(F.col("seed_score") > 0, F.col("score") / F.col("seed_score")))


def composed_statistics(seeded: DataFrame) -> DataFrame:
    """Counts, ranks and ratios of composed terms."""
    all_rows = seeded.agg(
        F.count("*").alias("n"), F.avg("rank").alias("mean_rank"), F.min("rank").alias("best_rank"), F.max("rank").alias("last_rank"),
        F.count("ratio").alias("ratios"), F.avg("ratio").alias("mean_ratio"), F.min("ratio").alias("least_ratio"), F.max("ratio").alias("most_ratio"),
    )
    return all_rows.crossJoin(_median(seeded.select(F.round("ratio", 6).alias("ratio")), "ratio", "median_ratio"))  # one row each


def _median(values: DataFrame, column: str, name: str) -> DataFrame:
    """One row: the median, found without gathering the values in a task."""
    return quality.quantile_linear(values, column, 0.5).withColumnRenamed("p50", name)


def composition_rates(keywords: DataFrame, key: str, top: int = 10) -> DataFrame:
    """Over documents: mean and median share of composed terms in their best ones, and how many are over a half and over four fifths."""
    per = keywords.filter(F.col("rank") <= top).groupBy(key).agg(_rate(F.col("source").contains("composed")).alias("rate"))
    over = lambda x: F.sum((F.col("rate") > x).cast("long"))
    return per.agg(F.count("*").alias("documents"), F.avg("rate").alias("mean"), over(0.5).alias("over_half"), over(0.8).alias("over_four_fifths")).crossJoin(_median(per, "rate", "median"))  # one row each


def new_composed(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Composed terms that version b has and version a has not."""
    only = lambda d: d.filter(F.col("source").contains("composed"))
    return only(b).join(only(a).select(key, "term"), [key, "term"], "left_anti")


# --- lists -------------------------------------------------------------------------------------------------------------------


def variants(keywords: DataFrame, key: str) -> DataFrame:
    """(key, kind, form, terms): terms of a document that differ only in spaces, or only in punctuation."""
    low = F.lower("term")
    forms = {"spacing": F.regexp_replace(low, r"\s+", ""), "punctuation": F.trim(F.regexp_replace(F.regexp_replace(low, r"[^\p{L}\p{N}_\s]", ""), r"\s+", " "))}
    pairs = F.array(*[F.struct(F.lit(k).alias("kind"), c.alias("form")) for k, c in forms.items()])
    each = keywords.select(key, "term", F.explode(pairs).alias("v")).select(key, "term", "v.kind", "v.form")
    return each.groupBy(key, "kind", "form").agg(F.array_sort(F.collect_list("term")).alias("terms")).filter("size(terms) > 1")


def dominant_sources(keywords: DataFrame, key: str, top: int = 20, least: int = 10, share: float = 0.8) -> DataFrame:
    """(key, source, share) of documents with `least` terms or more whose best ones come from one source to more than a share."""
    enough = keywords.groupBy(key).agg(F.count("*").alias("size")).filter(F.col("size") >= least)
    n = keywords.filter(F.col("rank") <= top).groupBy(key, "source").agg(F.count("*").alias("n"))
    per = n.groupBy(key).agg(F.max(F.struct("n", "source")).alias("best"), F.sum("n").alias("all"))
    out = per.join(enough, key, "left_semi").select(key, F.col("best.source").alias("source"), (F.col("best.n") / F.col("all")).alias("share"))
    return out.filter(F.col("share") > share)


def score_anomalies(keywords: DataFrame, key: str, limit: float = 50.0) -> DataFrame:
    """(key, most, mean, ratio, term) of documents whose best score is over `limit` times the mean."""
    per = keywords.groupBy(key).agg(F.count("*").alias("n"), F.max("score").alias("most"), F.avg("score").alias("mean"), F.min_by("term", "rank").alias("term"))
    return per.filter("n > 1").withColumn("ratio", F.col("most") / (F.col("mean") + 1e-6)).filter(F.col("ratio") > limit).drop("n")


def topk_scenarios(keywords: DataFrame, key: str, sizes: list[int], now: int = 40, ahead: int = 20) -> DataFrame:
    """For each list length: documents that a longer list would help (as many terms as now, not more than the length), and what the next `ahead` ranks hold."""
    k = F.explode(F.array(*[F.lit(s) for s in sizes])).alias("k")
    per = keywords.groupBy(key).agg(F.count("*").alias("n")).select("n", k)
    counts = per.groupBy("k").agg(F.count("*").alias("documents"), (F.sum((F.col("n") >= now).cast("long")) - F.sum((F.col("n") > F.col("k")).cast("long"))).alias("helped"))
    beyond = keywords.select("rank", "score", k).filter((F.col("rank") > F.col("k")) & (F.col("rank") <= F.col("k") + ahead)).groupBy("k").agg(F.count("*").alias("more"), F.avg("score").alias("mean"))
    out = counts.join(F.broadcast(beyond), "k", "left").fillna({"more": 0, "mean": 0.0})  # a row a list length
    return out.withColumn("advice", F.when(F.col("mean") > 3, "recommended").when(F.col("mean") > 2, "marginal").otherwise("not recommended"))


def tail_ranks(keywords: DataFrame, first: int = 35, last: int = 60, width: int = 5) -> DataFrame:
    """(from_rank, n, mean, median, fine) of groups of ranks in list tails; the first group holds one more. fine: the share without adverts or repeats."""
    start = F.when(F.col("rank") <= first + width, first).otherwise(first + 1 + width * F.floor((F.col("rank") - first - 1) / width)).cast("int")
    advert = F.lower("term").rlike("|".join(TAIL_ADVERTS))
    w = F.split("term", " ")
    flawed = advert | (F.size(F.array_distinct(w)) < F.size(w))
    rows = keywords.filter(F.col("rank").between(first, last)).withColumn("from_rank", start)
    out = rows.groupBy("from_rank").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), _rate(~flawed).alias("fine"))
    medians = quality.quantile_linear(rows, "score", 0.5, by=("from_rank",)).withColumnRenamed("p50", "median")
    return out.join(F.broadcast(medians), "from_rank", "left")  # a row a group of ranks


def source_issues(keywords: DataFrame, top: int = 20) -> DataFrame:
    """Per source among the best terms: their number, mean score and the share with repeats or a mechanical look."""
    bad = quality.repeats(F.col("term")) | quality.mechanical(F.col("term"))
    return keywords.filter(F.col("rank") <= top).groupBy("source").agg(F.count("*").alias("n"), F.avg("score").alias("mean"), _rate(bad).alias("issues"))


def good_examples(keywords: DataFrame, key: str, top: int = 10, score: float = 15.0) -> DataFrame:
    """Well-scored terms of two to four words without an issue whose words hold together."""
    n = F.size(F.split("term", " "))
    coherent = F.arrays_overlap(quality.words(F.lower("term")), F.array(*[F.lit(c) for c in quality.CONNECTORS])) | (quality.coherence(F.col("term")) >= 0.5)
    return keywords.filter((F.col("rank") <= top) & (F.col("score") > score) & n.between(2, 4) & ~quality.quality_issue(F.col("term")) & coherent).select(key, "term", "score", "source")


def first_issue(term: Column, mechanical: list[str], adverts: list[str]) -> Column:
    """The first kind of issue that a term has, null without; each counts once."""
    low = F.lower(term)
    holds = lambda ws: low.rlike("|".join(ws)) if ws else F.lit(False)
    return F.when(quality.repeats(term), "repeat").when(holds(mechanical), "mechanical").when(holds(adverts), "advert").when(low.rlike(r"https?://|\.com|[0-9a-f]{8}"), "technical")


# --- leaks -------------------------------------------------------------------------------------------------------------------


def leaks(keywords: DataFrame, phrases: list[str], extra: list[str]) -> DataFrame:
    """(category, leak, term, source, score): terms that hold a low-value word, a phrase of the stoplist (terms of two words or more) or an extra stopword.

    The lists are short and fixed, so they are literals and each term is looked at once, without a join.
    """
    low, words = F.lower("term"), F.split(F.lower("term"), " ")
    found = [F.when(low.contains(w), F.struct(F.lit(c).alias("category"), F.lit(w).alias("leak"))) for c, ws in LOW_VALUE.items() for w in ws]
    found += [F.when((F.size(words) >= 2) & low.contains(p), F.struct(F.lit("phrase_stoplist").alias("category"), F.lit(p).alias("leak"))) for p in phrases]
    if extra:
        hit = F.array_join(F.array_sort(F.array_intersect(words, F.array(*[F.lit(w) for w in extra]))), " ")
        found.append(F.when(hit != "", F.struct(F.lit("extra_stopwords").alias("category"), hit.alias("leak"))))
    return keywords.select("term", "source", "score", F.explode(F.array_compact(F.array(*found))).alias("l")).select("l.category", "l.leak", "term", "source", "score")


def leak_rates(leaked: DataFrame, keywords: DataFrame) -> DataFrame:
    """Per category: leaks, their share of all keywords, and the best score among them."""
    n = keywords.agg(F.count("*").alias("all"))
    per = leaked.groupBy("category").agg(F.count("*").alias("n"), F.max("score").alias("best"))
    return per.crossJoin(F.broadcast(n)).select("category", "n", (F.col("n") / F.col("all")).alias("rate"), "best")  # one row


def leak_grade(leaked: DataFrame, keywords: DataFrame) -> DataFrame:
    """All leaks of words (those of phrases aside), their share of all keywords, and the grade of that share."""
    n = leaked.agg(F.coalesce(F.sum((F.col("category") != "phrase_stoplist").cast("long")), F.lit(0)).alias("leaks")).crossJoin(keywords.agg(F.count("*").alias("n")))  # one row each
    out = n.withColumn("rate", F.coalesce(F.try_divide("leaks", "n"), F.lit(0.0)))
    r = F.col("rate")
    return out.withColumn("grade", F.when(r < 0.001, "A+").when(r < 0.005, "A").when(r < 0.01, "B+").when(r < 0.02, "B").otherwise("C"))


# --- rows by key -------------------------------------------------------------------------------------------------------------


def with_page(keywords: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Keyword rows with what their community's page row says; those without one stay."""
    return keywords.join(pages, key, "left")


def frontpage_of(communities: DataFrame, front: DataFrame, key: str) -> DataFrame:
    """(key, front_key): the front page of each of communities(key, name, url) that has one among front(key), by its canonical key, else by its name's folder."""
    canonical = text.community_key(F.col("name"), F.col("url"))
    folder = F.lower(text.crawl_name(F.coalesce("name", F.lit(""))))
    ways = F.array(F.struct(F.lit(0).alias("way"), F.when(canonical != "", canonical).otherwise(text.canonical_key(F.col("name"))).alias("front_key")), F.struct(F.lit(1).alias("way"), folder.alias("front_key")))
    asked = communities.select(F.col(key).alias("_c"), F.explode(ways).alias("w")).select("_c", "w.way", "w.front_key").filter("front_key <> ''")
    found = asked.join(front.select(F.lower("key").alias("front_key")).distinct(), "front_key")
    return found.groupBy("_c").agg(F.min_by("front_key", "way").alias("front_key")).withColumnRenamed("_c", key)


def requiring(communities: DataFrame, front: DataFrame, key: str = "key") -> DataFrame:
    """Communities that have a front page, by canonical key."""
    return communities.join(front.select(key), key, "left_semi")


def missing_from(wanted: DataFrame, cached: DataFrame, key: str = "key") -> DataFrame:
    """Keys that are wanted and not cached."""
    return wanted.select(key).distinct().join(cached.select(key), key, "left_anti")


def available(ranked: DataFrame, there: DataFrame, key: str = "name") -> DataFrame:
    """Ranked rows of which something is there, in rank order."""
    return ranked.join(there.select(key), key, "left_semi").orderBy("rank", key)


def top_posts(posts: DataFrame, key: str, k: int) -> DataFrame:
    """Each community's k best posts by score, then comments; ties by post."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), F.desc("comments"), "post")
    return posts.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k)


def source_posts(phrases: DataFrame, posts: DataFrame, key: str, share: float = 0.6, most: int = 2, any_word: bool = False) -> DataFrame:
    """(key, term, post, overlap): of each phrase's community the posts whose text holds most of its distinct words, the best `most`; ties by post.

    any_word: a phrase without such a post gets those that hold any word of it.
    """
    words = F.array_distinct(F.split(F.lower("term"), " "))
    p = phrases.select(key, "term", words.alias("w"))
    j = p.join(posts.select(key, "post", F.lower("text").alias("text")), key)
    hit = F.size(F.filter("w", lambda x: F.col("text").contains(x))) / F.size("w")
    order = Window.partitionBy(key, "term").orderBy(F.desc("overlap"), "post")
    # the best of a phrase come first, so whether any reaches the share shows in what is kept
    j = j.select(key, "term", "post", hit.alias("overlap")).filter(F.col("overlap") > 0 if any_word else F.col("overlap") >= share)
    j = j.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= most).drop("_r")
    if any_word:
        best = F.max("overlap").over(Window.partitionBy(key, "term"))
        j = j.withColumn("_b", best).filter((F.col("overlap") >= share) | (F.col("_b") < share)).drop("_b")
    return j


def comment_tree(comments: DataFrame) -> DataFrame:
    """Comments(post, comment, parent) with how many answers each has, and whether its parent is among them."""
    answers = comments.filter("parent is not null").groupBy("post", F.col("parent").alias("comment")).agg(F.count("*").alias("answers"))
    there = comments.select("post", F.col("comment").alias("parent"), F.lit(True).alias("known")).distinct()
    out = comments.join(answers, ["post", "comment"], "left").join(there, ["post", "parent"], "left")
    return out.select("post", "comment", "parent", F.coalesce("answers", F.lit(0)).alias("answers"), F.coalesce("known", F.lit(False)).alias("parent_known"))


def best_dataset(sets: DataFrame) -> DataFrame:
    """Of data sets(name, max_page, complete) the one that got furthest; of equals the complete one, then by name."""
    return sets.orderBy(F.desc("max_page"), F.desc("complete"), "name").limit(1)


def failed_targets(reports: DataFrame) -> DataFrame:
    """The distinct targets in the lists `failed` of worker reports, sorted."""
    return reports.select(F.explode("failed").alias("name")).filter("name is not null and name <> ''").distinct().orderBy("name")


def category_improvement(pairs: DataFrame) -> DataFrame:
    """pairs(category, before, after) to the share of rows that got better, by category, and its tier."""
    out = pairs.groupBy("category").agg(F.count("*").alias("n"), _rate(F.col("after") > F.col("before")).alias("rate"))
    return out.withColumn("tier", F.when(F.col("rate") > 0.6, "high").when(F.col("rate") >= 0.3, "medium").otherwise("low"))
