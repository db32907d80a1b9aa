"""The keyword core: terms of documents, their frequencies, scores, and what is kept of them.

All are DataFrame plans over long tables (doc, term, ...). The document frequencies are as large as the vocabulary, so they are
joined by shuffle and broadcast only where Spark's own size check allows it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import KeywordConfig
from ..functions import scores, text
from . import bloom


def together(docs: DataFrame, key: str, parts: int = 0) -> DataFrame:
    """The rows dealt out by key, before their texts become many terms: what is counted by key and term afterwards needs no shuffle of the terms.

    To `parts` partitions, or as many as shuffles have: few bytes of text become many of terms, so they are not to be put together by their size.
    """
    return docs.repartition(parts or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(key))


def once(tf: DataFrame, key: str) -> DataFrame:
    """tf dealt out by document and term: where several parts of a plan read it, they read this one shuffle, and texts become terms once."""
    return tf.repartition(int(tf.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.col(key), F.col("term"))


def words_of(docs: DataFrame, key: str, words: Column, parts: int = 0) -> DataFrame:
    """(key, _words) of the token arrays `words`, dealt out by key. They are a column of their own before n-grams look at them, once for each place."""
    return together(docs, key, parts).select(key, words.alias("_words"))


def grams(words: DataFrame, key: str, max_n: int, only: int = 0) -> DataFrame:
    """(key, gram, n, pos) of every n-gram in words_of, or of those of `only` that many words."""
    found = text.ngrams(F.col("_words"), only) if only else text.all_ngrams(F.col("_words"), max_n)
    return words.select(key, F.explode(found).alias("g")).select(key, "g.gram", "g.n", "g.pos")


def term_frequency(g: DataFrame, key: str) -> DataFrame:
    """(key, term, n, tf, pos): how often each term occurs and where first."""
    return g.groupBy(key, F.col("gram").alias("term"), "n").agg(F.count("*").alias("tf"), F.min("pos").alias("pos"))


def document_frequency(tf: DataFrame, key: str) -> DataFrame:
    """(term, df) of a table with one row per document and term."""
    return tf.groupBy("term").agg(F.count("*").alias("df"))


def common_words(df: DataFrame, n_docs: int, ratio: float = 0.10, share: float = 0.05) -> DataFrame:
    """Unigrams in so many documents that they say nothing; none in corpora of under five."""
    least = max(2, round(share * n_docs))
    return df.filter((~F.col("term").contains(" ")) & F.lit(n_docs >= 5) & (F.col("df") >= least) & (F.col("df") / F.lit(n_docs) >= ratio)).select("term")


def most_frequent(df: DataFrame, common: int) -> tuple[DataFrame, int]:
    """The terms of the largest frequencies, `common` of them at most and all or none of one frequency, and the largest frequency of the others (1 without any)."""
    # a row a frequency
    upto = df.groupBy("df").agg(F.count("*").alias("c")).withColumn("upto", F.sum("c").over(Window.orderBy(F.desc("df"))))
    most = upto.agg(F.coalesce(F.max(F.when(F.col("upto") > common, F.col("df"))), F.lit(0))).first()[0]
    return df.filter(F.col("df") > most), max(most, 1)


def tfidf(tf: DataFrame, df: DataFrame, n_docs: int | DataFrame, cfg: KeywordConfig, posts: bool = False, weight: str = "tf") -> DataFrame:
    """tf with df, kept and score: what pruning leaves and its damped TF-IDF; pruned rows stay, marked, for ensure_phrases."""
    ratio, phrase_ratio = (cfg.posts_generic_ratio, cfg.posts_generic_phrase_ratio) if posts else (cfg.desc_generic_ratio, cfg.desc_generic_phrase_ratio)
    power, boosts = (cfg.posts_idf_power, cfg.posts_boosts) if posts else (cfg.desc_idf_power, cfg.desc_boosts)
    # the number of documents: known, or a frame of one row
    counted = lambda x: x.crossJoin(F.broadcast(n_docs.select(F.col(n_docs.columns[0]).alias("_docs")))) if isinstance(n_docs, DataFrame) else x.withColumn("_docs", F.lit(n_docs))
    weighed = counted(df.select("term", "df")).withColumn("_idf", scores.damped_idf(F.col("df"), F.col("_docs"), power)).drop("_docs")
    j = counted(tf.join(weighed, "term", "left").withColumn("df", F.coalesce("df", F.lit(0))))
    share = F.col("df") / F.greatest(F.col("_docs"), F.lit(1))
    kept = ~((F.col("n") == 2) & (F.col("df") < cfg.min_df_bigram)) & ~((F.col("n") == 3) & (F.col("df") < cfg.min_df_trigram))
    generic = F.lit(False)
    if ratio is not None:
        kept = kept & ~((F.col("n") == 1) & (share >= ratio))
    if phrase_ratio is not None:
        generic = (F.col("n") >= 2) & (share >= phrase_ratio)
        kept = kept & ~generic
    score = F.col(weight) * F.coalesce("_idf", scores.damped(scores.idf(F.col("df"), F.col("_docs")), power)) * scores.phrase_boost(F.col("n"), boosts)
    return j.withColumn("kept", kept).withColumn("generic", generic).withColumn("score", F.when(kept, score)).drop("_docs", "_idf")


def candidates(tf: DataFrame, often: DataFrame, most: int, n_docs: int, cfg: KeywordConfig, key: str, k: int, phrases: tuple[DataFrame, int] | None = None) -> DataFrame:
    """The rows of tf(key, term, n, tf, pos) that can be among the k best of their document after tfidf and ensure_phrases, for descriptions.

    often(term, df): some frequencies, broadcast; any other term is in 1 to `most` documents, a phrase that isn't in `phrases` (a Bloom
    filter and its bits) in too few to be kept. A document's floor is the k-th largest of the
    least scores of terms that are kept for sure; a term stays if its largest possible score, or that of a pruned phrase, reaches it. The floor is
    kept as `floor`, for `reaching`.
    """
    ratio, n, count = cfg.desc_generic_ratio, F.col("n"), F.lit(n_docs)
    weight = lambda d: F.col("tf") * scores.damped(scores.idf(d, count), cfg.desc_idf_power) * scores.phrase_boost(n, cfg.desc_boosts)
    j = tf.join(F.broadcast(often.select("term", F.col("df").alias("_df"))), "term", "left")
    least = F.when(n == 2, cfg.min_df_bigram).when(n == 3, cfg.min_df_trigram).otherwise(1)
    sure = F.coalesce(F.col("_df") >= least, n == 1)
    top = F.coalesce("_df", F.lit(most))
    if ratio is not None:
        sure = sure & ~((n == 1) & (top / F.greatest(count, F.lit(1)) >= ratio))
    if cfg.desc_generic_phrase_ratio is not None:
        sure = sure & ~((n >= 2) & (top / F.greatest(count, F.lit(1)) >= cfg.desc_generic_phrase_ratio))
    # a little apart from the bounds, since the last bits of the final scores are others
    low = F.when(sure, weight(top) * (1 - 1e-9))
    high = weight(F.coalesce("_df", F.greatest(least, F.lit(1)))) * (1 + 1e-9)
    if phrases is not None:
        j = bloom.marked(j, "term", *phrases, "_may")
        high = F.when((n == 1) | F.col("_df").isNotNull() | F.col("_may"), high)
    spare = F.when(n >= 2, F.col("tf") * max(1.0, *cfg.desc_boosts))
    j = j.withColumn("_low", low).withColumn("_high", F.greatest(high, spare))
    own = Window.partitionBy(key)
    j = j.withColumn("_at", F.row_number().over(own.orderBy(F.desc_nulls_last("_low")))).withColumn("_floor", F.max(F.when(F.col("_at") == k, F.col("_low"))).over(own))
    return j.filter(F.col("_floor").isNull() | (F.col("_high") >= F.col("_floor"))).select(key, "term", "n", "tf", "pos", F.col("_floor").alias("floor"))


def reaching(scored: DataFrame, cfg: KeywordConfig) -> DataFrame:
    """What tfidf makes of `candidates`, without the terms that by their score, now known, can't be among the best; `floor` goes.

    Pruned phrases go by their frequency alone, whatever their length: those that stay keep their order among the most frequent.
    """
    spare = ~F.col("kept") & (F.col("n") >= 2) & ~F.col("generic")
    most = F.when(F.col("kept"), F.col("score")).when(spare, F.col("tf") * max(1.0, *cfg.desc_boosts))
    return scored.filter(most.isNotNull() & (F.col("floor").isNull() | (most >= F.col("floor")))).drop("floor")


def ensure_phrases(scored: DataFrame, key: str, cfg: KeywordConfig, posts: bool = False) -> DataFrame:
    """Kept terms, and of each document's pruned phrases the k most frequent, scored by frequency."""
    boosts = cfg.posts_boosts if posts else cfg.desc_boosts
    spare = (~F.col("kept")) & (F.col("n") >= 2) & (~F.col("generic"))
    # by document alone: the ranking that follows needs no second shuffle
    order = Window.partitionBy(key).orderBy(F.desc("spare"), F.desc("tf"), F.asc("n"), F.asc("pos"), F.asc("term"))
    r = scored.withColumn("spare", spare).withColumn("place", F.row_number().over(order))
    r = r.filter(F.col("kept") | (F.col("spare") & (F.col("place") <= cfg.ensure_k)))
    return r.withColumn("score", F.coalesce("score", F.col("tf") * scores.phrase_boost(F.col("n"), boosts))).drop("spare", "place", "kept", "generic")


def top_k(scored: DataFrame, key: str, k: int, *ties: str) -> DataFrame:
    """The k best terms of each document with their rank; ties by the columns given, then the term."""
    order = Window.partitionBy(key).orderBy(F.desc("score"), *[F.asc(t) for t in (*ties, "term")])
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def top_k_with(scored: DataFrame, key: str, k: int, phrases: DataFrame) -> DataFrame:
    """top_k, with each document's phrase (key, phrase) among them: it takes the last place if it isn't there by itself."""
    marked = scored.join(phrases, key, "left").withColumn("own", F.coalesce(F.col("term") == F.col("phrase"), F.lit(False)))
    order = Window.partitionBy(key).orderBy(F.desc("score"), "term")
    placed = marked.withColumn("at", F.row_number().over(order)).withColumn("own_at", F.max(F.when(F.col("own"), F.col("at"))).over(Window.partitionBy(key)))
    pushed = F.coalesce(F.col("own_at") > k, F.lit(False))
    kept = placed.filter(F.col("own") | (F.col("at") <= F.when(pushed, k - 1).otherwise(k)))
    return kept.withColumn("rank", F.row_number().over(order)).drop("own", "own_at", "at", "phrase")


def name_scores(names: DataFrame, phrases: DataFrame, key: str) -> DataFrame:
    """(key, term, score): 1, 1.5 or 2.5 for a term of names(key, term) by its words, and as much once more for the whole name, phrases(key, phrase), stopwords
    and all, a name of one word too."""
    n = text.word_count(F.col("term"))
    every = names.select(key, "term").distinct().unionByName(phrases.filter("phrase <> ''").select(key, F.col("phrase").alias("term")).distinct())
    return every.groupBy(key, "term").agg(F.sum(F.when(n >= 3, 2.5).when(n == 2, 1.5).otherwise(1.0)).alias("score"))


def merge_sources(sources: dict[str, tuple[DataFrame, float]], key: str) -> DataFrame:
    """(key, term, score, source): weighted sums over sources, and the sources joined by +; a weight of 0 or less leaves one out."""
    parts = [d.select(key, "term", (F.col("score") * w).alias("score"), F.lit(name).alias("source")) for name, (d, w) in sources.items() if w > 0]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    return every.groupBy(key, "term").agg(F.sum("score").alias("score"), F.array_join(F.array_sort(F.collect_set("source")), "+").alias("source"))


def normalise(scored: DataFrame, key: str) -> DataFrame:
    """weight: each score's share of its document's sum; a sum of 0 counts as 1."""
    total = F.sum("score").over(Window.partitionBy(key))
    return scored.withColumn("weight", F.col("score") / F.when(total == 0, 1.0).otherwise(total))


def dedupe(scored: DataFrame, key: str) -> DataFrame:
    """Of terms that are alike but for case, spaces and punctuation the best; terms without ASCII letters or digits go."""
    d = scored.withColumn("dkey", text.dedupe_key(F.col("term"))).filter(F.col("dkey") != "")
    order = Window.partitionBy(key, "dkey").orderBy(F.desc("score"), text.source_rank(F.col("source")), F.asc("term"), F.asc("source"))
    return d.withColumn("_r", F.row_number().over(order)).filter("_r = 1").drop("_r")


def core_and_extended(core: DataFrame, extended: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Two lists without a term in common: what the core has is left out of the extended one."""
    mine = core.select(key, text.dedupe_key(F.col("term")).alias("dkey")).distinct()
    return core, extended.withColumn("dkey", text.dedupe_key(F.col("term"))).join(mine, [key, "dkey"], "left_anti").drop("dkey")


def anchored_variants(posts: DataFrame, key: str, cfg: KeywordConfig) -> DataFrame:
    """posts(key, term, n, score, share, anchor, phrase): generic terms of one or two words get a variant with the anchor before them."""
    same = text.dedupe_key(F.col("phrase")) == text.dedupe_key(F.col("anchor"))
    first = F.when((F.coalesce("phrase", F.lit("")) != "") & same & F.lit(not cfg.token_with_phrase), F.col("phrase")).otherwise(F.col("anchor"))
    generic = (F.col("n") <= 2) & (F.col("share") >= cfg.anchor_generic_ratio) & ~F.concat(F.lit(" "), "term", F.lit(" ")).contains(F.concat(F.lit(" "), "anchor", F.lit(" ")))
    base = posts.filter(~generic) if cfg.replace_generic else posts
    new = posts.filter(generic).select(key, F.concat_ws(" ", first, "term").alias("term"), (F.col("score") * cfg.anchor_multiplier).alias("score"))
    new = new.join(posts.select(key, "term"), [key, "term"], "left_anti").groupBy(key, "term").agg(F.max("score").alias("score"))
    return base.select(key, "term", "score").unionByName(new)


def compose(seeds: DataFrame, key: str, cfg: KeywordConfig) -> DataFrame:
    """seeds(key, term, order_score, base_score, phrase, token, factor) to composed (key, term, score): anchor phrase or token before
    the simplified seed, within limits on words, base score and ratio, and at most so many of each document."""
    best = Window.partitionBy(key).orderBy(F.desc("order_score"), "term")
    s = seeds.withColumn("seed_rank", F.row_number().over(best)).filter(F.col("seed_rank") <= cfg.compose_top_m)
    s = s.withColumn("seed", text.simplify_seed(F.col("term"))).withColumn("n", text.word_count(F.col("seed")))
    spaced = F.concat(F.lit(" "), "seed", F.lit(" "))
    phrase, token = F.coalesce("phrase", F.lit("")), F.coalesce("token", F.lit(""))
    s = s.filter(~text.equal_loose(F.col("seed"), phrase) & ~text.equal_loose(F.col("seed"), token))
    s = s.filter((F.col("n") > 1) | F.lit(cfg.compose_unigrams))
    s = s.filter(~((token != "") & spaced.contains(F.concat(F.lit(" "), token, F.lit(" ")))) & ~((phrase != "") & spaced.startswith(F.concat(F.lit(" "), phrase, F.lit(" ")))))
    s = s.filter(F.col("base_score") >= max(0.0, cfg.compose_min_base))
    score = F.col("base_score") * F.col("factor")
    if cfg.compose_max_ratio > 0:
        score = F.least(score, F.col("base_score") * cfg.compose_max_ratio)
    token_ok = (token != "") & (F.lit(cfg.token_with_phrase) | (phrase == "") | (text.dedupe_key(phrase) != text.dedupe_key(token)))
    with_phrase = F.when((phrase != "") & (text.word_count(phrase) + F.col("n") <= cfg.compose_max_words), F.concat_ws(" ", phrase, "seed"))
    with_token = F.when(token_ok & (1 + F.col("n") <= cfg.compose_max_words), F.concat_ws(" ", token, "seed"))
    v = s.select(key, "seed_rank", score.alias("score"), F.posexplode(F.array(with_phrase, with_token)).alias("variant", "composed")).filter("composed is not null")
    v = v.join(seeds.select(key, F.col("term").alias("composed")), [key, "composed"], "left_anti")
    first = Window.partitionBy(key, "composed").orderBy("seed_rank", "variant")
    v = v.withColumn("_f", F.row_number().over(first)).filter("_f = 1")
    cap = Window.partitionBy(key).orderBy("seed_rank", "variant")
    v = v.withColumn("_c", F.row_number().over(cap))
    return (v.filter(F.col("_c") <= cfg.compose_max_per_doc) if cfg.compose_max_per_doc else v).select(key, F.col("composed").alias("term"), "score")


def theme(scored: DataFrame, key: str, k: int) -> DataFrame:
    """(key, theme, theme_terms): the words of each document's k best terms, and these terms in order."""
    best = top_k(scored, key, k)
    listed = best.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("rank", "term"))).alias("t"))
    terms = F.transform("t", lambda x: x["term"])
    return listed.select(key, F.array_distinct(F.flatten(F.transform(terms, lambda x: F.split(x, " ")))).alias("theme"), terms.alias("theme_terms"))


def theme_penalty(posts: DataFrame, themes: DataFrame, key: str, factor: float) -> DataFrame:
    """Scores of terms without a word of the theme, times the factor; documents without a theme stay as they are."""
    j = posts.join(themes.select(key, "theme"), key, "left")
    off = (F.size("theme") > 0) & ~F.arrays_overlap(F.split("term", " "), "theme")
    return j.withColumn("score", F.when(F.coalesce(off, F.lit(False)), F.col("score") * factor).otherwise(F.col("score"))).drop("theme")


def seed_base(posts: DataFrame, local: DataFrame, key: str, source: str) -> DataFrame:
    """(key, term, order_score, base_score): seeds by TF-IDF, by local frequency, or by TF-IDF where there is one (hybrid); the scale is always TF-IDF, 0 without."""
    scored = posts.select(key, "term", F.col("score").alias("base_score"))
    if source == "posts_tfidf":
        return scored.withColumn("order_score", F.col("base_score"))
    every = scored.join(local.select(key, "term", F.col("tf").cast("double").alias("tf")), [key, "term"], "right" if source == "posts_local_tf" else "full_outer")
    order = F.col("tf") if source == "posts_local_tf" else F.coalesce("base_score", "tf")
    return every.select(key, "term", order.alias("order_score"), F.coalesce("base_score", F.lit(0.0)).alias("base_score"))


def rerank_seeds(seeds: DataFrame, vectors: DataFrame, themes: DataFrame, key: str, alpha: float, pool: int) -> DataFrame:
    """Each document's `pool` best seeds by a blend of their score's share of the best and their similarity to the theme; the rest by the share."""
    order = Window.partitionBy(key).orderBy(F.desc("order_score"), "term")
    best = F.max("order_score").over(Window.partitionBy(key))
    s = seeds.withColumn("_p", F.row_number().over(order)).withColumn("_n", F.col("order_score") / F.when(best == 0, 1.0).otherwise(best))
    s = s.join(vectors, "term", "left").join(themes.select(key, F.col("vector").alias("_theme")), key, "left")
    like = (scores.cosine(F.col("vector"), F.col("_theme")) + 1.0) / 2.0
    on = (F.col("_p") <= pool) & F.col("vector").isNotNull() & F.col("_theme").isNotNull()
    return s.withColumn("order_score", F.when(on, (1.0 - alpha) * F.col("_n") + alpha * like).otherwise(F.col("_n"))).drop("_p", "_n", "vector", "_theme")


def rerank(scored: DataFrame, vectors: DataFrame, themes: DataFrame, key: str, cfg: KeywordConfig, pool: str = "union") -> DataFrame:
    """The best terms of a pool, times (1 - alpha) + alpha * similarity to the theme; vectors(term, vector), themes(key, vector)."""
    inside = scored.withColumn("_in", text.in_embed_pool(F.col("source"), pool))
    order = Window.partitionBy(key, "_in").orderBy(F.desc("score"), "term")
    r = inside.withColumn("_p", F.row_number().over(order)).join(vectors, "term", "left").join(themes.select(key, F.col("vector").alias("_theme")), key, "left")
    like = (scores.cosine(F.col("vector"), F.col("_theme")) + 1.0) / 2.0
    on = F.col("_in") & (F.col("_p") <= cfg.embed_k) & F.col("vector").isNotNull() & F.col("_theme").isNotNull()
    return r.withColumn("score", F.when(on, F.col("score") * ((1.0 - cfg.embed_alpha) + cfg.embed_alpha * like)).otherwise(F.col("score"))).drop("_in", "_p", "vector", "_theme")
