"""Keyword plans end to end: descriptions, posts and names of communities to ranked, cleaned keyword lists."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import KeywordConfig
from ..functions import scores, text
from ..operators import bloom, segment, terms
from ..sources.storage import Store, dealt, released


#: Of description_top: terms whose frequencies every task holds; bytes of text that become terms in one task; steps in which the phrases of one length are
#: counted, and in which what is written meets the frequencies and is ranked.
COMMON, TASK, STEPS, SLICES = 1 << 17, 4 << 20, 2, 6


def _slice(column: str, of: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(of))


def description_words(docs: DataFrame, key: str, cfg: KeywordConfig, extra: list[str] | None = None, parts: int = 0) -> DataFrame:
    """(key, _words) of docs(key, text), dealt out by key: the words of the sentences, with a null for each stopword and after each sentence."""
    words = text.stop_filtered(text.bounded(text.sentences(F.col("text"))), [*cfg.stopwords, *cfg.frequent_words, *(extra or [])], cfg.min_token_len)
    return terms.words_of(docs.select(key, "text"), key, words, parts)


def description_terms(docs: DataFrame, key: str, cfg: KeywordConfig, extra: list[str] | None = None, parts: int = 0, words: DataFrame | None = None) -> DataFrame:
    """(key, term, n, tf, pos) of docs(key, text): n-grams within sentences, none across a stopword. words: what description_words gives, if it is there already."""
    return terms.term_frequency(terms.grams(description_words(docs, key, cfg, extra, parts) if words is None else words, key, cfg.max_ngram), key)


def description_frequencies(docs: DataFrame, key: str, cfg: KeywordConfig, path: str, parts: int = 0, steps: int = STEPS, words: DataFrame | None = None) -> DataFrame:
    """document_frequency of description_terms, written to a new path and read from there: phrases are counted by their length and in `steps` by
    their hash, one after the other, so the disk holds the shuffle files of one step. Phrases in too few documents to be kept in any case are left out:
    a phrase is in no more documents than the phrases that it holds, so of three words and more only those are counted whose first and last words,
    but one, are a phrase that a Bloom filter of those left knows. words: as in description_terms."""
    spark, least = docs.sparkSession, min(cfg.min_df_bigram, cfg.min_df_trigram) if cfg.desc_generic_phrase_ratio is None else 1
    words = description_words(docs, key, cfg, parts=parts) if words is None else words
    for n in range(1, cfg.max_ngram + 1):
        grams, often = terms.grams(words, key, cfg.max_ngram, n), least > 1 and n > 2
        if often:
            shorter = spark.read.parquet(path).filter(text.word_count(F.col("term")) == n - 1)
            bits = bloom.bits_for(shorter.count())
            known = bloom.of(shorter, "term", bits)
            for end in (n - 1, 1 - n):
                grams = bloom.marked(grams.withColumn("_end", F.substring_index("gram", " ", end)), "_end", known, bits, "_may").filter("_may").drop("_end", "_may")
        for step in range(steps if n == 2 or n > 2 and not often else 1):
            mine = grams.filter(_slice("gram", steps) == step) if n == 2 or n > 2 and not often else grams
            found = terms.document_frequency(terms.term_frequency(mine, key), key)
            (found.filter(F.col("df") >= least) if n > 1 else found).write.option("compression", "zstd").mode("append").parquet(path)
    return spark.read.parquet(path)


def description_scores(docs: DataFrame, key: str, cfg: KeywordConfig, dynamic: bool = False) -> DataFrame:
    """(key, term, n, tf, pos, df, score) of descriptions, phrases ensured. All documents count, also those without terms.

    dynamic: words that most documents share end an n-gram as stopwords do (the frequencies are those of all terms). At most as many words
    as ten mean documents hold can be in a tenth of all documents, so their list is small.
    """
    tf, n = description_terms(docs, key, cfg), docs.count()
    df = terms.document_frequency(tf, key)
    if dynamic and cfg.desc_generic_ratio is not None:
        common = [r.term for r in terms.common_words(df, n, cfg.desc_generic_ratio).collect()]
        tf = description_terms(docs, key, cfg, sorted(common)) if common else tf
    return terms.ensure_phrases(terms.tfidf(tf, df, n, cfg), key, cfg)


def description_top(docs: DataFrame, key: str, cfg: KeywordConfig, k: int, folder: str, common: int = COMMON) -> DataFrame:
    """(key, rank, term, n, tf, pos, score): the k best of description_scores, with few terms moved, read from `folder`.

    The `common` most frequent terms go to every task; other terms are in at most as many documents as the last of these, which bounds their
    scores; a Bloom filter knows nearly all phrases that are in too few documents to be kept. Where a document's terms are, those that can't be among its k best by these bounds are left out, and so are phrases that can't be
    by their frequency in the document; only the others meet the whole table of frequencies, and of these only what still can be is ranked.

    Frequencies, the terms that can be among the best, scores and the ranked terms are written one after the other, in slices by term or document that are
    worked on in turn, and what led to each goes before the next; texts become words once, written in buckets by document, so no step shuffles texts: the disk holds one slice's shuffle files at a time, and a plan that reads the result in several places doesn't make it again. Tasks are as many as the bytes of text
    ask for, so that none has to sort more terms than its memory holds.
    """
    spark, store = docs.sparkSession, Store(docs.sparkSession, folder)
    n, size = docs.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK))
    packed = lambda d: d.write.option("compression", "zstd").mode("append")
    cut = lambda d, by, name: packed(d.withColumn("slice", _slice(by, SLICES))).partitionBy("slice").parquet(store.at(name))
    part = lambda name, i: spark.read.parquet(store.at(f"{name}/slice={i}"))
    with released(spark):
        with dealt(description_words(docs, key, cfg, parts=parts), key, parts, store, "words") as words:
            df = description_frequencies(docs, key, cfg, store.at("df"), parts, words=words)
            often, most = terms.most_frequent(df, common)
            kept = df.filter(F.col("term").contains(" ") & (F.col("df") >= min(cfg.min_df_bigram, cfg.min_df_trigram)))
            bits = bloom.bits_for(kept.count())
            some = terms.candidates(description_terms(docs, key, cfg, words=words), often, most, n, cfg, key, k, (bloom.of(kept, "term", bits), bits))
            cut(some, "term", "some")
        for i in (i for i in range(SLICES) if store.exists(f"some/slice={i}")):
            mine, known = part("some", i), df.filter(_slice("term", SLICES) == i)
            scored = terms.tfidf(mine.repartition(parts, "term"), known.repartition(parts, "term"), n, cfg)
            cut(terms.reaching(scored, cfg), key, "scored")
            store.delete(f"some/slice={i}")
        store.delete("df")
        # without terms there is no slice
        none = {"term": "string", "n": "int", "tf": "bigint", "pos": "int", "df": "bigint", "score": "double", "rank": "int"}
        packed(docs.limit(0).select(key, *[F.lit(None).cast(t).alias(c) for c, t in none.items()])).parquet(store.at("top"))
        for i in (i for i in range(SLICES) if store.exists(f"scored/slice={i}")):
            mine = part("scored", i).repartition(parts, key)
            packed(terms.top_k(terms.ensure_phrases(mine, key, cfg), key, k)).parquet(store.at("top"))
            store.delete(f"scored/slice={i}")
        store.delete("some")
        store.delete("scored")
    return spark.read.parquet(store.at("top"))


def _written(rows: DataFrame, path: str) -> DataFrame:
    rows.write.option("compression", "zstd").parquet(path)
    return rows.sparkSession.read.parquet(path)


def usable_posts(posts: DataFrame, cfg: KeywordConfig) -> DataFrame:
    """Posts that the gates let through: not promoted, and, where asked for, in Latin script and mostly ASCII, their preview too where there is one."""
    out = posts.filter(~F.coalesce("is_promoted", F.lit(False))) if cfg.skip_promoted else posts
    every = F.trim(F.concat_ws(" ", "text", "preview")) if "preview" in posts.columns else F.col("text")
    if cfg.drop_nonlatin_posts:
        out = out.filter(~text.has_script(every))
    if cfg.max_nonascii_ratio >= 0:
        out = out.filter(text.nonascii_ratio(every) <= cfg.max_nonascii_ratio)
    return out


def posts_terms(posts: DataFrame, key: str, cfg: KeywordConfig) -> DataFrame:
    """(key, term, n, tf, weighted, pos) of posts(key, post, text, score, comments, age_days, is_promoted[, preview])."""
    read = F.concat_ws(" ", "text", "preview") if cfg.include_preview and "preview" in posts.columns else F.col("text")
    words = text.stop_filtered(text.tokens(read), [*cfg.stopwords, *cfg.frequent_words, *cfg.posts_stopwords], cfg.min_token_len)
    weight = scores.post_weight(F.col("age_days"), F.col("score"), F.col("comments"), cfg.halflife_days, cfg.engagement_alpha)
    p = terms.together(usable_posts(posts, cfg), key).select(key, "post", weight.alias("w"), words.alias("_words"))
    p = p.select(key, "post", "w", F.explode(text.all_ngrams(F.col("_words"), cfg.max_ngram)).alias("g"))
    if cfg.posts_phrases:
        p = p.filter(~F.col("g.gram").isin(list(cfg.posts_phrases)))
    one = p.groupBy(key, "post", "w", F.col("g.gram").alias("term"), F.col("g.n").alias("n")).agg(F.count("*").alias("c"), F.min("g.pos").alias("pos"))
    return one.groupBy(key, "term", "n").agg(F.sum("c").alias("tf"), F.sum(F.col("c") * F.col("w")).alias("weighted"), F.min("pos").alias("pos"))


def posts_scores(posts: DataFrame, key: str, cfg: KeywordConfig, tf: DataFrame | None = None) -> DataFrame:
    """(key, term, n, tf, weighted, pos, df, score); only communities with a term count as documents. tf: what posts_terms gives, if it is there already."""
    tf = posts_terms(posts, key, cfg) if tf is None else tf
    return terms.ensure_phrases(terms.tfidf(tf, terms.document_frequency(tf, key), posts_documents(tf, key), cfg, posts=True, weight="weighted"), key, cfg, posts=True)


def posts_documents(tf: DataFrame, key: str) -> DataFrame:
    """One row: the communities with a term."""
    return tf.agg(F.countDistinct(key).alias("n"))


def name_parts(names: DataFrame, key: str, counts: DataFrame | None = None, by_look: bool = True) -> DataFrame:
    """(key, parts) of names(key, name): a name's words in its own case, long lower-case ones cut further (by counts(word, n) where given).

    Glued words are cut once each, however many names hold them; by_look: as in `segment.segmented`.
    """
    rough = F.filter(F.split(F.regexp_replace(text.display_key(F.col("name")), r"[_\-.\s]+", " "), " "), lambda t: t != "")
    parts = names.select(key, F.posexplode(F.flatten(F.transform(rough, text.camel_split))).alias("pos", "word"))
    glued = F.col("word").rlike(f"^[a-z]{{{segment.SHORTEST},}}$")
    cut = segment.segmented(parts.filter(glued).select("word"), counts, by_look=by_look)
    whole = parts.join(cut, "word", "left").select(key, "pos", F.coalesce("parts", F.array("word")).alias("parts"))
    return whole.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("pos", "parts"))).alias("p")).select(key, F.flatten(F.transform("p", lambda x: x["parts"])).alias("parts"))


def name_terms(names: DataFrame, key: str, cfg: KeywordConfig, counts: DataFrame | None = None, by_look: bool = True) -> DataFrame:
    """(key, term, pos) of names(key, name): the phrase without stopwords, words, pairs, and what acronyms stand for, once each."""
    cut = name_parts(names, key, counts, by_look).select(key, F.transform("parts", F.lower).alias("parts"))
    kept = F.filter(text.stop_filtered(F.col("parts"), cfg.stopwords, cfg.min_token_len), lambda t: t.isNotNull())
    c = cut.select(key, kept.alias("kept"), F.array_compact(F.transform("parts", text.expand)).alias("more"))
    pairs = F.when(F.size("kept") >= 2, F.zip_with(F.slice("kept", F.lit(1), F.greatest(F.size("kept") - 1, F.lit(0))), F.slice("kept", F.lit(2), F.greatest(F.size("kept") - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))).otherwise(F.array().cast("array<string>"))
    every = F.array_distinct(F.filter(F.concat(F.array(F.array_join("kept", " ")), "kept", pairs, "more"), lambda t: t != ""))
    return c.select(key, F.posexplode(every).alias("pos", "term")).select(key, "term", "pos")


def name_phrases(names: DataFrame, key: str, counts: DataFrame | None = None, by_look: bool = True) -> DataFrame:
    """(key, phrase, shown): all words of a name, stopwords too, in lower case and for display."""
    cut = name_parts(names, key, counts, by_look)
    return cut.select(key, F.lower(F.array_join("parts", " ")).alias("phrase"), F.array_join(F.transform("parts", text.display_word), " ").alias("shown"))


def anchors(names: DataFrame, key: str, cfg: KeywordConfig, counts: DataFrame | None = None) -> DataFrame:
    """(key, token, phrase, ckey) of names(key, name[, title]): the first longest single word, else the canonical key; the title's words, empty without one; the
    canonical key."""
    t = name_terms(names, key, cfg, counts).filter(~F.col("term").contains(" ")).groupBy(key).agg(F.max_by("term", F.struct(F.length("term").alias("l"), (-F.col("pos")).alias("p"))).alias("token"))
    title = F.col("title") if "title" in names.columns else F.lit("")
    ckey = text.canonical_key(F.col("name"))
    return names.select(key, F.array_join(text.tokens(title), " ").alias("phrase"), ckey.alias("ckey")).join(t, key, "left").select(key, F.coalesce("token", F.nullif("ckey", F.lit(""))).alias("token"), "phrase", "ckey")


def displayed(ranked: DataFrame, names: DataFrame, key: str) -> DataFrame:
    """ranked(key, term, ...) with `shown`: the title in place of the anchor phrase at a term's start, or the name in its own case in place of its key; names(key, name[, title])."""
    title = F.coalesce("title", F.lit("")) if "title" in names.columns else F.lit("")
    forms = names.select(key, text.canonical_key(F.col("name")).alias("_key"), text.display_key(F.col("name")).alias("_shown"), F.array_join(text.tokens(title), " ").alias("_phrase"), F.trim(title).alias("_title"))
    out = ranked.join(forms, key, "left").withColumn("shown", text.recased(F.col("term"), F.col("_key"), F.col("_shown"), F.col("_phrase"), F.col("_title")))
    return out.drop("_key", "_shown", "_phrase", "_title")


def composed_scores(seeds: DataFrame, anchor: DataFrame, n_docs: DataFrame, df: DataFrame, key: str, cfg: KeywordConfig) -> DataFrame:
    """Composed (key, term, score) from seeds(key, term, order_score, base_score) and anchors(key, phrase, ckey); n_docs has one row."""
    a = anchor.select(key, "phrase", F.col("ckey").alias("token"))
    a = a.join(df.select(F.col("term").alias("phrase"), F.col("df").alias("phrase_df")), "phrase", "left").join(df.select(F.col("term").alias("token"), F.col("df").alias("token_df")), "token", "left")
    a = a.crossJoin(F.broadcast(n_docs.select(F.greatest(F.col(n_docs.columns[0]), F.lit(1)).alias("_docs"))))
    of = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.coalesce(f"{c}_df", F.lit(0)))
    factor = scores.anchor_factor(of("phrase"), of("token"), F.col("_docs"), cfg.posts_idf_power, cfg.compose_mode, cfg.compose_alpha, cfg.compose_floor, cfg.compose_cap, cfg.compose_multiplier)
    a = a.select(key, "token", "phrase", factor.alias("factor"))
    return terms.compose(seeds.join(a, key), key, cfg)


def posts_composed(posts: DataFrame, names: DataFrame, key: str, cfg: KeywordConfig, folder: str) -> DataFrame:
    """composed_scores of posts and names, read from `folder`: terms, their frequencies, seeds and the result are written one after the other, and what led to each
    goes before the next, its shuffle files too."""
    spark, store = posts.sparkSession, Store(posts.sparkSession, folder)
    written = lambda rows, name: _written(rows, store.at(name))
    with released(spark):
        tf = written(posts_terms(posts, key, cfg), "terms")
        df, n = written(terms.document_frequency(tf, key), "frequencies"), written(posts_documents(tf, key), "documents")
        scored = terms.tfidf(tf, df, n, cfg, posts=True, weight="weighted")
        scored = written(terms.ensure_phrases(scored, key, cfg, posts=True).select(key, "term", "score"), "scored")
        seeds = written(terms.seed_base(scored, tf, key, cfg.compose_seeds), "seeds")
        for used in ("terms", "scored"):
            store.delete(used)
        out = written(composed_scores(seeds, anchors(names, key, cfg), n, df, key, cfg), "composed")
        for used in ("seeds", "frequencies", "documents"):
            store.delete(used)
    return out


def themes(desc: DataFrame, named: DataFrame, key: str, cfg: KeywordConfig) -> DataFrame:
    """(key, theme): the words of each community's name and of its best description terms."""
    best = terms.theme(desc, key, cfg.theme_k).select(key, "theme")
    own = named.groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list(F.split("term", " ")))).alias("own"))
    none = F.array().cast("array<string>")
    return best.join(own, key, "full_outer").select(key, F.array_union(F.coalesce("own", none), F.coalesce("theme", none)).alias("theme"))


def _finished(merged: DataFrame, phrases: DataFrame, key: str, cfg: KeywordConfig, k: int) -> DataFrame:
    """Merged terms cleaned, weighted over all, the best k of each community, its whole name among them."""
    m = merged.withColumn("term", text.collapse_repeats(F.col("term")))
    if cfg.drop_nonlatin:
        m = m.filter(~text.has_script(F.col("term")))
    if cfg.term_nonascii_ratio >= 0:
        m = m.filter(text.nonascii_ratio(F.col("term")) <= cfg.term_nonascii_ratio)
    weighted = terms.normalise(terms.dedupe(m, key), key)
    top = terms.top_k_with(weighted, key, k, phrases) if cfg.ensure_name else terms.top_k(weighted, key, k)
    return top.select(key, "rank", "term", "score", "weight", "source")


def sources(docs: DataFrame, posts: DataFrame, names: DataFrame, key: str, cfg: KeywordConfig, vectors: DataFrame | None = None, theme_vectors: DataFrame | None = None) -> dict[str, DataFrame]:
    """The scored terms of each source, every option of cfg applied, and `phrases`, the names as phrases.

    vectors(term, vector) and theme_vectors(key, vector) rank seeds by the theme where they are given.
    """
    if cfg.require_posts:
        with_posts = posts.select(key).distinct()
        docs, names = docs.join(with_posts, key, "left_semi"), names.join(with_posts, key, "left_semi")
    desc, tf = description_scores(docs, key, cfg, cfg.dynamic_common), terms.once(posts_terms(posts, key, cfg), key)
    df, n = terms.document_frequency(tf, key), posts_documents(tf, key)
    post = posts_scores(posts, key, cfg, tf).select(key, "term", "n", "df", "score")
    counts = segment.word_counts(docs.select(F.explode(text.tokens(F.col("text"))).alias("word"))) if cfg.segment_by_counts else None
    named, anchor, whole = name_terms(names, key, cfg, counts), anchors(names, key, cfg, counts), name_phrases(names, key, counts)
    if cfg.anchor_generics:
        marked = post.crossJoin(F.broadcast(n.select(F.col("n").alias("_docs")))).withColumn("share", F.col("df") / F.col("_docs")).join(anchor.select(key, F.col("token").alias("anchor"), "phrase"), key, "left")
        post = terms.anchored_variants(marked.withColumn("anchor", F.coalesce("anchor", F.lit(""))), key, cfg)
    seeds = terms.seed_base(post, tf, key, cfg.compose_seeds)
    if vectors is not None and theme_vectors is not None:
        seeds = terms.rerank_seeds(seeds, vectors, theme_vectors, key, cfg.seed_embed_alpha, cfg.seed_pool)
    composed = composed_scores(seeds, anchor, n, df, key, cfg)
    penalised = terms.theme_penalty(post, themes(desc, named, key, cfg), key, cfg.theme_penalty)
    phrases = whole.filter("phrase like '% %'").select(key, "phrase")
    return {"description": desc, "name": terms.name_scores(named, whole, key), "posts": penalised, "posts_composed": composed, "phrases": phrases}


def _merged(found: dict[str, DataFrame], which: list[str], key: str, cfg: KeywordConfig, vectors: DataFrame | None, theme_vectors: DataFrame | None) -> DataFrame:
    composed = cfg.composed_weight if cfg.composed_weight is not None else cfg.posts_weight
    weights = {"description": cfg.desc_weight, "name": cfg.name_weight, "posts": cfg.posts_weight, "posts_composed": composed}
    merged = terms.merge_sources({s: (found[s], weights[s]) for s in which}, key)
    return terms.rerank(merged, vectors, theme_vectors, key, cfg) if vectors is not None and theme_vectors is not None else merged


def keywords(docs: DataFrame, posts: DataFrame, names: DataFrame, key: str, cfg: KeywordConfig, vectors: DataFrame | None = None, theme_vectors: DataFrame | None = None) -> DataFrame:
    """(key, rank, term, score, weight, source): all sources merged, reranked where vectors are given, cleaned, the best k."""
    found = sources(docs, posts, names, key, cfg, vectors, theme_vectors)
    return _finished(_merged(found, ["description", "name", "posts", "posts_composed"], key, cfg, vectors, theme_vectors), found["phrases"], key, cfg, cfg.topk)


def core_and_extended(docs: DataFrame, posts: DataFrame, names: DataFrame, key: str, cfg: KeywordConfig, vectors: DataFrame | None = None, theme_vectors: DataFrame | None = None, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Two ranked lists: from descriptions and names, and from posts and compositions, without a term of the first; each reranked where vectors are given.

    folder: where both are written, one after the other, so that the shuffle files of the first are gone when the second is made, and read from."""
    found = sources(docs, posts, names, key, cfg, vectors, theme_vectors)
    core = _finished(_merged(found, ["description", "name"], key, cfg, vectors, theme_vectors), found["phrases"], key, cfg, cfg.core_topk or cfg.topk)
    if folder is not None:
        with released(docs.sparkSession):
            core = _written(core, f"{folder}/core")
    plain = replace(cfg, ensure_name=False)
    extended = _merged(found, ["posts", "posts_composed"], key, cfg, vectors, theme_vectors)
    extended = _finished(terms.core_and_extended(core, extended, key)[1], found["phrases"], key, plain, cfg.topk)
    if folder is not None:
        with released(docs.sparkSession):
            extended = _written(extended, f"{folder}/extended")
    return core, extended
