"""The wired plan, places without a single-task sort, and display forms, on small rows."""

import random
import statistics

from pyspark.sql import functions as F

from kwloom.config import KeywordConfig
from kwloom.functions import text
from kwloom.operators import measures, ops, quality, terms, warehouse
from kwloom.plans import keywords as plans


def test_places_match_a_sort(spark):
    r = random.Random(1)
    values = [r.choice([1.0, 2.5, r.random() * 100]) for _ in range(1000)]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "x double")
    want = sorted(values)
    got = quality.at_places(df, "x", {f"p{i}": F.lit(i) for i in (0, 17, 499, 998, 999)}).first().asDict()
    assert got == {f"p{i}": want[i] for i in (0, 17, 499, 998, 999)}
    assert abs(quality.quantile_linear(df, "x", 0.5).first().p50 - statistics.median(values)) < 1e-12
    assert quality.quantile_nearest(df.limit(0), "x", 0.5).count() == 0


def test_numbers_follow_the_order_whatever_the_ties(spark):
    r = random.Random(2)
    rows = [(r.choice([1, 2, 10**12]), f"é{r.randint(0, 10**6)}x{i}") for i in range(500)]
    df = spark.createDataFrame(rows, "rank bigint, name string").repartition(7)
    got = {(x["rank"], x["name"]): x["at"] for x in ops.numbered(df, ["rank", "name"], per_bin=40).collect()}
    assert got == {k: i for i, k in enumerate(sorted(rows))}
    names = {x["name"]: x["at"] for x in ops.numbered(df, ["name"]).collect()}
    assert names == {n: i for i, n in enumerate(sorted(n for _, n in rows))}
    assert ops.numbered(df.limit(0), ["rank"]).count() == 0
    known = spark.createDataFrame([(7, "b")], "id bigint, term string")
    ids = {x.term: x.id for x in warehouse.extend_dictionary(known, spark.createDataFrame([("c",), ("a",), ("b",), ("a",)], "term string")).collect()}
    assert ids == {"b": 7, "a": 8, "c": 9}


def test_no_task_numbers_names_of_one_prefix_alone(spark):
    """Names that begin alike, and rows without a rank, are dealt to bins of like size."""
    df = spark.range(20_000).selectExpr("1000000000000 rank", "concat('https://example.org/communities/', lpad(id, 9, '0')) name")
    out = ops.numbered(df, ["rank", "name"], per_bin=1000)
    assert [r["at"] for r in out.orderBy("name").collect()] == list(range(20_000))
    bins = ops.binned(df, ["rank", "name"], 1000).groupBy("_bin").count().collect()
    assert len(bins) > 15 and max(r["count"] for r in bins) < 2500


def test_display_forms(spark):
    row = spark.createDataFrame([("r/CX5owners/", "cx5owners oil", "mazda cx 5 oil change")], "name string, a string, b string")
    key, shown = text.canonical_key(F.col("name")), text.display_key(F.col("name"))
    got = row.select(key, shown, text.recased(F.col("a"), key, shown, F.lit("mazda cx 5"), F.lit("Mazda CX-5")), text.recased(F.col("b"), key, shown, F.lit("mazda cx 5"), F.lit("Mazda CX-5"))).first()
    assert tuple(got) == ("cx5owners", "CX5owners", "CX5owners oil", "Mazda CX-5 oil change")
    names = spark.createDataFrame([(1, "r/the_NASAFans"), (2, "x")], "doc int, name string")
    assert {(r.phrase, r.shown) for r in plans.name_phrases(names, "doc").collect()} == {("the nasa fans", "The NASA Fans"), ("x", "X")}


def frames(spark):
    docs = spark.createDataFrame([(i, "engine oil change and brake noise. the engine runs." + (" common filler" if i else "")) for i in range(8)], "doc int, text string")
    posts = spark.createDataFrame([(i, p, "oil change interval question " * 3, 10, 2, 1.0, False) for i in range(6) for p in range(3)], "doc int, post int, text string, score int, comments int, age_days double, is_promoted boolean")
    names = spark.createDataFrame([(i, "r/Mazda_Owners", "Mazda Owners Club") for i in range(8)], "doc int, name string, title string")
    return docs, posts, names


def test_plan_options(spark):
    docs, posts, names = frames(spark)
    cfg = KeywordConfig(compose_min_base=0.1)
    top = plans.keywords(docs, posts, names, "doc", cfg).collect()
    by = {}
    for r in top:
        by.setdefault(r.doc, []).append(r)
    assert set(by) == set(range(8)) and all("mazda owners" in {r.term for r in rs} for rs in by.values())
    assert any(r.source == "posts_composed" and r.term.startswith("mazda owners club ") for r in by[0])
    few = plans.keywords(docs, posts, names, "doc", KeywordConfig(require_posts=True))
    assert {r.doc for r in few.select("doc").distinct().collect()} == set(range(6))
    one = plans.keywords(docs, posts, names, "doc", KeywordConfig(topk=1)).collect()
    assert len(one) == 8
    # words that most documents hold end an n-gram
    assert not any("engine" in r.term.split() for r in plans.description_scores(docs, "doc", cfg, dynamic=True).collect())
    core, extended = plans.core_and_extended(docs, posts, names, "doc", cfg)
    mine = {(r.doc, r.term) for r in core.collect()}
    others = {(r.doc, r.term) for r in extended.collect()}
    assert mine and others and not mine & others
    anchor = plans.anchors(names, "doc", cfg).first()
    assert (anchor.token, anchor.phrase, anchor.ckey) == ("owners", "mazda owners club", "mazda_owners")


def test_seed_modes_and_vectors(spark):
    scored = spark.createDataFrame([(1, "a b", 5.0), (1, "c d", 4.0)], "doc int, term string, score double")
    local = spark.createDataFrame([(1, "a b", 2), (1, "e f", 9)], "doc int, term string, tf int")
    got = {m: sorted((r.term, r.order_score, r.base_score) for r in terms.seed_base(scored, local, "doc", m).collect()) for m in ("posts_tfidf", "posts_local_tf", "hybrid")}
    assert got["posts_tfidf"] == [("a b", 5.0, 5.0), ("c d", 4.0, 4.0)]
    assert got["posts_local_tf"] == [("a b", 2.0, 5.0), ("e f", 9.0, 0.0)]
    assert got["hybrid"] == [("a b", 5.0, 5.0), ("c d", 4.0, 4.0), ("e f", 9.0, 0.0)]
    vectors = spark.createDataFrame([("a b", [1.0, 0.0]), ("c d", [-1.0, 0.0])], "term string, vector array<double>")
    theme = spark.createDataFrame([(1, [1.0, 0.0])], "doc int, vector array<double>")
    out = {r.term: r.order_score for r in terms.rerank_seeds(terms.seed_base(scored, local, "doc", "posts_tfidf"), vectors, theme, "doc", 0.6, 200).collect()}
    assert abs(out["a b"] - 1.0) < 1e-9 and abs(out["c d"] - 0.4 * 0.8) < 1e-9


def test_leaks_and_sources(spark):
    k = spark.createDataFrame([(1, 1, "just things", 9.0, "posts"), (1, 2, "oil change", 5.0, "posts_composed"), (1, 3, "on the road", 2.0, "description+posts")], "doc int, rank int, term string, score double, source string")
    got = {(r.category, r.leak, r.term) for r in measures.leaks(k, ["on the"], ["road"]).collect()}
    assert got == {("discourse_markers", "just", "just things"), ("generic_conversation", "thing", "just things"), ("generic_conversation", "things", "just things"), ("phrase_stoplist", "on the", "on the road"), ("extra_stopwords", "road", "on the road")}
    posts = spark.createDataFrame([(1, 1, "Oil for a change"), (1, 2, "nothing"), (1, 3, None)], "doc int, post int, text string")
    assert [(r.term, r.post, r.overlap) for r in measures.source_posts(k.filter("rank = 2"), posts, "doc").collect()] == [("oil change", 1, 1.0)]
    loose = measures.source_posts(spark.createDataFrame([(1, "oil change"), (1, "nothing to see"), (1, "road")], "doc int, term string"), posts, "doc", any_word=True)
    assert {(r.term, r.post, round(r.overlap, 3)) for r in loose.collect()} == {("oil change", 1, 1.0), ("nothing to see", 2, 0.333)}
    ranked = spark.createDataFrame([("a", 3), ("A", 1), ("b", None)], "name string, rank int")
    assert {(r.name, r["rank"]) for r in ops.best_ranks(ranked, True).collect()} == {("a", 1)} and ops.best_ranks(ranked).count() == 2
    hashes = {r.key_hash for r in (warehouse.key_set_hash(spark.createDataFrame([(x,) for x in xs], "k string"), "k").first() for xs in (["a", "b"], ["b", "a", "a"]))}
    assert len(hashes) == 1


def test_compositions_of_posts_are_written_in_steps_that_go(spark, tmp_path):
    from kwloom.sources.storage import Store

    cfg = KeywordConfig(compose_min_base=0.0)
    posts = spark.createDataFrame([(c, p, f"engine oil change number{c} engine oil filter w{p}x", 3, 1, 0.5, False) for c in range(6) for p in range(3)], "doc_id int, post int, text string, score int, comments int, age_days double, is_promoted boolean")
    names = spark.createDataFrame([(c, f"MotorClub{c}", "Motor Club") for c in range(6)], "doc_id int, name string, title string")
    tf = plans.posts_terms(posts, "doc_id", cfg)
    seeds = terms.seed_base(plans.posts_scores(posts, "doc_id", cfg, tf), tf, "doc_id", cfg.compose_seeds)
    want = plans.composed_scores(seeds, plans.anchors(names, "doc_id", cfg), plans.posts_documents(tf, "doc_id"), terms.document_frequency(tf, "doc_id"), "doc_id", cfg)
    got = plans.posts_composed(posts, names, "doc_id", cfg, f"file://{tmp_path}/work")
    assert got.count() > 0 and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert Store(spark, f"file://{tmp_path}/work").names() == ["composed"]


def test_extended_lists_are_written_after_the_core(spark, tmp_path):
    docs = spark.createDataFrame([(c, f"engine oil club number{c}. oil change") for c in range(5)], "doc_id int, text string")
    posts = spark.createDataFrame([(c, p, f"gear box repair w{p}x engine oil", 3, 1, 0.5, False) for c in range(5) for p in range(2)], "doc_id int, post int, text string, score int, comments int, age_days double, is_promoted boolean")
    names = spark.createDataFrame([(c, f"MotorClub{c}") for c in range(5)], "doc_id int, name string")
    core, extended = plans.core_and_extended(docs, posts, names, "doc_id", KeywordConfig(), folder=f"file://{tmp_path}/lists")
    assert "Exchange" not in core._jdf.queryExecution().executedPlan().toString() + extended._jdf.queryExecution().executedPlan().toString()
    assert {r.doc_id for r in extended.collect()} == set(range(5)) and not {(r.doc_id, r.term) for r in core.collect()} & {(r.doc_id, r.term) for r in extended.collect()}
