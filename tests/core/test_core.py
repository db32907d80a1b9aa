"""Text functions, operators and sources on hand-written rows."""

import json

import pytest
from pyspark.sql import functions as F

from kwloom import catalog
from kwloom.config import STOPWORDS, KeywordConfig
from kwloom.functions import text
from kwloom.operators import clean, ops, quality, terms, trend, warehouse
from kwloom.plans import keywords as plans
from kwloom.sources import files, html
from kwloom.streaming import incremental


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "t string").select(column(F.col("t")).alias("x")).first().x


@pytest.mark.parametrize(("value", "want"), [(None, []), ("", []), ("A_b-c, Été 42!", ["a", "b", "c", "été", "42"]), ("!!!", [])])
def test_tokens(spark, value, want):
    assert one(spark, value, text.tokens) == want


def test_text_functions(spark):
    assert one(spark, "UKGardeningTips4You", text.camel_split) == ["UK", "Gardening", "Tips", "4", "You"]
    assert one(spark, "NASA", text.camel_split) == ["NASA"]
    assert one(spark, "Big big problem problem", text.collapse_repeats) == "Big problem"
    assert [one(spark, s, text.count_text) for s in ("1.4K", "12,345", "n/a", None, "1.4M")] == [1400, 12345, 0, 0, 1]
    assert [one(spark, s, text.is_artifact) for s in ("guitar solo", "facade", "foo com", "nice day", "preview redd", None)] == [True, True, True, False, True, False]
    assert one(spark, "long question today", text.simplify_seed) == "long"
    assert one(spark, "past lives", lambda c: text.equal_loose(c, F.lit("Past Life"))) is True
    assert text.segment("southernfood") == ["southern", "food"] and text.segment("short") == ["short"]
    assert one(spark, "a b", lambda c: text.ngrams(text.tokens(c), 3)) == []
    assert one(spark, "posts+name", text.source_rank) == 1
    assert "movies" in STOPWORDS and "sept" in STOPWORDS


def test_ngrams_do_not_cross_stopwords_or_sentences(spark):
    docs = spark.createDataFrame([(1, "red cars and blue bikes. green bikes"), (2, None), (3, "the")], "doc_id int, text string")
    got = {r.term for r in plans.description_terms(docs, "doc_id", KeywordConfig()).collect()}
    assert {"red cars", "blue bikes", "green bikes"} <= got and not {"cars blue", "bikes green"} & got


def test_top_k_with_phrase_replaces_the_last(spark):
    s = spark.createDataFrame([(1, "a", 3.0), (1, "b", 2.0), (1, "c", 1.0)], "doc int, term string, score double")
    p = spark.createDataFrame([(1, "c")], "doc int, phrase string")
    assert [r.term for r in terms.top_k_with(s, "doc", 2, p).orderBy("rank").collect()] == ["a", "c"]


def test_compose_limits(spark):
    seeds = spark.createDataFrame([(1, "engine noise", 9.0, 9.0, "mazda cx 5", "cx5", 3.0), (1, "cx5 price", 8.0, 8.0, "mazda cx 5", "cx5", 3.0), (1, "low seed", 1.0, 1.0, "mazda cx 5", "cx5", 3.0)], "doc int, term string, order_score double, base_score double, phrase string, token string, factor double")
    got = {r.term: r.score for r in terms.compose(seeds, "doc", KeywordConfig()).collect()}
    assert got == {"mazda cx 5 engine noise": 18.0, "cx5 engine noise": 18.0}


def test_clean_reasons(spark):
    rows = [(d, "cx5", t, s, src) for d in range(5) for t, s, src in [("common term", 9.0, "posts"), ("cx5 owners", 8.0, "posts"), ("www foo", 7.0, "posts"), ("Cx5-owners", 1.0, "name"), ("Привет", 5.0, "name")]]
    k = spark.createDataFrame(rows, "doc int, anchor string, term string, score double, source string")
    got = {(r.term, r.reason) for r in clean.clean(k, "doc", stats=True).collect()}
    assert got == {("common term", "df"), ("cx5 owners", None), ("www foo", "tech"), ("Cx5-owners", "duplicate"), ("Привет", "cyrillic")}


def test_warehouse_and_trend(spark):
    old = spark.createDataFrame([("a", "n1", "text", "2024-01-01", "2024-01-05", 1)], "community_id string, name string, description string, seen_at string, scraped_at string, seq int")
    new = spark.createDataFrame([("a", "n2", "", "2024-01-02", "2024-01-03", 2)], old.schema)
    r = warehouse.upsert_communities(old, new).first()
    assert (r["name"], r.description, r.first_seen_at, r.last_seen_at, r.last_scraped_at) == ("n2", "text", "2024-01-01", "2024-01-02", "2024-01-05")
    b = spark.createDataFrame([("x", 1, 0), ("y", 2, 100)], "name string, rank int, subscribers int")
    a = spark.createDataFrame([("x", 3, 50), ("z", 1, 5)], b.schema)
    assert {r["name"]: (r.status, r.growth) for r in trend.compare(b, a).collect()} == {"x": ("moved", 0.0), "y": ("disappeared", None), "z": ("new", None)}
    assert one(spark, "connect ECONNREFUSED", ops.error_class) == "refused"
    assert one(spark, "very very good", quality.repeats) is True


def test_html(spark):
    page = "<div data-community-id='t5' data-prefixed-name='r/x' data-subscribers-count='12'><h6>1.2K</h6><a href='/r/x/'>x</a></div><div data-community-id='t6'></div>"
    got = html.communities(spark.createDataFrame([(2, page), (3, None), (4, "<p>broken <b")], "page int, html string")).orderBy("rank").collect()
    assert [(r.community_id, r.rank, r.subscribers_count, r.url) for r in got] == [("t5", 51, 12, "/r/x/"), ("t6", 52, 0, "")]
    post = "<shreddit-post post-title='T' score='1.2K' comment-count='3' permalink='/c'><p>http://x is an address and long enough</p><p>this preview is certainly long enough</p></shreddit-post>"
    r = html.posts(spark.createDataFrame([(1, post)], "page int, html string"), "https://h").first()
    assert (r.title, r.score, r.comments, r.permalink, r.content_preview) == ("T", 1200, 3, "https://h/c", "this preview is certainly long enough")
    comment = "<shreddit-comment thingid='t1' depth='0' score='5'><div class='md'>hi</div></shreddit-comment><shreddit-comment thingid='t2' depth='4'></shreddit-comment>"
    assert [(c.id, c.text, c.score) for c in html.comments(spark.createDataFrame([(1, comment)], "page int, html string"), max_depth=2).collect()] == [("t1", "hi", 5)]
    state = "<script>w = {\"a\": [{\"communities\": [{\"id\": \"9\", \"name\": \"n\", \"subscribers\": 4}]}]};</script>"
    assert html.embedded_communities(spark.createDataFrame([(1, state)], "page int, html string")).first()["name"] == "r/n"


def test_files_and_stream(spark, tmp_path):
    (tmp_path / "p.json").write_text(json.dumps({"page": 1, "subreddits": [{"community_id": "1", "name": "r/CX5", "rank": 1}]}))
    assert files.read_pages(spark, str(tmp_path / "p.json")).first().key == "cx5"
    (tmp_path / "w.txt").write_text("# note\nfoo, bar baz # more\n")
    assert {r.word for r in files.read_words(spark, str(tmp_path / "w.txt")).collect()} == {"foo", "bar", "baz"}
    k = spark.createDataFrame([(1, 2, "b", 0.4, 4.0, "name"), (1, 1, "a", 0.6, 6.0, "posts")], "doc int, rank int, term string, weight double, score double, source string")
    files.write_keywords(k, "doc", str(tmp_path / "out"))
    assert [x.term for x in spark.read.json(str(tmp_path / "out")).first()["keywords"]] == ["a", "b"]
    (tmp_path / "in").mkdir()
    for i, t in enumerate(["red cars", "red bikes"]):
        (tmp_path / "in" / f"{i}.json").write_text(json.dumps({"doc_id": i, "text": t}))
        incremental.watch(spark, str(tmp_path / "in"), "doc_id int, text string", str(tmp_path / "df"), str(tmp_path / "cp"), "doc_id", KeywordConfig()).awaitTermination(60)
    df, n = incremental.document_frequencies(spark, str(tmp_path / "df"))
    assert {r.term: r.df for r in df.collect()}["red"] == 2 and n.first().n == 2


def test_every_oracle_has_a_query():
    assert set(catalog.oracle_sql()) <= set(catalog.queries()) and catalog.FLAGSHIP in catalog.queries()
