"""The versioned warehouse, snapshots, manifests, file checks, lookups, subjects and the frequency cache."""

import json
import os
import random
import re
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from kwloom.config import KeywordConfig
from kwloom.functions import text
from kwloom.operators import quality, subjects, terms
from kwloom.plans import keywords as plans
from kwloom.sources import filechecks, files, html, lookup, manifests, snapshots
from kwloom.sources.storage import Store
from kwloom.sources.warehouse_store import Conflict, Warehouse
from kwloom.streaming.frequency_cache import FrequencyCache, Refused

LISTS = "input_file string, seq long, community_id string, name string, rank long, keywords array<struct<term:string,weight:double,score:double,source:string>>"
FILES = "input_file string, file_hash string"


def lists(spark, rows):
    return spark.createDataFrame([(f, s, c, n, r, [(t, 0.5, x, src) for t, x, src in ks]) for f, s, c, n, r, ks in rows], LISTS)


def links(w, version=None):
    words = w.table("keywords", version).withColumnRenamed("id", "keyword_id")
    return sorted((r.community_id, r.term, r["rank"], r.score) for r in w.table("links", version).join(words, "keyword_id").collect())


def test_warehouse_loads(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    first = lists(spark, [("a", 1, "t5_1", "one", 3, [("oil", 2.0, "posts"), ("change", 1.0, None), (" ", 9.0, "x"), ("oil", 0.5, "name")]), ("a", 2, "t5_2", "two", 4, [("oil", 7.0, "posts")]), ("a", 3, None, "nobody", 9, [("lost", 1.0, "x")])])
    fa = spark.createDataFrame([("a", "h1")], FILES)
    dry = w.load_keywords(first, fa, "t1", dry_run=True)
    assert w.versions() == [] and dry.rows == {"communities": 2, "keywords": 2, "links": 3, "ingests": 1}
    done = w.load_keywords(first, fa, "t1")
    assert done.version == 1 and done.rows == dry.rows and (done.files, done.skipped) == (1, 0)
    # of a term that a list holds twice the later place counts
    assert links(w) == [("t5_1", "change", 2, 1.0), ("t5_1", "oil", 4, 0.5), ("t5_2", "oil", 1, 7.0)]
    again = w.load_keywords(first, fa, "t2")
    assert (again.version, again.files, again.skipped) == (1, 0, 1) and w.versions() == [1]
    forced = w.load_keywords(first, fa, "t2", skip_unchanged=False)
    assert forced.version == 2 and links(w) == links(w, 1) and w.table("ingests").count() == 2
    second = lists(spark, [("b", 1, "t5_2", "two!", 2, [("change", 3.0, "posts")]), ("b", 2, "t5_3", "three", 1, [("brake", 1.0, "posts")])])
    w.load_keywords(second, spark.createDataFrame([("b", "h2"), ("c", "h3")], FILES).withColumn("error", F.when(F.col("input_file") == "c", "broken")), "t3")
    assert links(w) == [("t5_1", "change", 2, 1.0), ("t5_1", "oil", 4, 0.5), ("t5_2", "change", 1, 3.0), ("t5_2", "oil", 1, 7.0), ("t5_3", "brake", 1, 1.0)]
    assert {r.term: r.id for r in w.table("keywords").collect()} == {"change": 1, "oil": 2, "brake": 3}
    got = {r.community_id: (r.name, r["rank"], r.first_seen_at, r.last_seen_at, r.version) for r in w.table("communities").collect()}
    assert got == {"t5_1": ("one", 3, "t1", "t2", 2), "t5_2": ("two!", 2, "t1", "t3", 3), "t5_3": ("three", 1, "t3", "t3", 3)}
    assert sorted((r.id, r.input_file, r.status, r.record_count) for r in w.table("ingests").collect()) == [(1, "a", "ok", 3), (2, "a", "ok", 3), (3, "b", "ok", 2), (4, "c", "error", 0)]
    # pages fill columns in and leave links alone
    pages = spark.createDataFrame([("p1", 1, "t5_1", "one more", "about one", 5)], "input_file string, seq long, community_id string, name string, description string, rank long")
    before = links(w)
    w.load_pages(pages, spark.createDataFrame([("p1", "h")], FILES), "t4")
    row = {r.community_id: r for r in w.table("communities").collect()}
    assert (row["t5_1"].description, row["t5_1"]["rank"], row["t5_1"].name, row["t5_2"].description) == ("about one", 5, "one more", None) and links(w) == before
    w.load_keywords(first, spark.createDataFrame([("a", "h9")], FILES), "t5")
    assert {r.community_id: r.description for r in w.table("communities").collect()}["t5_1"] == "about one"
    # old versions can be read until they are vacuumed
    assert links(w, 1) != links(w) and w.vacuum(keep=2)
    assert len(w.versions()) == 2 and links(w) and w.vacuum(keep=2) == []
    rebuilt = w.load_keywords(second, spark.createDataFrame([("b", "h2")], FILES), "t6", rebuild=True)
    assert rebuilt.rows == {"communities": 2, "keywords": 2, "links": 2, "ingests": 1} and w.table("keywords").count() == 2


def test_failed_and_competing_loads_leave_the_version_before(spark, tmp_path):
    w = Warehouse(spark, f"file://{tmp_path}/w")
    good = lists(spark, [("a", 1, "t5_1", "one", 3, [("oil", 2.0, "posts")])])
    w.load_keywords(good, spark.createDataFrame([("a", "h1")], FILES), "t1")
    was = links(w)

    def broken(batches):
        for b in batches:
            raise ValueError("a broken file")
            yield b

    bad = good.withColumn("input_file", F.lit("z")).mapInArrow(broken, LISTS)
    with pytest.raises(Exception, match="broken file"):
        w.load_keywords(bad, spark.createDataFrame([("z", "h2")], FILES), "t2")
    assert links(w) == was and w.versions() == [1, 2]
    assert [(r.input_file, r.status, "broken file" in r.error) for r in w.table("ingests").filter("status <> 'ok'").collect()] == [("z", "error", True)]
    # what failed is loaded when it is whole; another load that took the number first wins
    w.load_keywords(good.withColumn("input_file", F.lit("z")), spark.createDataFrame([("z", "h2")], FILES), "t3")
    create = w.store.create
    w.store.create = lambda name, body: create(name, json.dumps(w.commit_of() | {"version": 4})) and create(name, body)
    with pytest.raises(Conflict):
        w.load_keywords(good, spark.createDataFrame([("a", "h5")], FILES), "t4")
    assert w.versions() == [1, 2, 3, 4] and links(w) == was


def page_folder(tmp_path, label):
    pages = tmp_path / "pages"
    pages.mkdir(exist_ok=True)
    (pages / "page_1.json").write_text(json.dumps({"label": label}))
    return f"file://{pages}"


def label(tmp_path, name):
    return json.loads((tmp_path / "hist" / name / "pages" / "page_1.json").read_text())["label"]


def test_snapshots_rotate_and_go_on_after_a_stop(spark, tmp_path):
    root, now = f"file://{tmp_path}/hist", datetime(2025, 1, 8, 12, 30, 45, tzinfo=timezone.utc)
    (tmp_path / "none").mkdir()
    assert snapshots.archive(spark, f"file://{tmp_path}/none", root, now) is None
    assert [snapshots.snapshot_name(now, g) for g in ("week", "day", "month", "timestamp")] == ["2025-W02", "2025-01-08", "2025-01", "20250108_123045"]
    for i in range(4):
        assert snapshots.archive(spark, page_folder(tmp_path, i), root, now, depth=3).endswith("2025-W02")
    weeks = ["2025-W02", "2025-W01", "2024-W52", "2024-W51"]
    assert [label(tmp_path, w) for w in weeks] == [3, 2, 1, 0]
    # a stop after the first rename: every week is in one place, and the next run goes on
    store = Store(spark, root)
    store.rename("2024-W51", "2024-W50")
    snapshots.archive(spark, page_folder(tmp_path, 4), root, now, depth=3)
    assert [label(tmp_path, w) for w in [*weeks, "2024-W50"]] == [4, 3, 2, 1, 0]
    # nothing is lost where the way out is blocked: the new one stands beside
    path = snapshots.archive(spark, page_folder(tmp_path, 5), root, now, depth=0)
    assert path.endswith("2025-W02_123045") and label(tmp_path, "2025-W02") == 4 and label(tmp_path, "2025-W02_123045") == 5
    snapshots.archive(spark, page_folder(tmp_path, 6), root, now, overwrite=True)
    assert label(tmp_path, "2025-W02") == 6
    (tmp_path / "hist" / ".draft-2025-W02").mkdir()
    snapshots.archive(spark, page_folder(tmp_path, 7), root, now, "day")
    assert not (tmp_path / "hist" / ".draft-2025-W02").exists() and json.loads((tmp_path / "hist" / "2025-01-08" / "archive_metadata.json").read_text())["granularity"] == "day"


def test_counters_of_a_run_equal_a_second_scan(spark, tmp_path):
    rows = [(i, "timeout" if i % 5 == 0 else None, [] if i % 7 == 0 else [{"name": f"c{k}"} for k in range(i % 4 + 1)]) for i in range(1, 60)]
    pages = spark.createDataFrame(rows, "page int, error string, subreddits array<struct<name:string>>").repartition(6)
    root, now = f"file://{tmp_path}/run", datetime(2025, 1, 8, tzinfo=timezone.utc)
    manifest = manifests.write_pages(pages, root, now)
    again = spark.read.schema(pages.schema).json(f"{root}/pages")
    assert manifest["total"] == sum(len(r[2]) for r in rows) == again.agg(F.sum(F.size("subreddits"))).first()[0]
    assert manifest["pages_done"] == [r[0] for r in rows if not r[1]] and manifest["last_page"] == 59 and manifest["week_id"] == "2025-W02"
    assert manifest["failed"] == again.filter("error <> ''").count()
    more = manifests.write_pages(pages.filter("page = 5").withColumn("error", F.lit(None).cast("string")), root, now)
    assert more["pages_done"] == sorted([*manifest["pages_done"], 5]) and json.loads((tmp_path / "run" / "manifest.json").read_text()) == more
    counts = manifests.written(pages.limit(0), f"file://{tmp_path}/empty", manifests.page_counters())
    assert (counts["pages"], counts["communities"], counts["last_page"]) == (0, 0, None)
    for name in ("one/posts/t3_b.json", "one/posts/t3_a.json", "two/posts/t3_c.json", "two/frontpage.json", "two/posts/x.txt"):
        at = tmp_path / "subs" / name
        at.parent.mkdir(parents=True, exist_ok=True)
        at.write_text("{}")
    listing = manifests.file_listing(spark, f"file://{tmp_path}/subs")
    assert {r.community: (r.post_files, r["count"]) for r in manifests.post_manifests(listing).collect()} == {"one": (["t3_a.json", "t3_b.json"], 2), "two": (["t3_c.json"], 1)}
    meta = manifests.page_metadata(spark.createDataFrame([(1, 1, "a", "x"), (2, 1, "a", "y"), (2, 2, "a", "z"), (1, 2, None, "w")], "page int, seq int, community_id string, url string"))
    assert [(r.community_id, r.page, r.url) for r in meta.collect()] == [("a", 2, "z")]


def test_files_are_told_apart_by_their_heads(spark, tmp_path, monkeypatch):
    made = {"good.json": '\n\n{"a": 1}\n' + "x" * 300_000, "empty.json": "", "blank.json": " \n \n", "broken.json": "no object\n" * 5, "late.json": "y" * 100_000 + "{", "old.json": "{}"}
    for name, body in made.items():
        (tmp_path / name).write_text(body)
    os.utime(tmp_path / "old.json", (1, 1))
    listing = manifests.file_listing(spark, f"file://{tmp_path}", "*.json")
    inputs = spark.createDataFrame([("old.json", datetime(2020, 1, 1)), ("good.json", datetime(1999, 1, 1))], "name string, modified timestamp")
    states = {r.path.rsplit("/", 1)[1]: r.state for r in filechecks.verified(listing, inputs).collect()}
    assert states == {"good.json": "valid", "empty.json": "empty", "blank.json": "broken", "broken.json": "broken", "late.json": "broken", "old.json": "stale"}
    heads = {r.path.rsplit("/", 1)[1]: len(r.head) for r in filechecks.heads(listing, 100).collect()}
    assert max(heads.values()) == 100
    gone = filechecks.verified(listing.withColumn("path", F.concat("path", F.lit(".gone"))))
    assert {r.state for r in gone.filter("length > 0").collect()} == {"unreadable"}
    report = filechecks.directory_report(filechecks.verified(listing, inputs)).first()
    assert (report.files, report.valid, report.empty, report.broken, report.stale, report.bytes) == (6, 1, 1, 3, 1, sum(len(b) for b in made.values()))
    names = ["a_progress_page_12.json", "page_30.json", "page_x.json", "a_complete.json", "page_7.json"]
    listed = spark.createDataFrame([(f"/o/{n}", n) for n in names], "path string, name string")
    assert filechecks.resume_from(filechecks.progress(listed)).first().asDict() == {"path": "/o/page_30.json", "last_page": 30, "next_page": 31}
    whole = spark.createDataFrame([("/o/a_complete.json", 30)], "path string, last_page int")
    assert filechecks.resume_from(filechecks.progress(listed), whole).first().path == "/o/a_complete.json"
    assert filechecks.resume_from(filechecks.progress(listed.limit(0))).first().asDict() == {"path": None, "last_page": 0, "next_page": 1}


def test_lookup_reads_few_buckets(spark, tmp_path):
    k = spark.range(5000).selectExpr("concat('c', id % 500) key", "cast(id / 500 as int) + 1 rank", "concat('term ', id) term", "id * 1.0D score", "if(id % 2 = 0, 'description', 'posts') source")
    lookup.write_lookup(k, "key", "kw_lookup_test", 16, f"file://{tmp_path}/lookup")
    show = "spark.sql.sources.bucketing.autoBucketedScan.enabled"  # buckets are pruned in any case, but the plan tells so only without this
    spark.conf.set(show, False)
    try:
        found = lookup.find(spark, "kw_lookup_test", "key", ["c7", "c8", "nobody"])
        assert [(r.key, r["rank"]) for r in found.collect()] == [(c, i) for c in ("c7", "c8") for i in range(1, 11)]
        plan = found._jdf.queryExecution().toString()
        chosen = re.search(r"SelectedBucketsCount: (\d+) out of 16", plan)
        assert chosen and int(chosen[1]) <= 3
    finally:
        spark.conf.unset(show)
        spark.sql("drop table kw_lookup_test")


def test_inspection_of_a_community(spark):
    k = spark.createDataFrame([(1, 1, "Oil change", 9.0, "posts"), (1, 2, "engine", 5.0, "description+name"), (1, 3, "brake pads", 2.0, "description")], "doc int, rank int, term string, score double, source string")
    c = spark.createDataFrame([(1, "r/CX5owners", None), (2, "r/x", None)], "doc int, name string, url string")
    posts = spark.createDataFrame([(1, i, f"title {i}", i % 3, i) for i in range(9)], "doc int, post int, text string, score int, comments int")
    one = {r.doc: r for r in lookup.inspect(k, c, posts, "doc", k=2, titles=3, theme_k=1).collect()}
    assert [t.term for t in one[1].terms] == ["Oil change", "engine"] and (one[1].description, one[1].posts, one[1].posts_composed) == (0.5, 0.5, 0.0)
    assert one[1].theme == ["5", "cx", "engine", "owners"] and one[1].titles == ["title 8", "title 5", "title 2"] and one[2].terms is None and one[2].theme == ["x"]


def test_subjects_are_met_by_a_filter_and_a_join(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(60)]
    list_ = [" ".join(r.sample(words, 2)) for _ in range(400)] + ["Oil  Change", "single", "", None]
    grams = [(d, " ".join(r.sample(words, 2)), 2) for d in range(20) for _ in range(200)] + [(1, "oil change", 2), (1, "single", 1)]
    s = spark.createDataFrame([(x,) for x in list_], "subject string")
    g = spark.createDataFrame(grams, "doc int, term string, n int")
    clean = {" ".join(x.lower().split()) for x in list_ if x}
    want = sorted({(d, t) for d, t, n in grams if n >= 2 and t in clean})
    found = subjects.seeds(g, s, "doc", 12)
    assert sorted(tuple(x) for x in found.collect()) == want and want
    some = subjects.possibly(g, "term", subjects.bloom(subjects.clean(s), "subject", 14), 14)
    kept = {(x.doc, x.term) for x in some.collect()}
    assert set(want) <= kept and len(kept) < 0.5 * len(set((d, t) for d, t, _ in grams))
    assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
    scored = spark.createDataFrame([(1, "oil change", 4.0)], "doc int, term string, score double")
    anchor = spark.createDataFrame([(1, "Mazda CX", "cx")], "doc int, phrase string, token string")
    made = {x.term: x.score for x in subjects.compose(found.filter("term = 'oil change'"), scored, anchor, "doc", bonus=1.5).collect()}
    assert made == {"mazda cx oil change": 6.0, "cx oil change": 6.0}
    assert subjects.seeds(g, s.limit(0), "doc").count() == 0 and subjects.seeds(g.limit(0), s, "doc").count() == 0


def test_frequency_cache_takes_in_new_keys_only(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"engine oil {'brake' if i % 2 else 'noise'}") for i in range(10)], "doc int, text string")
    cfg = KeywordConfig()
    count = lambda r: plans.description_terms(r, "doc", cfg)
    cache = FrequencyCache(spark, f"file://{tmp_path}/df", "doc")
    assert cache.frequencies()[1] == 0 and cache.extend(rows.filter("doc < 6"), count) == 6
    assert cache.extend(rows.filter("doc < 6"), count) == 0 and cache.extend(rows, count) == 4
    df, n = cache.frequencies(rows.select("doc"))
    assert n == 10 and {r.term: r.df for r in df.collect()} == {r.term: r.df for r in terms.document_frequency(count(rows), "doc").collect()}
    with pytest.raises(Refused):
        cache.frequencies(rows.filter("doc < 9").select("doc"))


def test_posts_options_and_frequent_words(spark, tmp_path):
    posts = spark.createDataFrame([(1, 1, "engine oil change", 1, 1, 0.0, False, "brake pads"), (1, 2, "engine oil", 1, 1, 0.0, False, "кот")], "doc int, post int, text string, score int, comments int, age_days double, is_promoted boolean, preview string")
    found = lambda **o: {r.term for r in plans.posts_terms(posts, "doc", KeywordConfig(**o)).collect()}
    plain = found()
    assert "engine oil change" in plain and "brake" not in plain
    assert found(include_preview=True) >= plain | {"brake pads", "change brake"} and "кот" in found(include_preview=True)
    assert found(posts_stopwords=("oil",)) == {"engine", "change"}
    assert found(posts_phrases=("engine oil", "oil")) == plain - {"engine oil", "oil"}
    assert "кот" not in found(include_preview=True, drop_nonlatin_posts=True)
    freq = quality.zipf(spark.createDataFrame([("engine", 900_000), ("oil", 10), ("us", 99_000), ("rare", 1)], "word string, n long"))
    assert quality.frequent_words(freq, 6.0, ["us"]) == ["engine"]
    assert found(frequent_words=("engine",)) == {"oil", "change", "oil change"}
    docs = spark.createDataFrame([(1, "engine oil change")], "doc int, text string")
    assert {r.term for r in plans.description_terms(docs, "doc", KeywordConfig(frequent_words=("engine",))).collect()} == {"oil", "change", "oil change"}
    with pytest.raises(ValueError, match="below 3"):
        quality.frequent_words(freq, 2.0, [])
    k = spark.createDataFrame([("Engine",), ("engine oil",), ("The",), ("oil",), (None,)], "term string")
    assert {(r.term, r.generic) for r in quality.generic_unigrams(k, freq, 6.0, ["the"]).collect()} == {("Engine", True), ("engine oil", False), ("The", True), ("oil", False), (None, False)}
    (tmp_path / "p.txt").write_text("On  the, and THE # no\n\n# all\nlast one\n")
    assert {r.phrase for r in files.read_phrases(spark, f"file://{tmp_path}/p.txt").collect()} == {"on the", "and the", "last one"}
    assert text.canonical_key(F.lit("x")) is not None


def test_sidebar_widgets_and_post_awards(spark):
    from kwloom.sources import html

    side = """<html><body><div id="right-sidebar-contents">
      <div class="py-md x"><div class="px-md"><h2 class="font-bold">Links</h2><a href="/a"><span class="i18n-translatable-text hidden">no</span><span class="i18n-translatable-text">Yes</span></a>
        <a href="/b">Home Home Home</a><a href="">none</a></div></div>
      <div class="py-md"><div class="px-md"><span class="text-12">Community Info</span><div class="i18n-translatable-text a overflow-hidden"><p>One <a href="/x">two</a></p><p></p><p>three</p></div></div></div>
      <div class="py-md"><div class="px-md"><h3 class="text-12">About</h3><p>Some words</p><p>ab</p><button>Join</button>SC_OFF<p>and more</p></div></div>
      <div class="py-md"><div class="px-md"><h3 class="text-12">Rules</h3><p>be kind</p></div></div><div class="py-md"><div class="px-md"><p>untitled</p></div></div></div>
      <div class="py-md"><div class="px-md"><h3 class="text-12">Outside</h3><p>not in the sidebar</p></div></div></body></html>"""
    post = """<shreddit-post post-title="T"><div class="x awards-bar"><span class="award" data-award-id="a1" data-count="3">Gold<img src="/g.png"></span><span class="award big">Plain</span></div><span class="post-flair">Oil</span><span class="author-badge">Mod</span></shreddit-post>"""
    pages = spark.createDataFrame([(1, side), (2, None)], "page int, html string")
    got = {r.page: [(w.title, w.content, [(x.text, x.url) for x in w.links]) for w in r.sidebar_widgets] for r in html.metadata(pages).collect()}
    assert got == {1: [("Links", None, [("Yes", "/a"), ("Home", "/b")]), ("Community Info", "One two\n\nthree", []), ("About", "Some words and more", [])], 2: []}
    r = html.post_details(spark.createDataFrame([(1, post)], "page int, html string")).first()
    assert [tuple(a) for a in r.awards] == [("a1", "3", "Gold", "/g.png"), ("", "", "Plain", None)] and (r.flair, r.badges) == (["Oil"], ["Mod"])
    many = spark.createDataFrame([(i, f"<h1>{i}</h1>" if i % 2 else "") for i in range(50)], "page_id int, html string")
    assert sorted((x.page_id, x.heading) for x in html.page_parts(many).collect()) == [(i, str(i) if i % 2 else "") for i in range(50)]


def test_bodies_of_comments_are_found_without_an_expression_for_each(monkeypatch):
    page = "".join(f"<shreddit-comment thingid='{i}'><div id='x{i}-post-rtjson-content'>no</div><div id='{i}{more}-post-rtjson-content'>yes</div></shreddit-comment>" for i, more in (("a.b", ""), ("a(b", "-1"), ("c", "\n"), ("", "")))
    root = html.parse(page)
    monkeypatch.setattr(html.re, "match", lambda *_: pytest.fail("an expression for a comment"))
    assert [c["text"] for c in html._comments(root)] == ["yes", "yes", "", ""]


def test_output_files_are_written_by_several_tasks(spark, tmp_path, monkeypatch):
    from kwloom import catalog

    spark.range(24).selectExpr("id s_suppkey", "concat('S', id) s_name").coalesce(1).write.parquet(f"{tmp_path}/in/supplier.parquet")
    monkeypatch.setattr(catalog, "shared_folder", lambda spark, name: f"file://{tmp_path}/{name}")
    got = {r.n: r.state for r in catalog.output_states(spark, f"{tmp_path}/in").collect()}
    assert got == {n: "broken" if n % 3 == 0 else "valid" for n in range(24)}
    assert len({p.name.split("-")[1] for p in (tmp_path / "outputs").glob("n=*/part-*")}) > 1
