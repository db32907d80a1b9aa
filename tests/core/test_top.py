"""The best terms of descriptions by bounds against all scores, ranked."""

from __future__ import annotations

import random
from dataclasses import replace

import pytest

from kwloom.config import KeywordConfig
from kwloom.operators import bloom, subjects, terms
from kwloom.plans import keywords as plans
from kwloom.sources import storage

CFG = KeywordConfig()
CASES = [(CFG, 25, 5), (CFG, 3, 40), (CFG, 4, 100_000), (replace(CFG, desc_generic_phrase_ratio=0.02), 4, 30), (replace(CFG, min_df_bigram=1, min_df_trigram=3), 5, 20)]


@pytest.mark.parametrize(("cfg", "k", "common"), CASES)
def test_top_of_descriptions_is_that_of_all_scores(spark, tmp_path, cfg, k, common):
    r = random.Random(k)
    word = lambda: f"w{int(r.paretovariate(0.6)) % 400:x}q"
    rows = [(i, " ".join(word() + r.choice(["", "", "", "."]) for _ in range(r.choice([0, 2, 9, 60])))) for i in range(150)]
    rows += [(150, None), (151, ""), (152, "zebra zoo " * 30), (153, "the of"), (154, "lone phrase here now " * 3), (155, "lone phrase"), (None, "zebra zoo keeper")]
    docs = spark.createDataFrame(rows, "doc_id int, text string")
    want = terms.top_k(plans.description_scores(docs, "doc_id", cfg), "doc_id", k)
    got = plans.description_top(docs, "doc_id", cfg, k, f"file://{tmp_path}/df", common)
    shown = lambda d: sorted(map(str, d.select("doc_id", "rank", "term", "n", "tf", "pos", "score").collect()))
    assert shown(got) == shown(want)


def test_few_terms_of_a_document_meet_the_frequencies(spark):
    docs = spark.createDataFrame([(i, " ".join(f"c{j}x" for j in range(200)) + f" rare{i}a rare{i}b") for i in range(30)], "doc_id int, text string")
    cfg = replace(CFG, desc_generic_ratio=None)
    tf = plans.description_terms(docs, "doc_id", cfg)
    df = terms.document_frequency(tf, "doc_id")
    often = df.filter("df > 1")
    assert terms.candidates(tf, often, 1, 30, cfg, "doc_id", 2).count() < tf.count() / 10


def test_top_is_read_from_what_was_written_once(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"alpha beta w{i}a. w{i}b alpha beta gamma") for i in range(40)], "doc_id int, text string")
    before = spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)
    got = plans.description_top(docs, "doc_id", CFG, 3, f"file://{tmp_path}/work")
    assert sorted(p.name for p in (tmp_path / "work").iterdir() if not p.name.startswith(".")) == ["top"]
    shown = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shown and "Aggregate" not in shown
    assert got.count() == 120 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == before


def test_known_scores_leave_fewer_terms_to_rank(spark):
    # a phrase of one document may be one of two as long as its frequency isn't known
    docs = spark.createDataFrame([(i, f"shared rare shared rare lone{i}x. " + " ".join(f"u{i}v{j} and" for j in range(3)) + f" q{i}a q{i}b q{i}c q{i}d q{i}e") for i in range(40)], "doc_id int, text string")
    tf = plans.description_terms(docs, "doc_id", CFG)
    df = terms.document_frequency(tf, "doc_id")
    some = terms.candidates(tf, df.limit(0), 40, 40, CFG, "doc_id", 2)
    scored = terms.tfidf(some, df, 40, CFG)
    left = terms.reaching(scored, CFG)
    assert left.columns == [c for c in scored.columns if c != "floor"]
    assert left.count() < scored.count()
    shown = lambda d: sorted(map(str, terms.top_k(terms.ensure_phrases(d, "doc_id", CFG), "doc_id", 2).select("doc_id", "rank", "term", "score").collect()))
    assert shown(left) == shown(terms.tfidf(tf, df, 40, CFG))


@pytest.mark.parametrize("cfg", [CFG, replace(CFG, desc_generic_phrase_ratio=0.5), replace(CFG, min_df_bigram=3, min_df_trigram=2), replace(CFG, max_ngram=1)])
def test_frequencies_counted_in_steps_are_those_of_all_terms(spark, tmp_path, cfg):
    r = random.Random(3)
    docs = spark.createDataFrame([(i % 70 or None, " ".join(f"w{int(r.paretovariate(0.7)) % 90}" + r.choice(["", ".", " the"]) for _ in range(25))) for i in range(80)], "doc_id int, text string")
    every = {x.term: x.df for x in terms.document_frequency(plans.description_terms(docs, "doc_id", cfg), "doc_id").collect()}
    got = plans.description_frequencies(docs, "doc_id", cfg, f"file://{tmp_path}/df", parts=7, steps=3).collect()
    least = min(cfg.min_df_bigram, cfg.min_df_trigram) if cfg.desc_generic_phrase_ratio is None else 1
    assert len(got) == len({x.term for x in got})
    assert {x.term: x.df for x in got} == {t: n for t, n in every.items() if " " not in t or n >= least}


def test_phrases_of_one_document_do_not_meet_the_frequencies(spark):
    docs = spark.createDataFrame([(i, " ".join(f"c{j}x" for j in range(60)) + " . " + " ".join(f"q{i}v{j}" for j in range(60))) for i in range(30)], "doc_id int, text string")
    cfg = replace(CFG, desc_generic_ratio=None)
    tf = plans.description_terms(docs, "doc_id", cfg)
    df = terms.document_frequency(tf, "doc_id")
    often, kept = df.filter("df > 1 and term not like '% %'"), df.filter("df > 1 and term like '% %'")
    # every document's 60 words of its own have the largest scores for sure; a phrase of its own might have a larger one if it were in two
    plain = terms.candidates(tf, often, 1, 30, cfg, "doc_id", 25)
    few = terms.candidates(tf, often, 1, 30, cfg, "doc_id", 25, (bloom.of(kept, "term", 16), 16))
    own = "n > 1 and term like 'q%'"
    assert plain.filter(own).count() == 30 * (59 + 58) and few.filter(own).count() < 30
    assert few.filter("n = 1").count() == plain.filter("n = 1").count()


def test_bloom_filters_lose_no_value(spark):
    held = spark.range(3000).selectExpr("concat('v', id) v")
    bits = bloom.bits_for(3000)
    asked = spark.range(9000).selectExpr("concat('v', id) v").union(spark.createDataFrame([(None,)], "v string"))
    got = {r.v for r in bloom.marked(asked, "v", bloom.of(held, "v", bits), bits, "may").filter("may").collect()}
    assert {f"v{i}" for i in range(3000)} <= got and len(got) < 3300
    assert bloom.bits_for(10**12) == bloom.MOST and bloom.marked(asked, "v", bloom.of(held.limit(0), "v", 10), 10, "may").filter("may").count() == 0


def test_a_filter_of_subjects_is_looked_up_by_place(spark):
    words = subjects.bloom(spark.createDataFrame([("a b",)], "s string"), "s", 12).first().words
    assert isinstance(words, list) and len(words) == (1 << 12) // 64 and 1 <= sum(bin(w & (1 << 64) - 1).count("1") for w in words) <= bloom.HASHES


def test_words_dealt_out_once_are_counted_without_another_shuffle_of_texts(spark, tmp_path):
    docs = spark.createDataFrame([(i % 9 or None, f"alpha beta w{i}a. w{i % 4}b alpha beta gamma") for i in range(40)], "doc_id int, text string")
    store = storage.Store(spark, f"file://{tmp_path}/work")
    with storage.dealt(plans.description_words(docs, "doc_id", CFG), "doc_id", 4, store, "words") as words:
        got = plans.description_terms(docs, "doc_id", CFG, words=words)
        assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString()
        assert sorted(map(str, got.collect())) == sorted(map(str, plans.description_terms(docs, "doc_id", CFG).collect()))
    assert not store.exists("words") and not [t for t in spark.catalog.listTables() if t.name.startswith("kwloom_")]


def test_most_frequent_terms_are_all_or_none_of_a_frequency(spark):
    df = spark.createDataFrame([("a", 9), ("b", 4), ("c", 4), ("d", 1)], "term string, df bigint")
    shown = [(sorted(r.term for r in often.collect()), most) for often, most in (terms.most_frequent(df, n) for n in (0, 1, 2, 3, 4, 9))]
    assert shown == [([], 9), (["a"], 4), (["a"], 4), (["a", "b", "c"], 1), (["a", "b", "c", "d"], 1), (["a", "b", "c", "d"], 1)]
    assert terms.most_frequent(df.limit(0), 3)[1] == 1


@pytest.mark.parametrize("texts", [[], [None, "", "the of"]])
def test_top_of_documents_without_terms_is_empty(spark, tmp_path, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    got = plans.description_top(docs, "doc_id", CFG, 3, f"file://{tmp_path}/work")
    assert got.collect() == [] and sorted(got.columns) == sorted(["doc_id", "rank", "term", "n", "tf", "pos", "df", "score"])
