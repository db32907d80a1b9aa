"""Scores and cuts that decide the order of rows as the SQL does."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from kwloom.config import KeywordConfig
from kwloom.functions import scores, text
from kwloom.operators import segment, terms
from kwloom.plans import keywords as plans


def test_weights_are_those_of_the_c_library(spark):
    n, power = 9688, 0.85
    df = spark.range(1, 3000).select(F.col("id").alias("df"))
    want = {x: math.pow(math.log((1.0 + n) / (1.0 + x)) + 1.0, power) for x in range(1, 3000)}
    got = df.select("df", scores.damped_idf(F.col("df"), F.lit(n), power).alias("w"), scores.damped(scores.idf(F.col("df"), F.lit(n)), power).alias("jvm")).collect()
    assert {x.df: x.w for x in got} == want
    # the case is a real one: the JVM's functions give other bits for some
    assert any(x.jvm != x.w for x in got)


def test_scores_of_equal_terms_are_ordered_by_these_weights(spark):
    cfg, n = KeywordConfig(desc_generic_ratio=None), 9688
    tf = spark.createDataFrame([(d, t, k, c, 1) for d in range(2, 200) for t, k, c in ((f"a{d} b", 2, 7), (f"a{d} b c", 3, 6))], "doc_id int, term string, n int, tf int, pos int")
    df = tf.select("term", F.col("doc_id").alias("df"))
    weight = lambda d: math.pow(math.log((1.0 + n) / (1.0 + d)) + 1.0, cfg.desc_idf_power)
    got = {(x.doc_id, x.n): x.score for x in terms.tfidf(tf, df, n, cfg).collect()}
    assert got == {(d, k): c * weight(d) * b for d in range(2, 200) for k, c, b in ((2, 7, 1.2), (3, 6, 1.4))}


def test_names_cut_by_counts_alone_stay_whole_where_the_cheapest_cut_is(spark):
    names = spark.createDataFrame([(1, "andthwhinha"), (2, "southernfood")], "doc_id int, name string")
    counts = segment.word_counts(spark.createDataFrame([(w,) for w in ["southern", "food"] * 50], "word string"))
    rows = plans.name_phrases(names, "doc_id", counts, by_look=False).collect()
    assert {x.doc_id: x.phrase for x in rows} == {1: "andthwhinha", 2: "southern food"}
    assert {x.doc_id: x.phrase for x in plans.name_phrases(names, "doc_id", counts).collect()}[1] != "andthwhinha"


def test_a_capital_is_one_letter(spark):
    terms_ = ["ßach enauen", "ébene", "ﬁn de", "ᾳ x", "ŉ x", "ǆ x", "Already", "9 lives", "", "a" * 1500]
    rows = spark.createDataFrame([(t,) for t in terms_], "t string").select("t", text.capitalised(F.col("t")).alias("shown")).collect()
    assert {x.t: x.shown for x in rows} == dict(zip(terms_, ["ẞach enauen", "Ébene", "ﬁn de", "ᾼ x", "ŉ x", "Ǆ x", "Already", "9 lives", "", "A" + "a" * 1499], strict=True))
