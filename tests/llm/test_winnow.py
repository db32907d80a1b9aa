import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from kwloom.llm import winnow

from .fixtures import docs, documents, none

LOW = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").translate(LOW))


def brute(doc, bench):
    w = words(doc)
    hit, items = set(), set()
    for item, text in bench:
        x = words(text)
        n = min(10, len(x))
        windows = {tuple(x[i : i + n]) for i in range(len(x) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in windows:
                hit |= set(range(i, i + n))
                items.add(item)
    return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(str(x) for x in items if x is not None)).encode()).hexdigest(), bool(hit)


def check(spark, documents, bench):
    d = spark.createDataFrame(documents, "doc_id bigint, text string")
    b = spark.createDataFrame(bench, "item_id bigint, text string")
    got = sorted(tuple(r) for r in winnow.contamination(d, b).collect())
    assert got == sorted((i, *brute(t, bench)) for i, t in documents)


@pytest.mark.parametrize("seed", range(3))
def test_hits_match_brute_force(spark, seed):
    r = random.Random(seed)
    some = ["a", "b", "c", "é"] if seed else [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(r.choice(some) for _ in range(n))
    bench = [(i, text(n)) for i, n in enumerate([0, 1, 2, 4, 5, 6, 9, 10, 11, 25, 40, 40])]
    if seed == 0:
        bench = [*bench[6:], (99, "only five words are here"), (100, None), (101, ""), (10, bench[10][1]), (None, bench[9][1]), (None, bench[11][1]), (None, text(12))]
    docs = []
    for i in range(40):
        t = text(r.randint(0, 60))
        if r.random() < 0.6:
            x = (r.choice(bench)[1] or "").split()
            a = r.randint(0, max(0, len(x) - 1))
            t += ", " + " ".join(x[a : a + r.randint(1, 30)]).upper() + "! " + text(r.randint(0, 9))
        docs.append((i, t))
    check(spark, [*docs, docs[0], docs[1], (77, None), (78, ""), (79, "only five words are here and only five words are here")], bench)


def test_items_without_an_id_hit_words_too(spark):
    bench = [(None, " ".join("abcdefghijkl")), (None, "x y z"), (3, "x y z")]
    check(spark, [(1, " ".join("zabcdefghijklm")), (2, "q x y z q " * 20_000), (3, "nothing")], bench)
    lost = spark.createDataFrame([(None, bench[0][1]), (None, "clean")], "doc_id bigint, text string")
    got = winnow.contamination(lost, spark.createDataFrame(bench, "item_id bigint, text string")).collect()
    assert sorted((r.n_words, r.n_hit, r.n_items) for r in got) == [(1, 0, 0), (12, 12, 1)]


def test_empty_tables(spark):
    b = spark.createDataFrame([(1, " ".join("abcdefghijkl"))], "item_id bigint, text string")
    assert winnow.contamination(none(spark), b).count() == 0
    assert winnow.contamination(docs(spark), b.limit(0)).filter("contaminated").count() == 0
    assert winnow.decontaminated(docs(spark), b).count() == len(documents())


def test_rows_are_dropped_by_their_own_text(spark):
    passage = " ".join("abcdefghijkl")
    b = spark.createDataFrame([(1, passage)], "item_id bigint, text string")
    d = spark.createDataFrame([(None, passage), (None, "clean"), (1, passage + " x"), (1, "clean too"), (2, None)], "doc_id bigint, text string")
    kept = {(r.doc_id, r.text) for r in winnow.decontaminated(d, b).collect()}
    assert kept == {(None, "clean"), (1, "clean too"), (2, None)}
    own = winnow.decontaminated(d.withColumn("_hit_text", F.lit(1)), b)
    assert own.columns == ["doc_id", "text", "_hit_text"] and own.count() == 3
