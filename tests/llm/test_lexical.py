import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from kwloom.llm import lexical

from .fixtures import docs, documents, none

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = {c: c + 32 for c in range(65, 91)}


def terms(text):
    return TERM.findall((text or "").translate(LOW))


def brute(documents, bench, best=50):
    held = [(i, Counter(terms(t))) for i, t in documents]
    held = [(i, c) for i, c in held if c]
    documents, total = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    items = {}
    for item, text in bench:
        items.setdefault(item, set()).update(terms(text))
    out = []
    for item, asked in items.items():
        scored = []
        for i, c in held:
            m = 100 - 50 + (50 * c.total() * documents) // total
            score = sum(math.floor(1000 * math.log((2 * documents + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m)) for t in asked if c[t])
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, k + 1, x[3], -x[0]) for k, x in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def found(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("best", "pairs"), [(50, 1 << 18), (3, 8)])
def test_search_matches_brute_force(spark, best, pairs):
    r = random.Random(3)
    odd = [(None, "the thing of the word"), (None, "word word"), (70, "MIT License " * 30_000)]
    bench = [(i, " ".join(r.choice(["The", "of", "thing", "idiot", "LICENSE", "Über", "año", "x1", "zzz", "42", "word"]) for _ in range(r.randint(1, 12)))) for i in range(20)]
    bench += [(3, "more license foo"), (None, "word thing"), (90, None), (91, "!!"), (92, "nowhere"), bench[5]]
    rows = [(x[0], x[1]) for x in documents()] + odd
    d = docs(spark).select("doc_id", "text").unionByName(spark.createDataFrame(odd, "doc_id bigint, text string"))
    b = spark.createDataFrame([(*x, "clash") for x in bench], "item_id bigint, text string, score string")
    assert found(lexical.search(d.repartition(6), b, best, pairs)) == brute(rows, bench, best)


def test_empty_tables(spark):
    b = spark.createDataFrame([("a", "the thing")], "item_id string, text string")
    assert lexical.search(none(spark), b).count() == 0
    assert lexical.search(docs(spark), b.limit(0)).count() == 0
    assert lexical.search(docs(spark), b.selectExpr("item_id", "'??' text")).count() == 0


def test_copies_of_one_text_tie_by_id(spark):
    d = spark.range(3000).selectExpr("id doc_id", "'the same thing' text")
    got = found(lexical.search(d.repartition(8), spark.createDataFrame([(1, "thing")], "item_id int, text string")))
    want = brute([(i, "the same thing") for i in range(3000)], [(1, "thing")])
    assert got == want and len(got) in (0, 50)


def test_radix_order():
    r = np.random.default_rng(1)
    for high in (1, 5, 1 << 16, 1 << 20, 1 << 40):
        keys = r.integers(0, high, 3000, dtype=np.uint64)
        assert lexical.radix_order(keys).tolist() == np.argsort(keys, kind="stable").tolist()
    assert lexical.radix_order(np.zeros(0, np.uint64)).tolist() == []


def test_lengths_beyond_64_bits():
    n = np.array([10**9, 3], np.int64)
    assert lexical._lengths(n, 10**10, 10**13).tolist() == [50 + 50 * x * 10**10 // 10**13 for x in (10**9, 3)]
