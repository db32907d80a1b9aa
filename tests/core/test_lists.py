"""Word segmentation, name scores, word lists and redundancy against plain forms."""

import itertools
import math
import random

import pytest

from kwloom.config import KeywordConfig
from kwloom.functions import text
from kwloom.operators import measures, redundancy, segment, terms, wordlists
from kwloom.plans import keywords as plans


def brute_cut(word, counts, piece):
    """The cheapest of all cuts of a word, by trying each."""
    every = sum(counts.values())
    half = lambda x: math.floor(x + 0.5)
    best = None
    for marks in itertools.product([0, 1], repeat=len(word) - 1):
        parts, at = [], 0
        for i, m in enumerate(marks, 1):
            if m:
                parts.append(word[at:i])
                at = i
        parts.append(word[at:])
        if max(map(len, parts)) > piece:
            continue
        cost = sum(half(segment.UNIT * (math.log(every) - math.log(counts[p]))) if p in counts else half(segment.UNIT * (math.log(every) + (len(p) - 1) * math.log(10))) for p in parts)
        # of equal cuts fewer words, then longer words from the last on
        rank = (cost, len(parts), [-len(p) for p in reversed(parts)])
        if best is None or rank < best[0]:
            best = rank, parts
    return best[1]


def test_cuts_match_all_cuts(spark, monkeypatch):
    r = random.Random(5)
    vocabulary = ["a", "an", "ana", "in", "ing", "the", "then", "hen", "food", "southern", "south", "ern", "er", "n", "ran", "gers"]
    tokens = [w for w in vocabulary for _ in range(r.randint(1, 60))]
    counts = {w: tokens.count(w) for w in vocabulary}
    glued = {"".join(r.choice(vocabulary) for _ in range(r.randint(2, 5)))[:13] for _ in range(60)} | {"southernfood", "qqqqqqqqqqqq", "theqqfood", "aaaaaaaaaaaa"}
    glued = {g for g in glued if len(g) >= 9}
    monkeypatch.setattr(segment, "PIECE", 10)
    df = spark.createDataFrame([(g,) for g in glued] * 2 + [(None,), ("short",), ("Upperwords",), ("x" * 200,)], "word string")
    found = segment.word_counts(spark.createDataFrame([(t,) for t in [*tokens, "É", "A1", None]], "word string"))
    got = {x.word: x.parts for x in segment.cuts(df, found).collect()}
    assert {g: segment.cheapest(g, {(i, n): segment._round(segment.UNIT * (math.log(len(tokens)) - math.log(counts[g[i : i + n]]))) for i in range(len(g)) for n in range(1, 11) if g[i : i + n] in counts}, len(tokens), 10) for g in glued} == {g: brute_cut(g, counts, 10) for g in glued}
    monkeypatch.undo()
    got = {x.word: x.parts for x in segment.cuts(df, found).collect()}
    assert set(got) == glued and got == {g: brute_cut(g, counts, 24) for g in glued}
    whole = {x.word: x.parts for x in segment.segmented(df, found).collect()}
    assert whole["southernfood"] == ["southern", "food"] and whole["short"] == ["short"] and whole["Upperwords"] == ["Upperwords"] and whole["x" * 200] == text.segment("x" * 200)
    assert whole["qqqqqqqqqqqq"] == text.segment("qqqqqqqqqqqq")


def test_words_without_counts_are_cut_by_their_look(spark):
    words = ["southernfood", "rangersfc", "glutenfree", "abc", None]
    df = spark.createDataFrame([(w,) for w in words], "word string")
    want = {w: text.segment(w) if len(w) > 8 else [w] for w in words if w}
    assert {x.word: x.parts for x in segment.segmented(df).collect()} == want
    empty = segment.word_counts(df.limit(0))
    assert segment.cuts(df, empty).count() == 0
    assert {x.word: x.parts for x in segment.segmented(df, empty).collect()} == want


def test_name_scores_by_hand(spark):
    """Rows written by hand from the rules: the whole name, stopwords and all, gets its weight once more, a name of one word too."""
    names = spark.createDataFrame([(1, "r/Lord_of_the_Rings_Memes"), (2, "r/Cooking"), (3, "r/MLOps"), (4, "r/the"), (5, "r/OilChange/"), (6, None), (7, "r/southernfood"), (8, "")], "doc int, name string")
    counts = spark.createDataFrame([("southern", 50), ("food", 50), ("the", 500)], "word string, n long")
    cfg = KeywordConfig()
    got = {(r.doc, r.term): r.score for r in terms.name_scores(plans.name_terms(names, "doc", cfg, counts), plans.name_phrases(names, "doc", counts), "doc").collect()}
    assert {k[1]: v for k, v in got.items() if k[0] == 1} == {"lord rings memes": 2.5, "lord": 1.0, "rings": 1.0, "memes": 1.0, "lord rings": 1.5, "rings memes": 1.5, "lord of the rings memes": 2.5}
    assert {k[1]: v for k, v in got.items() if k[0] == 2} == {"cooking": 2.0}
    assert {k[1]: v for k, v in got.items() if k[0] == 3} == {"ml ops": 3.0, "ml": 1.0, "ops": 1.0, "machine learning": 1.5}
    assert {k[1]: v for k, v in got.items() if k[0] == 4} == {"the": 1.0}
    assert {k[1]: v for k, v in got.items() if k[0] == 5} == {"oil change": 3.0, "oil": 1.0, "change": 1.0}
    assert {k[1]: v for k, v in got.items() if k[0] == 7} == {"southern food": 3.0, "southern": 1.0, "food": 1.0}
    assert not [k for k in got if k[0] in (6, 8)]


def test_automaton_finds_what_contains_finds(spark):
    r = random.Random(2)
    lists = {"a": ["th", "hing", "thing"], "b": ["in", "THE"], "c": [], **measures.LOW_VALUE}
    values = ["".join(r.choice("thinge s") for _ in range(r.randint(0, 30))) for _ in range(200)] + ["just things", "Much THE", None, ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, *values[:5]])], "i int, term string")
    got = {x.term: [tuple(h) for h in x.hits] for x in wordlists.hits(df, "term", lists).collect()}
    want = {v: sorted({(name, w) for name, ws in lists.items() for w in ws if w.lower() in v.lower()}) for v in values if v}
    assert got == {v: h for v, h in want.items() if h}
    rows = wordlists.listed(df, "term", lists).collect()
    assert len(rows) == len(values) + 5 and all(x.lists == sorted({n for n, _ in want.get(x.term, [])}) for x in rows)
    # the same leaks as the chain of contains
    k = df.selectExpr("i doc", "1 rank", "term", "1.0D score", "'posts' source")
    chain = {(x.category, x.leak, x.term) for x in measures.leaks(k, [], []).collect()}
    mine = {(h.list, h.word, x.term) for x in wordlists.hits(df, "term", measures.LOW_VALUE).collect() for h in x.hits}
    assert chain == mine and chain


def test_context_findings_by_hand(spark):
    k = spark.createDataFrame(
        [(1, 1, "hollow knight art", "posts"), (1, 2, "world news today", "posts"), (1, 16, "steam sale", "posts"), (2, 1, "Steam deck oil", "posts_composed"), (2, 2, "nintendo", "posts_composed"),
         (2, 3, "game city happy pizza", "posts_composed"), (2, 4, "game in city happy pizza", "posts_composed"), (2, 5, "game city happy", "posts_composed"), (3, 1, "askreddit youtube video clips", "posts_composed")],
        "doc int, rank int, term string, source string")
    names = spark.createDataFrame([(1, "r/WorldEvents"), (2, "r/cooking"), (3, None)], "doc int, name string")
    assert sorted(tuple(r) for r in wordlists.mismatches(k, names, "doc").collect()) == [(1, 1, "hollow knight art", "gaming"), (2, 1, "Steam deck oil", "gaming"), (2, 2, "nintendo", "gaming")]
    assert sorted(tuple(r) for r in wordlists.brand_misuse(k, names, "doc").collect()) == [(2, 1, "Steam deck oil", "steam"), (3, 1, "askreddit youtube video clips", "youtube")]
    # pieces of words count: "happy" holds "app"
    assert [(r.doc, r.rank, r.lists) for r in wordlists.fragmented(k, "doc").collect()] == [(2, 3, ["emotion", "entertainment", "food", "location", "technology"])]


def greedy(listed, kind):
    """Groups as nested loops make them: each term not yet taken gathers the later ones that are like it."""
    import re

    def like(a, b):
        x, y = a.split(), b.split()
        low = lambda t: set(t.lower().split())
        share = len(low(a) & low(b)) / len(low(a) | low(b)) if low(a) | low(b) else 0
        prefixed = len(x) > 1 and len(y) > 1 and (x[1:] == y or x == y[1:])
        bare = lambda t: re.sub("[^0-9a-z]", "", t.lower())
        return {"spacing": re.sub(r"\s", "", a.lower()) == re.sub(r"\s", "", b.lower()), "overlap": share >= 0.7, "prefix": prefixed, "variant": bare(a) == bare(b) or share >= 0.8 or prefixed}[kind]

    taken, out = set(), []
    for i, a in enumerate(listed):
        if i in taken:
            continue
        group = [i]
        for j in range(i + 1, len(listed)):
            if j not in taken and like(a, listed[j]):
                group.append(j)
                taken.add(j)
        out.append(group)
    return out


@pytest.fixture(scope="module")
def ranked():
    r = random.Random(7)
    rows = []
    for doc in range(30):
        seen, rank = set(), 0
        for _ in range(40):
            t = " ".join(r.choice(["a", "b", "A", "c", "dd", "x"]) for _ in range(r.randint(1, 4)))
            t = t.replace(" ", "") if r.random() < 0.15 else t
            if t not in seen:
                seen.add(t)
                rank += 1
                rows.append((doc, rank, t, round(50 / rank + r.random(), 3), r.choice(["posts", "posts_composed", "name+posts"])))
    return rows


@pytest.mark.parametrize("kind", ["spacing", "overlap", "prefix", "variant"])
def test_groups_match_nested_loops(spark, ranked, kind):
    df = spark.createDataFrame(ranked, "doc int, rank int, term string, score double, source string")
    got = sorted(tuple(r) for r in redundancy.groups(df.repartition(5), "doc", kind).collect())
    want = []
    for doc in range(30):
        mine = [x[2] for x in ranked if x[0] == doc and x[1] <= 15]
        want += [(doc, mine[g[0]], j + 1, mine[j]) for g in greedy(mine, kind) if len(g) > 1 for j in g]
    assert got == sorted(want) and want
    assert redundancy.groups(df.limit(0), "doc", kind).count() == 0


def test_best_variants_and_summary(spark, ranked):
    df = spark.createDataFrame(ranked, "doc int, rank int, term string, score double, source string")
    names = spark.createDataFrame([(i, "r/A_b") for i in range(0, 30, 2)], "doc int, name string")
    got = sorted(tuple(r) for r in redundancy.best_variants(df, names, "doc").collect())
    want = []
    for doc in range(30):
        mine = [x for x in ranked if x[0] == doc and x[1] <= 30]
        best = []
        for g in greedy([x[2] for x in mine], "variant"):
            def value(x):
                w = x[2].lower().split()
                official = doc % 2 == 0 and x[2].lower().replace(" ", "") == "ab"
                return x[3] * (0.5 if len(set(w)) < len(w) else 1) * (1.2 if official else 1) * (1.1 if "composed" in x[4] else 1) * (0.9 if len(w) > 6 else 1)

            first = min((mine[j] for j in g), key=lambda x: (-value(x), x[1]))
            best.append((first, len(g)))
        best.sort(key=lambda b: (-b[0][3], b[0][1]))
        want += [(doc, i + 1, b[2], b[3], b[4], n) for i, (b, n) in enumerate(best)]
    assert got == sorted(want)
    counts = {r.kind: (r.documents, r.groups, r.terms) for r in redundancy.summary(df, "doc").collect()}
    for kind in redundancy.KINDS:
        groups = [[g for g in greedy([x[2] for x in ranked if x[0] == doc and x[1] <= 15], kind) if len(g) > 1] for doc in range(30)]
        assert counts[kind] == (sum(map(bool, groups)), sum(map(len, groups)), sum(len(g) for gs in groups for g in gs))


def test_repeated_compositions_match_a_running_set(spark, ranked):
    df = spark.createDataFrame(ranked, "doc int, rank int, term string, score double, source string")
    got = {r.doc: (r.terms, r.place) for r in redundancy.repeated_compositions(df, "doc").collect()}
    want = {}
    for doc in range(30):
        made = [x[2] for x in ranked if x[0] == doc and x[1] <= 10 and "composed" in x[4]]
        seen = set()
        for i, t in enumerate(made if len(made) >= 3 else []):
            words = set(t.lower().split())
            if len(seen & words) >= 2:
                want[doc] = (made[:3], i + 1)
                break
            seen |= words
    assert got == want and want
