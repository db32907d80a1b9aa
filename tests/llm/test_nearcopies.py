import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from kwloom.llm import nearcopies, simhash

from .fixtures import docs, none

LOW = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if x]
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def kept_ids(rows):
    """Smallest id of each component over texts with a Jaccard similarity of 0.8 or more; texts without words are alike."""
    root, sets = {i: i for i, _ in rows}, {i: shingles(t) for i, t in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and 9 * len(a & b) >= 4 * (len(a) + len(b)):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return sorted(i for i in root if find(i) == i)


def edited(r, words, n):
    words = list(words)
    for _ in range(n):
        words[r.randrange(len(words))] = f"new{r.randint(0, 10**6)}"
    return words


@pytest.mark.parametrize("sample", [1, 8])
def test_classes_match_brute_force(spark, sample):
    r = random.Random(sample)
    line = [f"line{i}" for i in range(30)]
    rows = []
    for g in range(12):
        whole = [f"w{r.randint(0, 10**6)}" for _ in range(r.randint(3, 150))]
        for _ in range(40 if g == 0 else 8):
            words = edited(r, whole, r.randint(0, 1 + len(whole) // 25))
            rows.append(" ".join(words + line if g % 3 == 0 else words).upper() if r.random() < 0.2 else "  ".join(words + line if g % 3 == 0 else words))
    rows = list(enumerate([*rows, None, "", " \t\n", "one", "One", "a b c d", "a b c d e"]))
    r.shuffle(rows)
    got = nearcopies.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string"), sample).collect()
    assert sorted(x.doc_id for x in got) == kept_ids(rows)


def test_copies_with_a_few_changed_words_are_found(spark):
    r = random.Random(5)
    whole = [f"w{i}" for i in range(100)]
    other = edited(r, whole, 2)
    a, b = (simhash.fingerprint_text(" ".join(x)) for x in (whole, other))
    assert bin(a ^ b).count("1") > simhash.BITS
    df = spark.createDataFrame([(1, " ".join(whole)), (2, " ".join(other)), (3, "something else")], "doc_id bigint, text string")
    assert sorted(x.doc_id for x in nearcopies.keep_one(df, 1).collect()) == [1, 3]


def test_columns_and_empty_table(spark):
    assert nearcopies.keep_one(docs(spark)).columns == docs(spark).columns
    clash = spark.createDataFrame([(1, "a b c", "mine", 5), (2, "a b c", "other", 6), (3, "d", "third", 7)], "doc_id int, text string, _text_key string, _Rows int")
    assert sorted(tuple(r) for r in nearcopies.keep_one(clash).collect()) == [(1, "a b c", "mine", 5), (3, "d", "third", 7)]
    assert nearcopies.keep_one(none(spark)).count() == 0


def test_null_and_shared_ids(spark):
    rows = [(None, "a clean text"), (None, "another clean text"), (7, "two texts"), (7, "of one id"), (7, "of one id"), (None, "x y z"), (3, "X y z"), (None, "null alone"), (None, "null alone")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = sorted(((r.doc_id, r.text) for r in nearcopies.keep_one(df).collect()), key=str)
    want = [(None, "a clean text"), (None, "another clean text"), (7, "two texts"), (7, "of one id"), (3, "X y z"), (None, "null alone")]
    assert kept == sorted(want, key=str)


def family(r, n):
    """Texts of one family, each with two words of its own: most pairs of them are just below the similarity asked for."""
    whole = [f"w{i}" for i in range(100)]
    return [" ".join(edited(r, whole, 2)) for _ in range(n)]


def family_classes(texts):
    """The number of the class of each text, by comparing all pairs as matrices of what is left of the family's shingles."""
    base = [tuple(f"w{i}" for i in range(k, k + 5)) for k in range(96)]
    sets = [shingles(t) for t in texts]
    held = np.array([[b in s for b in base] for s in sets], np.float32)
    sizes = np.array([len(s) for s in sets])
    near = 9 * (held @ held.T) >= 4 * (sizes[:, None] + sizes[None, :])
    root = np.arange(len(texts))
    while True:
        low = np.where(near, root[None, :], len(texts)).min(1)
        low = low[low]
        if (low == root).all():
            return root, int(near.sum() - len(texts)) // 2
        root = low


def test_a_family_below_the_threshold_makes_few_rows(spark):
    """2,000 texts just below the threshold to most of each other: classes are right, and no more pairs become rows than a few a text."""
    texts = family(random.Random(11), 2000)
    root, similar = family_classes(texts)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    kept = sorted(x.doc_id for x in nearcopies.keep_one(df, 1).collect())
    assert kept == sorted(set(root.tolist()))
    keyed = df.select(F.col("doc_id").alias("key"), "text")
    common = nearcopies._common(keyed, 1, nearcopies.COMMON)
    cell = nearcopies._prefixes(keyed, common).groupBy("sh").agg(F.collect_list(F.struct("key", "n", "at")).alias("c"), F.count("*").alias("size"))
    left = cell.orderBy(F.desc("size"), "sh").limit(3).select("sh", "size", F.explode("c").alias("x")).select("sh", "x.*", F.col("x.key").alias("root"), "size")
    pairs = nearcopies._in_blocks(left, keyed, 128).collect()
    sizes = [r["size"] for r in left.select("sh", "size").distinct().collect()]
    every = max(n * (n - 1) // 2 for n in sizes)
    # what comes out are the similar pairs and the few whose sketches hide a difference
    assert max(sizes) > 128 and len(pairs) < 0.25 * every + 10 and len(pairs) <= 3 * similar + 100
    # and all of these that the cells' places allow
    sets, rows = [shingles(t) for t in texts], left.collect()
    found = {(r.a, r.b) for r in pairs}
    for sh in {r.sh for r in rows}:
        mine = [r for r in rows if r.sh == sh]
        for i, x in enumerate(mine):
            for y in mine[i + 1 :]:
                if 9 * min(x.n - x.at, y.n - y.at) >= 4 * (x.n + y.n) and 9 * len(sets[x.key] & sets[y.key]) >= 4 * (x.n + y.n):
                    assert (min(x.key, y.key), max(x.key, y.key)) in found


def test_the_stage_takes_copies_by_fingerprint_too(spark):
    # what repeats decides the fingerprint, what doesn't the sets
    base = "one two three four five " * 200
    rows = [(i, base + " ".join(f"t{i}w{j}" for j in range(40))) for i in (4, 2, 7)] + [(1, "a text of its own that nothing is like at all"), (5, base + "and a tail " * 3)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r.component_id for r in simhash.near_duplicates(df.filter("doc_id <> 1")).collect()} == {2}
    assert set(kept_ids(rows)) == {i for i, _ in rows}
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, df, "").collect()) == [1, 2]
