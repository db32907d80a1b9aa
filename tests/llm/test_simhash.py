from collections import defaultdict

import numpy as np
import xxhash

from kwloom.llm import simhash

from .fixtures import docs, documents, none

LOW = {c: c + 32 for c in range(65, 91)}


def fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", (text or "").translate(LOW)) if w]
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(pairs):
    """Smallest id reachable over fingerprints at most four bits apart, of (id, fingerprint) pairs."""
    root = {i: i for i, _ in pairs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in pairs:
        for j, b in pairs:
            if bin(a ^ b).count("1") <= 4:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: find(i) for i, _ in pairs}


def test_fingerprints_and_classes_match_brute_force(spark):
    got = simhash.near_duplicates(docs(spark)).collect()
    rows = documents()
    fp = {r[0]: fingerprint(r[1]) for r in rows}
    assert len(got) == len(rows)
    assert {(r.doc_id, r.fingerprint) for r in got} == {(i, f"{f:016x}") for i, f in fp.items()}
    assert {r.doc_id: r.component_id for r in got} == classes(list(fp.items()))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def test_links_find_every_close_pair_and_hot_cells_give_the_same_classes(spark):
    rng = np.random.default_rng(0)
    fps = []
    for _ in range(12):
        seed = int(rng.integers(0, 1 << 63)) * 2 + 1
        for _ in range(20):
            flip = 0
            for b in rng.choice(64, int(rng.integers(0, 7)), replace=False):
                flip |= 1 << int(b)
            fps.append(seed ^ flip)
    fps = sorted(set(fps))
    want = {(a, b) for a in fps for b in fps if signed(a) < signed(b) and bin(a ^ b).count("1") <= 4}
    df = spark.createDataFrame([(signed(f),) for f in fps], "fp bigint")
    got = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(df).collect()]
    assert set(got) == want
    expected = classes(list(enumerate(fps)))
    for hot in (512, 3):
        roots = {r.node: r.root for r in simhash.components(simhash.links(df, hot)).collect()}
        groups = defaultdict(set)
        for i, f in enumerate(fps):
            groups[roots.get(signed(f), signed(f))].add(i)
        assert sorted(map(sorted, groups.values())) == sorted(sorted(i for i in expected if expected[i] == c) for c in set(expected.values()))


def test_components_of_a_long_path_and_of_nothing(spark):
    n = 200
    path = spark.createDataFrame([(i, i + 1) for i in range(n)], "a bigint, b bigint")
    assert {r.root for r in simhash.components(path).collect()} == {0}
    assert simhash.components(path.limit(0)).count() == 0


def test_null_ids_and_empty_table(spark):
    rows = [(None, "alone in its class"), (None, "alone in its class"), (None, "the very same"), (5, "the very same"), (3, "the very same"), (9, "of its own " * 30_000), (None, None), (8, "")]
    got = sorted(((r.doc_id, r.fingerprint, r.component_id) for r in simhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()), key=str)
    want = [(i, f"{fingerprint(t):016x}", {"alone in its class": None, "the very same": 3}.get(t, 9 if i == 9 else 8)) for i, t in rows]
    assert got == sorted(want, key=str)
    assert simhash.near_duplicates(none(spark)).count() == 0


def test_components_of_stars_take_no_round(spark, monkeypatch):
    steps = []
    whole = simhash.cut
    monkeypatch.setattr(simhash, "cut", lambda df: steps.append(1) or whole(df))
    edges = spark.createDataFrame([(1, 2), (1, 3), (5, 4), (7, 7), (1, 2)], "a long, b long")
    assert {(x.node, x.root) for x in simhash.components(edges).collect()} == {(2, 1), (3, 1), (5, 4)}
    assert len(steps) == 1
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {(x.node, x.root) for x in simhash.components(chain).collect()} == {(i, 0) for i in range(1, 41)}
    assert simhash.components(chain.limit(0)).count() == 0


def test_exploded_rows_are_not_broadcast(spark):
    # 2,000 fingerprints are small enough to broadcast, and Spark takes what they are exploded to for as small
    fps = spark.range(2000).selectExpr("id as fp")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        for joined in (simhash._in_cells(fps), simhash._midpoints(fps.limit(20))):
            joined.collect()
            shown = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in shown and "Broadcast" not in shown
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
