import random
import re
from itertools import permutations

from kwloom.llm import filters

from .fixtures import docs, none

LABELS = "doc_id bigint, quality int, toxic int"
SCHEMA = "doc_id bigint, text string, source string, A string"


def flags(rows):
    least = {}
    for i, t, _, _ in rows:
        if i is not None:
            least[t or ""] = min(least.get(t or "", i), i)
    out = []
    for i, t, _, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        first = least.get(t)
        copy = first is not None and (i is None or i > first)
        out.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 2 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": copy})
    return out


def brute(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, x in labels if x == 1}
    parts = {}
    for row, f in zip(rows, flags(rows), strict=True):
        parts.setdefault(row[2] or "", []).append((row[0], f))
    out = []
    for part, mine in parts.items():
        lines, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [x for x in left if x[1][f]]
                stay = [x for x in left if not x[1][f]]
                shapley[f] += len(gone)
                lines.append((f, (part, "".join(order), k + 1, len(stay), len(gone), sum(x[1][f] for x in mine) - len(gone), sum(x[1][f] and sum(x[1].values()) == 1 for x in mine), sum(x[0] in good for x in gone if x[0] is not None), sum(x[0] in toxic for x in gone if x[0] is not None))))
                left = stay
        out += [(*line, shapley[f]) for f, line in lines]
    return sorted(out)


def check(spark, rows, labels):
    got = filters.audit(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, LABELS))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, labels)


def test_audit_matches_brute_force(spark):
    r = random.Random(6)
    rows = []
    for i in range(150):
        n = r.choice([0, 1, 5, 199, 200, 201, 400])
        words = [r.choice(["a", "B", "thing", "é", "x#y"] if r.random() < 0.3 else [f"w{k}" for k in range(500)]) for _ in range(n)]
        rows.append((i, r.choice([" ", "\n", "\x0b ", "　"]).join(words), r.choice(["one", "two", "", None]), "clash"))
    rows += [(i + 200, r.choice(rows[:100])[1], "two", "") for i in range(60)]
    rows += [(None, rows[3][1], "one", ""), (None, "lonely", "one", ""), (None, "lonely", "three", ""), (500, None, "one", ""), (501, "", None, ""), rows[7], rows[7], (7, "another", "one", ""), (3, "x", "nobody's", "")]
    labels = [(i, r.choice([0, 1, None]), r.choice([0, 1, None])) for i in range(120)] + [(7, 1, 1), (None, 1, 1), (9999, 1, 1)]
    check(spark, rows, labels)


def test_a_part_that_nothing_survives_and_long_texts(spark):
    check(spark, [(1, "AB#", "x", ""), (2, "AB#", "x", ""), (3, " ".join(f"w{i}" for i in range(90_000)), "y", ""), (4, "same " * 90_000, "y", "")], [(1, 1, 0), (2, 1, 1)])


def test_many_copies_and_empty_tables(spark):
    d = spark.range(20_000).selectExpr("id doc_id", "'copy' text", "if(id % 3 = 0, 'a', 'b') source")
    labels = spark.createDataFrame([(0, 1, 1), (5, 1, 0)], LABELS)
    got = {(x.part, x.filter_order, x.step): x for x in filters.audit(d, labels).collect()}
    assert len(got) == 1200 and got["a", "EABCD", 1].removed == 6666 and got["b", "EABCD", 1].kept == 0 and got["b", "EABCD", 1].good_lost == 1 and got["a", "EABCD", 2].toxic_lost == 1
    assert filters.audit(none(spark), labels).count() == 0
    assert filters.audit(docs(spark), labels.limit(0)).count() == 600
