"""Filter interaction audit: what each of five filters removes in every order that they can stand in.

A document has a flag for each filter that it fails. CUBE over the flags and the part gives, for each set of filters, a row whose flags
are all false: the survivors of that set, whatever the order within it. A step of an order goes from the survivors of one set to those of
the set with one filter more, so all measures of all orders are differences between pairs of such rows.

A document's flags are computed once, from its whole text. A text is one for which a smaller doc_id has the same: texts are compared by
SHA-256 and counted by (text, part, labels) before any of them meet, so a text with very many copies makes few rows.

Cases: a null text is the empty one, a null source the empty string; a null doc_id counts as greater than all, has no labels, and shares
its text's fate as any other; repeated rows are counted each, and are not copies of each other; a doc_id labelled twice has each label
that any of its rows has; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

FILTERS = "ABCDE"
_ALL = (1 << len(FILTERS)) - 1

_SPACE = r"[\x20\x09-\x0D]+"


def flagged(docs: DataFrame) -> DataFrame:
    """doc_id, part, text_sha256 and the flags A to D of docs(doc_id, text, source)."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, _SPACE), lambda w: w != "")
    rows = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text")).select(
        "doc_id", "part", F.unhex(F.sha2("text", 256)).alias("text_sha256"), words.alias("words"),
        F.regexp_count("text", F.lit("[A-Z]")).alias("capitals"), F.length("text").alias("points"), F.col("text").rlike("[#$%&*|]").alias("D"),
    )
    rows = rows.withColumn("n", F.size("words")).withColumn("kinds", F.size(F.array_distinct("words")))
    return rows.select("doc_id", "part", "text_sha256", (F.col("n") < 200).alias("A"), (100 * F.col("kinds").cast("long") < 50 * F.col("n").cast("long")).alias("B"), (100 * F.col("capitals").cast("long") > 2 * F.col("points").cast("long")).alias("C"), "D")


def counted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, A to E, good and toxic (booleans) and n, the documents with these: a few rows a part."""
    rows = flagged(docs).groupBy("doc_id", "part", "text_sha256", "A", "B", "C", "D").agg(F.count("*").alias("n"))
    marks = labels.groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    mark = lambda c: F.coalesce(c, F.lit(False)).alias(c)
    known = rows.filter("doc_id is not null").join(marks, "doc_id", "left").select(*rows.columns, mark("good"), mark("toxic"))
    rows = known.unionByName(rows.filter("doc_id is null").select("*", F.lit(False).alias("good"), F.lit(False).alias("toxic")))
    # of a text: the rows of each part and labels, and how many of them have the smallest doc_id there
    alike = rows.groupBy("text_sha256", "part", "A", "B", "C", "D", "good", "toxic").agg(F.sum("n").alias("n"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "n")).alias("least"))
    first = F.struct("least.none", "least.doc_id")
    alike = alike.withColumn("own", F.min(first).over(Window.partitionBy("text_sha256")).eqNullSafe(first))
    kept = F.when(F.col("own"), F.col("least.n")).otherwise(0)
    both = F.explode(F.array(F.struct(F.lit(False).alias("E"), kept.alias("n")), F.struct(F.lit(True).alias("E"), (F.col("n") - kept).alias("n"))))
    return alike.select("part", "A", "B", "C", "D", "good", "toxic", both.alias("x")).select("part", "A", "B", "C", "D", "x.E", "good", "toxic", "x.n").groupBy("part", *FILTERS, "good", "toxic").agg(F.sum("n").alias("n"))


def survivors(counts: DataFrame) -> DataFrame:
    """part, passed (a set of filters: bit i for the i-th), n, good, toxic: the documents of a part that fail none of the set; all sets, zeros included."""
    cube = counts.cube("part", *FILTERS).agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("good"), F.col("n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("n")).otherwise(0)).alias("toxic"),
        F.grouping("part").alias("all_parts"), *[F.grouping(f).alias(f"any_{f}") for f in FILTERS],
    )
    selected = [F.col(f"any_{f}") == 0 for f in FILTERS]
    passed = sum((F.when(chosen, 1 << i).otherwise(0) for i, chosen in enumerate(selected)), F.lit(0))
    for chosen, f in zip(selected, FILTERS, strict=True):
        cube = cube.filter(~chosen | ~F.col(f))
    found = cube.filter("all_parts = 0").select("part", passed.alias("passed"), "n", "good", "toxic")
    # a set that nothing survives has no row of the cube
    every = found.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit(_ALL))).alias("passed"))
    return every.join(found, ["part", "passed"], "left").na.fill(0, ["n", "good", "toxic"])


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: a row for each part, order and step."""
    spark = docs.sparkSession
    sets = survivors(counted(docs, labels))
    # a step adds one filter to a set: the pairs of sets, 80 of a part
    bit = F.expr("shiftleft(1, filter)")
    before = sets.select("part", F.col("passed").alias("before"), F.col("n").alias("n0"), F.col("good").alias("good0"), F.col("toxic").alias("toxic0"), F.explode(F.array(*[F.lit(i) for i in range(len(FILTERS))])).alias("filter")).filter(F.col("before").bitwiseAND(bit) == 0)
    after = sets.select("part", F.col("passed").alias("after"), F.col("n").alias("n1"), F.col("good").alias("good1"), F.col("toxic").alias("toxic1"))
    pairs = before.withColumn("after", F.col("before").bitwiseOR(bit)).join(after, ["part", "after"])
    removed, mine = F.col("n0") - F.col("n1"), Window.partitionBy("part", "filter")
    orders = F.element_at(F.array(*[F.lit(factorial(k) * factorial(len(FILTERS) - 1 - k)) for k in range(len(FILTERS))]), F.bit_count("before") + 1)
    pairs = pairs.select(
        "before", "filter", "part", F.col("n1").alias("kept"), removed.alias("removed"),
        (F.max(F.when(F.col("before") == 0, removed)).over(mine) - removed).alias("redundant"),
        F.max(F.when(F.col("after") == _ALL, removed)).over(mine).alias("unique_fails"),
        (F.col("good0") - F.col("good1")).alias("good_lost"), (F.col("toxic0") - F.col("toxic1")).alias("toxic_lost"),
        F.sum(removed * orders).over(mine).alias("shapley"),
    )
    steps = []
    for order in permutations(range(len(FILTERS))):
        for k, f in enumerate(order):
            steps.append(("".join(FILTERS[i] for i in order), k + 1, f, sum(1 << i for i in order[:k])))
    # 600 rows whatever the input
    table = spark.createDataFrame(steps, "filter_order string, step int, filter int, before int")
    return pairs.join(F.broadcast(table), ["before", "filter"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


#: The same rows in SQL, by each document's flags and the orders written out step by step.
ORACLE = r"""
with base as (select doc_id, coalesce(source, '') part, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
 marks as (select doc_id, max(case when quality = 1 then 1 else 0 end) good, max(case when toxic = 1 then 1 else 0 end) toxic from labels group by doc_id),
 f as (select b.part, coalesce(m.good, 0) good, coalesce(m.toxic, 0) toxic,
   [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(b.doc_id > min(b.doc_id) over (partition by t), min(b.doc_id) over (partition by t) is not null)] x
   from base b left join marks m on m.doc_id = b.doc_id),
 g as (select part, x, count(*) n, sum(good) good, sum(toxic) toxic from f group by part, x),
 l as (select unnest(['A', 'B', 'C', 'D', 'E']) c, unnest([1, 2, 3, 4, 5]) i),
 o as (select a.c || b.c || c.c || d.c || e.c filter_order, [a.i, b.i, c.i, d.i, e.i] p from l a, l b, l c, l d, l e where len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
 s as (select filter_order, p, unnest([1, 2, 3, 4, 5]) step from o),
 r as (select part, filter_order, step, p[step] i,
   cast(sum(case when len(list_filter(p[1:step], lambda q: x[q])) = 0 then n else 0 end) as bigint) kept,
   cast(sum(case when x[p[step]] and len(list_filter(p[1:step - 1], lambda q: x[q])) = 0 then n else 0 end) as bigint) removed,
   cast(sum(case when x[p[step]] and len(list_filter(p[1:step - 1], lambda q: x[q])) > 0 then n else 0 end) as bigint) redundant,
   cast(sum(case when x[p[step]] and len(list_filter(x, lambda q: q)) = 1 then n else 0 end) as bigint) unique_fails,
   cast(sum(case when x[p[step]] and len(list_filter(p[1:step - 1], lambda q: x[q])) = 0 then good else 0 end) as bigint) good_lost,
   cast(sum(case when x[p[step]] and len(list_filter(p[1:step - 1], lambda q: x[q])) = 0 then toxic else 0 end) as bigint) toxic_lost
   from g, s group by part, filter_order, step, p)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, cast(sum(removed) over (partition by part, i) as bigint) shapley from r
"""
