"""Ranked lexical search by sort-based accumulation, with integer scores.

Items (the queries) become an index: for each of their terms the items that hold it. A first pass over the documents keeps of each the
item terms that it holds and how often; document frequencies and lengths are summed from that. A second pass takes blocks of documents:
each of a document's terms brings its array of items, all of a block's (item, document, impact) are concatenated, their packed keys are
radix sorted by 16-bit digits, and equal keys are summed. Of what reaches an item's best so far a heap selects its `best`; a task hands on
no more than that for each item, and these meet in two levels of ranks, so no task ranks what all tasks found for an item.

Items are dealt into groups of at most `pairs` (item, term) pairs (an item with more is a group of its own), whose index is broadcast;
each group takes both passes. Documents are worked on whole, and every score is computed: nothing is pruned but by the rank itself.

Cases: null and empty texts have no terms, and don't count; rows of items alike in item_id are one item with the terms of all (a null
item_id is an item's id as any other), and an item without a term has no rows; repeated document rows are ranked each; a null doc_id comes
after all others of its score; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import cut, modest_batches, scratch, words_of

BEST, PAIRS, LEVEL, KEYS = 50, 1 << 18, 64, 1 << 22


class Index:
    """Terms by number, and the items (by number) that hold each."""

    def __init__(self, items: list[list[bytes]]) -> None:
        self.terms: dict[bytes, int] = {}
        held: list[list[int]] = []
        for i, terms in enumerate(items):
            for t in terms:
                if (k := self.terms.setdefault(t, len(held))) == len(held):
                    held.append([])
                held[k].append(i)
        self.items = len(items)
        self.at = np.concatenate([[0], np.cumsum([len(x) for x in held])]).astype(np.int64)
        self.held = np.array([i for x in held for i in x], np.int64)


def radix_order(keys: np.ndarray) -> np.ndarray:
    """The stable order of unsigned keys: least significant 16 bits first, which numpy's stable sort takes by radix."""
    order, most = np.argsort(keys.astype(np.uint16), kind="stable"), int(keys.max(initial=0))
    for shift in range(16, max(most.bit_length(), 1), 16):
        order = order[np.argsort((keys[order] >> np.uint64(shift)).astype(np.uint16), kind="stable")]
    return order


def block_scores(index: Index, weights: np.ndarray, terms: np.ndarray, times: np.ndarray, doc: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a block of documents: item, document and score of each pair that shares a term, sorted. terms, times and doc: the documents' postings."""
    impact = weights[terms] * ((1_000_000_000 * times) // (1000 * times + 20 * m[doc]))
    first, n = index.at[terms], index.at[terms + 1] - index.at[terms]
    place = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)
    keys = (index.held[place] * len(m) + np.repeat(doc, n)).astype(np.uint64)
    order = radix_order(keys)
    keys, values = keys[order], np.repeat(impact, n)[order]
    if not len(keys):
        return keys.astype(np.int64), keys.astype(np.int64), values
    begin = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sums, keys = np.add.reduceat(values, begin), keys[begin].astype(np.int64)
    return keys // len(m), keys % len(m), sums


class Best:
    """The `most` best (score, doc_id) of each item so far."""

    def __init__(self, items: int, most: int) -> None:
        self.most, self.lists, self.least = most, [[] for _ in range(items)], np.ones(items, np.int64)

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, ids: pa.Array) -> None:
        """item is sorted; doc: the place of a document's id in ids."""
        good = np.flatnonzero(score >= self.least[item])
        if not len(good):
            return
        item, score = item[good], score[good].tolist()
        names = ids.take(pa.array(doc[good])).to_pylist()
        edges = np.flatnonzero(np.diff(item, prepend=-1, append=self.least.size))
        for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            i = int(item[lo])
            found = [(-score[k], names[k] is None, names[k]) for k in range(lo, hi)]
            # entries that are equal in score and id are alike, so a null id is never compared with another
            self.lists[i] = kept = heapq.nsmallest(self.most, [*self.lists[i], *found], key=lambda x: (x[0], x[1], 0 if x[1] else x[2]))
            if len(kept) == self.most:
                self.least[i] = -kept[-1][0]


def _lengths(n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """m of documents of n terms each: 50 plus 50 times the length over the mean length."""
    if int(n.max(initial=0)) * 50 * documents < 1 << 63:
        return 50 + 50 * n * documents // terms
    return np.array([50 + 50 * int(x) * documents // terms for x in n], np.int64)


def _items(bench: DataFrame, pairs: int) -> tuple[DataFrame, int]:
    """grp, item_id and terms (distinct, as bytes) of each item with a term, and the number of groups."""

    def split(batches):
        for b in batches:
            terms = [sorted(set(words_of(t))) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("item_id"), pa.array(terms, pa.list_(pa.binary()))], ["item_id", "terms"])

    kind = bench.schema["item_id"].dataType.simpleString()
    terms = bench.select("item_id", "text").mapInArrow(split, f"item_id {kind}, terms array<binary>").select("item_id", F.explode("terms").alias("term")).distinct()
    items = cut(terms.groupBy("item_id").agg(F.array_sort(F.collect_list("term")).alias("terms")))
    total, many = items.agg(F.sum(F.size("terms")), F.count("*")).first()
    groups = max(1, math.ceil(2 * (total or 0) / pairs))
    dealt = lambda n: items.withColumn("grp", F.pmod(F.xxhash64("item_id"), F.lit(n)) if n > 1 else F.lit(0))
    while many and groups < many and dealt(groups).groupBy("grp").agg(F.sum(F.size("terms")).alias("pairs"), F.count("*").alias("items")).filter((F.col("pairs") > pairs) & (F.col("items") > 1)).take(1):
        groups *= 2
    return dealt(groups), groups if many else 0


def search(docs: DataFrame, bench: DataFrame, best: int = BEST, pairs: int = PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the `best` highest-scoring rows of docs(doc_id, text) for each item of bench(item_id, text)."""
    modest_batches(docs.sparkSession)
    items, groups = _items(bench, pairs)
    id_kind, doc_kind = (df.schema[c].dataType.simpleString() for df, c in ((bench, "item_id"), (docs, "doc_id")))
    out = docs.sparkSession.createDataFrame([], f"item_id {id_kind}, rank int, doc_id {doc_kind}, score bigint")
    for g in range(groups):
        mine = items.filter(F.col("grp") == g).select("item_id", "terms").toArrow()
        if mine.num_rows:
            found = _group(docs, mine["terms"].to_pylist(), best)
            names = docs.sparkSession.createDataFrame(pa.table({"item": pa.array(range(mine.num_rows), pa.int32()), "item_id": mine["item_id"]}))
            out = out.unionByName(found.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return out


def _group(docs: DataFrame, items: list[list[bytes]], best: int) -> DataFrame:
    """item (a number), rank, doc_id, score of one group of items."""
    spark = docs.sparkSession
    index = spark.sparkContext.broadcast(Index(items))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def post(batches):
        known = index.value.terms
        for b in batches:
            n, terms, times = [], [], []
            for t in b.column("text").to_pylist():
                counts = Counter(words_of(t))
                n.append(counts.total())
                both = [(known[w], k) for w, k in counts.items() if w in known]
                terms.append(np.array([x for x, _ in both], np.int32).tobytes())
                times.append(np.array([x for _, x in both], np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(n, pa.int64()), pa.array(terms, pa.binary()), pa.array(times, pa.binary())], ["doc_id", "n", "terms", "times"])

    path = scratch(spark, "postings")
    docs.select("doc_id", "text").mapInArrow(post, f"doc_id {kind}, n bigint, terms binary, times binary").filter("n > 0").write.parquet(path)
    postings = spark.read.parquet(path)
    total = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()

    def count(batches):
        n = np.zeros(len(index.value.terms), np.int64)
        for b in batches:
            n += np.bincount(np.frombuffer(b"".join(b.column("terms").to_pylist()), np.int32), minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(n[some])], ["term", "df"])

    # as many rows as the group has terms, at most `pairs`
    df = postings.select("terms").mapInArrow(count, "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    weights = np.zeros(len(index.value.terms), np.int64)
    weights[df["term"].to_numpy()] = [math.floor(1000 * math.log((2 * total.documents + 2) / (2 * x + 1))) for x in df["df"].to_pylist()]
    weighed = spark.sparkContext.broadcast((weights, total.documents, total.terms))

    def rank(batches):
        own, (weights, documents, terms) = index.value, weighed.value
        top, size = Best(own.items, best), max(1, min(2_000, KEYS // own.items))
        for b in (b.slice(at, size) for b in batches for at in range(0, b.num_rows, size)):
            m = _lengths(b.column("n").to_numpy(), documents, terms)
            some = b.column("terms").to_pylist()
            doc = np.repeat(np.arange(len(some)), [len(x) >> 2 for x in some])
            flat = np.frombuffer(b"".join(some), np.int32).astype(np.int64)
            times = np.frombuffer(b"".join(b.column("times").to_pylist()), np.int64)
            # pieces of some KEYS (item, document, impact) at most, but for a document with more by itself
            ends = np.cumsum(np.bincount(doc, own.at[flat + 1] - own.at[flat], len(some))).astype(np.int64)
            places, lo = np.searchsorted(doc, np.arange(len(some) + 1)), 0
            while lo < len(some):
                hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + KEYS, "right")))
                part = slice(places[lo], places[hi])
                item, which, score = block_scores(own, weights, flat[part], times[part], doc[part] - lo, m[lo:hi])
                top.add(item, score, which + lo, b.column("doc_id"))
                lo = hi
        rows = [(i, -s, d) for i, kept in enumerate(top.lists) for s, _, d in kept]
        for at in range(0, len(rows), 100_000):
            i, s, d = zip(*rows[at : at + 100_000], strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(s, pa.int64()), pa.array(d, b.schema.field("doc_id").type)], ["item", "score", "doc_id"])

    found = postings.mapInArrow(rank, f"item int, score bigint, doc_id {kind}").withColumn("part", F.pmod(F.spark_partition_id(), F.lit(LEVEL)))
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = found.withColumn("rank", F.row_number().over(Window.partitionBy("item", "part").orderBy(*order))).filter(F.col("rank") <= best)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).filter(F.col("rank") <= best).select("item", "rank", "doc_id", "score")


#: The same rows in SQL, by hash joins and groups.
ORACLE = r"""
with d as (select doc_id, row_number() over () r, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') w from documents),
 nonempty as (select * from d where len(w) > 0),
 c as (select count(*) docs, cast(sum(len(w)) as bigint) terms from nonempty),
 p as (select r, term, count(*) tf from (select r, unnest(w) term from nonempty) group by r, term),
 q as (select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term from benchmark),
 t as (select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) w from p, c where term in (select term from q) group by term),
 m as (select r, doc_id, 100 - 50 + ((50 * len(w) * docs) // terms) m from nonempty, c),
 s as (select q.item_id, m.r, any_value(m.doc_id) doc_id, cast(sum(t.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * m.m))) as bigint) score from q join t on t.term = q.term join p on p.term = q.term join m on m.r = p.r group by q.item_id, m.r)
select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) rank, doc_id, score from s where score > 0
qualify row_number() over (partition by item_id order by score desc, doc_id) <= 50
"""
