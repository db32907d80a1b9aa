"""Near copies by SimHash and by an exact set-similarity join on word shingles: the pipeline's near-duplicate stage.

The stage begins with the classes of `simhash.near_duplicates`: fingerprints of four-word shingles at four or fewer differing bits, by the segment-popcount
embedding. The join then adds what such fingerprints miss, and compares no texts that are in one class already: classes are the components of both kinds of links.

Words are runs of anything but ASCII white space, A-Z in lower case; a text's set holds its runs of WORDS words (all its words if
it has fewer). The join links two texts if their sets' Jaccard similarity is 0.8 or more.

Of sets of a and b members with that similarity, each one's first n - ceil(0.8 n) + 1 members in an order common to all sets
(the prefix) share a member, and the first one shared stands so early that what follows can still make 4/9 (a + b) common
members. So texts that share a prefix member and pass both tests of size are all pairs to look at. Any order gives the same
pairs; members common in one in SAMPLE texts come last, so a passage that many texts hold makes few pairs.

Pairs are compared by their whole sets. In ROUNDS rounds each text of a cell (a prefix member) meets one other, that with most links so
far; then texts of one cell that are not in one component yet meet. A group of m near copies thus makes about m pairs a cell. Texts that
share much and are no near copies stay in a cell together whatever the rounds: a cell of more than LARGE texts is dealt into blocks of some
BLOCK, each pair of blocks is a task's group, where place, size and sketches are compared as arrays, and only pairs that pass these are rows.

Cases: texts without words (null among them) are copies of one another; a null doc_id is an id like any other and counts as
greater than all; rows alike in doc_id and text are one document; a column named like one in use here is kept; an empty table
gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._util import SpanHasher, blocks, cut, fresh, mix, modest_batches, released, remove, scratch, word_spans
from .simhash import components, near_duplicates

WORDS, SAMPLE, COMMON, ROUNDS, LARGE, BLOCK, SKETCH, ROWS = 5, 8, 1 << 20, 2, 32, 512, 1024, 1_000


def text_key(col: str = "text") -> Column:
    """A hash of the text; all texts without words have that of the empty one."""
    return F.xxhash64(F.when(F.col(col).rlike(r"[^\x20\x09-\x0D]"), F.col(col)).otherwise(F.lit("")))


def shingle_sets(texts: list[str | None], hasher: SpanHasher, words: int = WORDS) -> list[np.ndarray]:
    """The hashes of each text's shingles, sorted, once each."""
    out: list[np.ndarray] = []
    for first, last in blocks(texts):
        parts = [b" ".join(t.encode("utf-8", "replace").lower().split()) if t else b"" for t in texts[first:last]]
        buf = np.frombuffer(b" ".join(parts), np.uint8)
        starts, ends = word_spans(buf)
        at = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) + 1 for p in parts], out=at[1:])
        before = np.searchsorted(starts, at)
        final = np.repeat(before[1:], np.diff(before)) - 1  # the last word of each word's text
        hashes = hasher(buf, starts, ends[np.minimum(np.arange(len(starts)) + words - 1, final)]) if len(starts) else np.zeros(0, np.uint64)
        for lo, hi in zip(before[:-1].tolist(), before[1:].tolist(), strict=True):
            out.append(np.unique(hashes[lo : max(lo + 1, hi - words + 1) if hi > lo else lo]))
    return out


def _common(docs: DataFrame, sample: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The `most` shingles that most texts of one in `sample` hold, sorted, and how many do; they only decide the order of prefixes."""

    def count(batches):
        hasher, kept = SpanHasher(), []

        def merged():
            found, which = np.unique(np.concatenate([x[0] for x in kept]), return_inverse=True)
            kept[:] = [(found, np.bincount(which, np.concatenate([x[1] for x in kept])).astype(np.int64))]

        def out():
            merged()
            found, n = kept.pop()
            for at in range(0, len(found), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(found[at : at + 100_000].view(np.int64)), pa.array(n[at : at + 100_000])], ["sh", "n"])

        for b in batches:
            for at in range(0, b.num_rows, ROWS):
                sets = shingle_sets(b.column("text").slice(at, ROWS).to_pylist(), hasher)
                kept.append(np.unique(np.concatenate(sets), return_counts=True))
                if sum(len(x[0]) for x in kept) > 600_000:
                    merged()
                    if len(kept[0][0]) > 300_000:
                        yield from out()
        if kept:
            yield from out()

    some = docs.filter(F.pmod(F.xxhash64("text", F.lit(1)), F.lit(sample)) == 0).select("text")
    top = some.mapInArrow(count, "sh bigint, n bigint").groupBy("sh").agg(F.sum("n").alias("n")).filter("n > 1").orderBy(F.desc("n"), "sh").limit(most).toArrow()
    found, n = top["sh"].to_numpy().view(np.uint64), top["n"].to_numpy()
    order = np.argsort(found)
    return found[order], np.minimum(n[order], 1 << 30).astype(np.int32)


def _prefixes(docs: DataFrame, common: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """key, n (members of the set), sh and at (a member of the prefix and its place) of docs(key, text)."""
    shared = docs.sparkSession.sparkContext.broadcast(common)

    def make(batches):
        hasher, (often, times) = SpanHasher(), shared.value
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            sets = shingle_sets(b.column("text").to_pylist(), hasher)
            sizes = np.array([len(s) for s in sets], np.int64)
            some = []
            for s in sets:
                if len(often):
                    i = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    s = s[np.argsort(np.where(often[i] == s, times[i], 0), kind="stable")]
                some.append(s[: len(s) + (-4 * len(s) // 5) + 1])
            lengths = np.array([len(s) for s in some], np.int64)
            lengths[sizes == 0] = 0
            flat = np.concatenate([s for s, k in zip(some, lengths, strict=True) if k] or [np.zeros(0, np.uint64)])
            at = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
            keys = np.repeat(b.column("key").to_numpy(), lengths)
            for lo in range(0, len(flat), 100_000):
                part = slice(lo, lo + 100_000)
                cols = keys[part], np.repeat(sizes, lengths)[part].astype(np.int32), flat[part].view(np.int64), at[part].astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["key", "n", "sh", "at"])

    return docs.select("key", "text").mapInArrow(make, "key bigint, n int, sh bigint, at int")


def _possible(n: str, at: str, m: str, to: str) -> Column:
    """Whether sets of n and m members whose first common one is the at-th and to-th (from 0) can be similar enough."""
    a, b, i, j = F.col(n), F.col(m), F.col(at), F.col(to)
    return (5 * F.least(a, b) >= 4 * F.greatest(a, b)) & (9 * F.least(a - i, b - j) >= 4 * (a + b))


def _sketched(texts: DataFrame) -> DataFrame:
    """key, n and sketch of texts(key, text): of each member of the set one bit is flipped among SKETCH, so that sets differ in no fewer members than sketches in bits."""

    def make(batches):
        hasher = SpanHasher()
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            sets = shingle_sets(b.column("text").to_pylist(), hasher)
            bits = np.stack([np.bincount((mix(s) >> np.uint64(32)).astype(np.int64) % SKETCH, minlength=SKETCH) & 1 for s in sets]).astype(np.uint8)
            words = np.packbits(bits, axis=1).view(np.int64).ravel()
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array([len(s) for s in sets], pa.int32()), pa.FixedSizeListArray.from_arrays(pa.array(words), SKETCH // 64).cast(pa.list_(pa.int64()))], ["key", "n", "sketch"])

    return texts.mapInArrow(make, "key bigint, n int, sketch array<bigint>")


def _alike(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """Those of pairs(a, b) whose texts' sets are similar enough, kept in the shared folder; docs(key, text) may hold a text several times.

    Pairs whose sketches already differ too much are let go before their texts are fetched.
    """
    spark = docs.sparkSession
    asked = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
    path = scratch(spark, "texts")
    docs.join(asked, "key", "left_semi").dropDuplicates(["key"]).write.parquet(path)
    texts = spark.read.parquet(path)
    sketches = cut(_sketched(texts))
    side = lambda c: sketches.select(F.col("key").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    differ = F.aggregate(F.zip_with("sketch_a", "sketch_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    # sets of a and b members with 4/9 (a + b) or more in common differ in 1/9 (a + b) or fewer
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").filter(9 * differ <= F.col("n_a") + F.col("n_b")).select("a", "b")

    def test(batches):
        hasher = SpanHasher()
        for b in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            left, right = (shingle_sets(b.column(c).to_pylist(), hasher) for c in ("text_a", "text_b"))
            good = [9 * len(np.intersect1d(x, y, assume_unique=True)) >= 4 * (len(x) + len(y)) for x, y in zip(left, right, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(good, pa.bool_()))

    both = pairs.join(texts.select(F.col("key").alias("a"), F.col("text").alias("text_a")), "a").join(texts.select(F.col("key").alias("b"), F.col("text").alias("text_b")), "b")
    found = cut(both.select("a", "b", "text_a", "text_b").mapInArrow(test, "a bigint, b bigint"))
    remove(spark, path)
    return found


def _in_blocks(left: DataFrame, docs: DataFrame, block: int) -> DataFrame:
    """Pairs (a, b) of texts of two components in a large cell, left(sh, key, n, at, root, size), that place, size and sketches let through."""
    spark, path = docs.sparkSession, scratch(docs.sparkSession, "texts")
    docs.join(left.select("key").distinct(), "key", "left_semi").dropDuplicates(["key"]).write.parquet(path)
    rows = left.join(cut(_sketched(spark.read.parquet(path))).select("key", "sketch"), "key")
    remove(spark, path)
    count = F.ceil(F.col("size") / block).cast("int")
    mine = F.pmod(F.xxhash64("key", F.lit(2)), count).cast("int")
    rows = rows.withColumn("blocks", count).withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("sh", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"), "mine", "key", "n", "at", "root", "sketch")

    def meet(group: pa.Table) -> pa.Table:
        kept = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        mine, lo, hi = group["mine"].to_numpy(), group["lo"][0].as_py(), group["hi"][0].as_py()
        key, n, at, root = (group[c].to_numpy() for c in ("key", "n", "at", "root"))
        bits = group["sketch"].combine_chunks().flatten().to_numpy().reshape(len(key), -1).view(np.uint64)
        one, two = np.flatnonzero(mine == lo), np.flatnonzero(mine == hi)
        for i in one.tolist():
            j = two[two > i] if lo == hi else two
            total = n[i] + n[j]
            j = j[(root[j] != root[i]) & (5 * np.minimum(n[j], n[i]) >= 4 * np.maximum(n[j], n[i])) & (9 * np.minimum(n[j] - at[j], n[i] - at[i]) >= 4 * total)]
            j = j[9 * np.bitwise_count(bits[j] ^ bits[i]).sum(1, dtype=np.int64) <= n[i] + n[j]]
            kept[0].append(np.minimum(key[j], key[i]))
            kept[1].append(np.maximum(key[j], key[i]))
        return pa.table({"a": np.concatenate(kept[0]), "b": np.concatenate(kept[1])})

    return rows.groupBy("sh", "lo", "hi").applyInArrow(meet, "a bigint, b bigint").distinct()


def _joined(cells: DataFrame, roots: DataFrame) -> DataFrame:
    """The cells that still hold several components, with each text's root and the cell's size."""
    left = cells.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    several = left.groupBy("sh").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).filter("low < high").select("sh", "size")
    return left.join(several, "sh")


def by_fingerprints(docs: DataFrame) -> DataFrame:
    """Edges (a, b) between the keys of docs(key, text): each text's to the smallest of its SimHash class."""
    found = near_duplicates(docs.select(F.col("key").alias("doc_id"), "text"))
    return cut(found.filter("doc_id <> component_id").select(F.col("component_id").alias("a"), F.col("doc_id").alias("b")).distinct())


def links(docs: DataFrame, sample: int = SAMPLE, most: int = COMMON, rounds: int = ROUNDS, large: int = LARGE, block: int = BLOCK, linked: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) between the keys of docs(key, text) whose components are those of all similar pairs and of linked(a, b), where given."""
    cell = Window.partitionBy("sh")
    rows = _prefixes(docs, _common(docs, sample, most))
    rows = rows.withColumn("least", F.min("key").over(cell)).withColumn("last", F.max("key").over(cell))
    cells = cut(rows.filter("least < last").dropDuplicates(["sh", "key"]).select("sh", "key", "n", "at"))
    edges, tested = linked, None
    roots = None if linked is None else components(linked).select(F.col("node").alias("key"), "root")
    for _ in range(rounds):
        # in each cell all texts of other components meet one: that with most links so far, the smallest of equals
        if edges is None:
            known = cells.withColumn("root", F.col("key")).withColumn("degree", F.lit(0))
        else:
            degrees = edges.select(F.explode(F.array("a", "b")).alias("key")).groupBy("key").agg(F.count("*").alias("degree"))
            known = _joined(cells, roots).drop("size").join(degrees, "key", "left").withColumn("degree", F.coalesce("degree", F.lit(0)))
        leads = known.groupBy("sh").agg(F.min(F.struct((-F.col("degree")).alias("d"), "key", "n", "at", "root")).alias("lead"), F.count("*").alias("size"))
        meet = known.join(leads.select("sh", "size", F.col("lead.key").alias("to_key"), F.col("lead.n").alias("m"), F.col("lead.at").alias("to"), F.col("lead.root").alias("to_root")), "sh")
        # texts that stand too late in a cell to be alike if it is the first that they share may share an earlier one: in a large cell they meet too
        meet = meet.filter((F.col("root") != F.col("to_root")) & (5 * F.least("n", "m") >= 4 * F.greatest("n", "m")) & (_possible("n", "at", "m", "to") | (F.col("size") > large)))
        pairs = meet.select(F.least("key", "to_key").alias("a"), F.greatest("key", "to_key").alias("b")).distinct()
        pairs = cut(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = _alike(pairs, docs)
        edges = found if edges is None else edges.unionByName(found)
        tested = pairs if tested is None else tested.unionByName(pairs)
        roots = components(edges).select(F.col("node").alias("key"), "root")
    # of the texts that a cell holds then, those of two components meet where the cell's member can be the first that they share
    left = cut(_joined(cells, roots))
    few = left.filter(F.col("size") <= large)
    one = few.select("sh", F.col("root").alias("root_a"), F.col("key").alias("key_a"), F.col("n").alias("n_a"), F.col("at").alias("at_a"))
    two = few.select("sh", F.col("root").alias("root_b"), F.col("key").alias("key_b"), F.col("n").alias("n_b"), F.col("at").alias("at_b"))
    more = one.join(two, "sh").filter((F.col("root_a") < F.col("root_b")) & _possible("n_a", "at_a", "n_b", "at_b"))
    more = more.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b")).distinct()
    many = left.filter(F.col("size") > large)
    if many.take(1):
        more = more.unionByName(_in_blocks(many, docs, block)).distinct()
    more = cut(more.join(tested, ["a", "b"], "left_anti"))
    return edges.unionByName(_alike(more, docs))


def keep_one(docs: DataFrame, sample: int = SAMPLE, most: int = COMMON, fingerprints: bool = False) -> DataFrame:
    """Of each class of near copies the document with the smallest doc_id (of texts that share it, one); of repeated rows one stays.

    fingerprints: copies by SimHash are in one class too; else classes are those of the join alone.
    """
    modest_batches(docs.sparkSession)
    with released(docs.sparkSession):
        return _kept(docs, sample, most, fingerprints)


def _kept(docs: DataFrame, sample: int, most: int, fingerprints: bool) -> DataFrame:
    own, kept_id, kept_key, times = (fresh(docs, c) for c in ("_text_key", "_kept_id", "_kept_key", "_rows"))
    keyed = docs.withColumn(own, text_key())
    texts = docs.select(text_key().alias("key"), "text")
    roots = components(links(texts, sample, most, linked=by_fingerprints(texts) if fingerprints else None)).select(F.col("node").alias("key"), "root")
    rows = docs.select("doc_id", text_key().alias("key")).groupBy("key", "doc_id").agg(F.count("*").alias("rows"))
    texts = rows.groupBy("key").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "rows")).alias("first"))
    kept = texts.join(roots, "key", "left").groupBy(F.coalesce("root", "key").alias("root")).agg(F.min("first").alias("first"))
    kept = cut(kept.select(F.col("first.doc_id").alias(kept_id), F.col("first.key").alias(kept_key), F.col("first.rows").alias(times)))
    found = keyed.join(kept, F.col("doc_id").eqNullSafe(F.col(kept_id)) & (F.col(own) == F.col(kept_key)))
    # only rows that repeat are dealt out once more
    once, more = found.filter(F.col(times) == 1), found.filter(F.col(times) > 1).dropDuplicates(["doc_id", own])
    return once.unionByName(more).select([F.col(f"`{c}`") for c in docs.columns])
