"""Benchmark decontamination by winnowing.

From every run of SPAN - K + 1 consecutive K-word hashes the smallest is kept (the rightmost of equals). Two texts that share
SPAN words in a row keep the same hash there, so joining the kept hashes of documents and benchmark meets every shared span. An
item of fewer than SPAN words must be met as a whole; its only fingerprint is the hash of all its words, and documents are looked
up under the few lengths below SPAN that some item has.

Documents first pass a bit table of the benchmark's fingerprints, some 32 bits each and 2**TABLE_BITS (8 MB) at most, so it may be
broadcast; it only lets too much through. Only what passes is winnowed, carries its neighbouring words, is joined on the hash with groups of
items alike there, and the hit is extended word by word to both sides, so that no hash decides a result.

Cases: null and empty texts have no words and no hits; an item without words hits nothing; repeated document rows each get the
same result; a null doc_id is an id as any other; an item_id given twice counts once; items with a null item_id hit words as any and
count as one item together, but the digest of ids leaves them out; empty tables give no hits or no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import SpanHasher, blocks, cut, fresh, hashed_words, modest_batches, words_of

SPAN, K, TABLE_BITS = 10, 5, 26


def winnowed(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest value of each window of consecutive values, the rightmost of equals; sorted, once each."""
    if len(grams) < window:
        return np.zeros(0, np.int64)
    rows = sliding_window_view(grams[::-1], window)
    last = len(grams) - 1 - (np.arange(len(rows)) + rows.argmin(1))
    return np.unique(last)


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of n consecutive words, from the words' hashes; n takes part in them."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(len(words) - n + 1, n, np.uint64)
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + words[i : len(words) - n + 1 + i]
        return out ^ (out >> np.uint64(32))


def _benchmark_prints(bench: DataFrame, span: int, k: int) -> DataFrame:
    """item (id as text behind a sign, or nothing for null), item_words, item_at, gram (hash), n (words in the gram), whole (a short item) of each fingerprint."""

    def prints(batches):
        hasher = SpanHasher()
        for b in batches:
            out = []
            for item, text in zip(b.column("item").to_pylist(), b.column("text").to_pylist(), strict=True):
                h = hashed_words([text], hasher)[0]
                if not len(h):
                    continue
                words = [w.decode("utf-8", "replace") for w in words_of(text)]
                whole = len(h) < span
                n = len(h) if whole else k
                grams = gram_hashes(h, n)
                for at in [0] if whole else winnowed(grams, span - k + 1):
                    left, right = max(0, at - (span - n)), min(len(words), at + span)
                    out.append((item, words[left:right], int(at - left), int(grams[at].astype(np.int64)), n, whole))
            if out:
                kinds = [pa.string(), pa.list_(pa.string()), pa.int32(), pa.int64(), pa.int32(), pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["item", "item_words", "item_at", "gram", "n", "whole"])

    named = F.coalesce(F.concat(F.lit("="), F.col("item_id").cast("string")), F.lit(""))  # the empty name is that of a null id
    return bench.select(named.alias("item"), "text").mapInArrow(prints, "item string, item_words array<string>, item_at int, gram bigint, n int, whole boolean")


def _bit_table(prints: DataFrame, most: int) -> tuple[np.ndarray, int, list[tuple[int, bool]]]:
    """The benchmark's fingerprints as a packed bit table, its size in bits (a power of two), and which (n, whole) occur.

    The table has some 32 bits a fingerprint, 2**most at most; a fuller one only lets more through.
    """
    kinds = [(r.n, r.whole) for r in prints.select("n", "whole").distinct().collect()]  # at most span
    bits = min(most, max(12, (32 * prints.count()).bit_length()))

    def fold(batches):
        seen, any_ = np.zeros(1 << bits, bool), False
        for b in batches:
            seen[(b.column("gram").to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)] = any_ = True
        if any_:
            yield pa.RecordBatch.from_arrays([pa.array([np.packbits(seen, bitorder="little").tobytes()])], ["seen"])

    table = np.zeros(1 << bits >> 3, np.uint8)
    for row in prints.select("gram").coalesce(16).mapInArrow(fold, "seen binary").toLocalIterator():
        table |= np.frombuffer(bytes(row.seen), np.uint8)
    return table, bits, sorted(kinds)


def contamination(docs: DataFrame, bench: DataFrame, span: int = SPAN, k: int = K, table_bits: int = TABLE_BITS) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row of docs(doc_id, text) against bench(item_id, text)."""
    spark = docs.sparkSession
    modest_batches(spark)
    # items that share a fingerprint and the words around it are one group: documents meet groups, not items
    alike = ["gram", "n", "whole", "item_at", "item_words"]
    groups = cut(_benchmark_prints(bench, span, k).groupBy(alike).agg(F.collect_set("item").alias("items")).withColumn("grp", F.monotonically_increasing_id()))
    shared = spark.sparkContext.broadcast(_bit_table(groups, table_bits))
    kind = docs.schema["doc_id"].dataType.simpleString()
    hit = pa.struct([("gram", pa.int64()), ("n", pa.int32()), ("whole", pa.bool_()), ("start", pa.int32()), ("at", pa.int32()), ("words", pa.list_(pa.string()))])

    def find(batches):
        hasher, (seen, bits, kinds) = SpanHasher(), shared.value
        shift = np.uint64(64 - bits)
        for b in batches:
            texts = b.column("text").to_pylist()
            for first, last in blocks(texts):
                h, starts, ends, before, raw = hashed_words(texts[first:last], hasher)
                hits: dict[int, list] = {}
                for n, whole in kinds:
                    g = gram_hashes(h, n)
                    slot = (g >> shift).astype(np.int64)
                    p = np.flatnonzero(seen[slot >> 3] >> (slot & 7).astype(np.uint8) & 1)
                    doc = np.searchsorted(before, p, "right") - 1
                    inside = p + n <= before[doc + 1]
                    p, doc = p[inside], doc[inside]
                    edges = np.flatnonzero(np.diff(doc, prepend=-1, append=len(texts)))
                    for lo, hi in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                        d, mine = int(doc[lo]), p[lo:hi]
                        begin, end = int(before[d]), int(before[d + 1])
                        if not whole:
                            mine = mine[np.isin(mine - begin, winnowed(g[begin : end - n + 1], span - n + 1), assume_unique=True)]
                        for at in mine.tolist():
                            left, right = max(begin, at - (span - n)), min(end, at + span)
                            words = [raw[starts[i] : ends[i]].decode("utf-8", "replace") for i in range(left, right)]
                            hits.setdefault(d, []).append({"gram": int(g[at].astype(np.int64)), "n": n, "whole": whole, "start": left - begin, "at": at - left, "words": words})
                some = np.array(sorted(hits), np.int64)
                keys = np.zeros(last - first, np.int64)
                if len(some):
                    keys[some] = hasher(hasher.last[0], starts[before[some]], ends[before[some + 1] - 1]).view(np.int64)
                mask = np.ones(last - first, bool)
                mask[some] = False
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(first, last - first), pa.array(np.diff(before)), pa.array([hits.get(d) for d in range(last - first)], pa.list_(hit)), pa.array(keys, mask=mask)],
                    ["doc_id", "n_words", "hits", "text_key"],
                )

    rows = cut(docs.select("doc_id", "text").mapInArrow(find, f"doc_id {kind}, n_words bigint, hits array<struct<gram:bigint,n:int,whole:boolean,start:int,at:int,words:array<string>>>, text_key bigint"))
    met = rows.filter("text_key is not null").select("doc_id", "text_key", F.explode("hits").alias("h")).select("doc_id", "text_key", "h.*").join(groups.drop("items"), ["gram", "n", "whole"])
    # words alike to the left of the gram and from its start on; the hit must hold the whole gram
    left = _run("reverse(slice(words, 1, at))", "reverse(slice(item_words, 1, item_at))")
    right = _run("slice(words, at + 1, size(words))", "slice(item_words, item_at + 1, size(item_words))")
    met = met.withColumn("left", left).withColumn("right", right)
    met = met.filter((F.col("right") >= F.col("n")) & (F.col("whole") | (F.col("left") + F.col("right") >= span)))
    spans = cut(met.select("doc_id", "text_key", "grp", (F.col("start") + F.col("at") - F.col("left")).alias("a"), (F.col("start") + F.col("at") + F.col("right")).alias("b")))
    places = spans.groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans"))
    items = spans.select("doc_id", "text_key", "grp").distinct().join(groups.select("grp", F.explode("items").alias("item")), "grp").groupBy("doc_id", "text_key").agg(F.array_sort(F.collect_set("item")).alias("items"))
    n_hit = F.expr("aggregate(spans, named_struct('to', 0, 'n', 0L), (s, x) -> named_struct('to', greatest(s.to, x.b), 'n', s.n + greatest(0, x.b - greatest(s.to, x.a))), s -> s.n)")
    alike = lambda a, b: F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.text_key") == F.col(f"{b}.text_key"))
    per_doc = places.alias("s").join(items.alias("i"), alike("s", "i")).select("s.doc_id", "s.text_key", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(F.transform(F.filter("items", lambda x: x != ""), lambda x: x.substr(F.lit(2), F.length(x))), ","), 256).alias("items_sha256"))
    clean = rows.filter("text_key is null")
    hit_rows = rows.filter("text_key is not null").select("doc_id", "n_words", "text_key")
    joined = hit_rows.alias("r").join(per_doc.alias("p"), alike("r", "p"), "left").select("r.doc_id", "n_words", "n_hit", "n_items", "items_sha256")
    none = clean.select("doc_id", "n_words", F.lit(None).cast("long").alias("n_hit"), F.lit(None).cast("long").alias("n_items"), F.lit(None).cast("string").alias("items_sha256"))
    return joined.unionByName(none).select(
        "doc_id",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def _run(a: str, b: str):
    """How many leading words of two word lists are alike."""
    return F.expr(f"aggregate(zip_with({a}, {b}, (x, y) -> x <=> y and x is not null), named_struct('on', true, 'n', 0), (s, same) -> named_struct('on', s.on and same, 'n', if(s.on and same, s.n + 1, s.n)), s -> s.n)")


def decontaminated(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents of which no word is hit. A row goes by its own text: its doc_id may be null or that of other texts."""
    texts = docs.select(F.xxhash64("text").alias("doc_id"), "text")
    hit = fresh(docs, "_hit_text")
    dirty = contamination(texts, bench).filter("contaminated").select(F.col("doc_id").alias(hit)).distinct()
    return docs.join(dirty, F.xxhash64("text") == F.col(hit), "left_anti")
