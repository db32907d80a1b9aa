"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint is cut into 32 segments of two bits and embedded as the vector of their bit counts (0, 1 or 2).
The Manhattan distance of two such vectors never exceeds the Hamming distance of the fingerprints. The vectors are put on a
grid of eight axes (four segments each): vectors at most four apart agree on at least four axes, so one cell per choice of four
axes finds them all. Within a cell the Manhattan bound is tested first, then the exact Hamming distance.

A cell of more than `hot` fingerprints isn't paired. Its members go to all points at most two bit flips away; fingerprints at
most four bits apart share such a midpoint and any two that share one are at most four bits apart, so linking each midpoint's
members to the smallest of them gives the same components with 2,081 rows a member, whatever the size of the group.

Cases: a null or empty text has fingerprint zero, which links like any other; repeated rows are kept, each with its class; a row with a
null doc_id is in its class as any other but names none: component_id is the smallest id that isn't null, and null in a class without
one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import cut, many, modest_batches

WORDS, SEED, BITS = 4, 42, 4
AXES, SEGMENTS_PER_AXIS = 8, 4
LOW = 0x5555555555555555


def fingerprint_text(text: str | None, words: int = WORDS, seed: int = SEED) -> int:
    """The fingerprint of one text: a bit is 1 if over half of its shingles' XXH64 have it."""
    import xxhash

    tokens = text.encode("utf-8", "replace").lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    hashed, n, tops = xxhash.xxh64_intdigest, max(1, len(tokens) - words + 1), ends.tolist()
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):  # bounded memory for very long texts
        to = min(n, at + (1 << 16))
        h = np.array([hashed(joined[starts[i] : tops[min(i + words, len(tokens)) - 1]], seed) for i in range(at, to)], ">u8")
        ones += np.unpackbits(h.view(np.uint8)).reshape(-1, 64).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


def fingerprints(docs: DataFrame, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row of docs(doc_id, text)."""
    kind = docs.schema["doc_id"].dataType

    def score(batches):
        for b in batches:
            found = [fingerprint_text(t, words, seed) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(np.array(found, np.uint64).view(np.int64))], ["doc_id", "fp"])

    modest_batches(docs.sparkSession)
    return docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind.simpleString()}, fp bigint")


def _thermometer(fp: Column) -> Column:
    """Each segment's count in unary (00, 01, 11): the bits in which two such codes differ number their Manhattan distance."""
    low, high = fp.bitwiseAND(F.lit(LOW)), F.shiftrightunsigned(fp, 1).bitwiseAND(F.lit(LOW))
    return F.shiftleft(low.bitwiseAND(high), 1).bitwiseOR(low.bitwiseOR(high))


def _signed(m: int) -> int:
    return m - (1 << 64) if m >> 63 else m


def _grids() -> list[tuple[int, int]]:
    """For each choice of axes: the bits of their segments, and a flag (the lowest bit of an axis) for each other axis before the last chosen."""
    axis = [sum(3 << 2 * s for s in range(a * SEGMENTS_PER_AXIS, (a + 1) * SEGMENTS_PER_AXIS)) for a in range(AXES)]
    wide = 2 * SEGMENTS_PER_AXIS
    return [
        (_signed(sum(axis[a] for a in chosen)), sum(1 << wide * a for a in range(chosen[-1]) if a not in chosen))
        for chosen in combinations(range(AXES), AXES - BITS)
    ]


def _in_cells(fps: DataFrame) -> DataFrame:
    """cell, fp, grid and n (fingerprints in the cell) of the fingerprints of fps(fp) in each cell that several share."""
    masks = F.array(*[F.lit(m) for m, _ in _grids()])
    # each fingerprint makes 70 rows: dealt to a fixed number of tasks first, or few small partitions would make all of them
    fps = fps.repartition(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cells = fps.select("fp", _thermometer(F.col("fp")).alias("code")).select("fp", "code", F.posexplode(masks).alias("grid", "mask"))
    cells = cells.select("fp", "grid", F.xxhash64("grid", F.col("code").bitwiseAND(F.col("mask"))).alias("cell"))
    sized = cells.groupBy("cell").agg(F.count("*").alias("n")).filter("n > 1")
    return many(cells).join(sized, "cell")


def _midpoints(fps: DataFrame) -> DataFrame:
    """mid, fp, a and n: of fps(fp) all points two bit flips away or less that several share, with the smallest fingerprint there and how many."""
    one = lambda c: F.when(F.col(c) < 64, F.expr(f"shiftleft(1L, {c})")).otherwise(F.lit(0).cast("long"))
    points = (
        fps.select("fp", F.explode(F.sequence(F.lit(0), F.lit(64))).alias("i"))
        .select("fp", "i", F.explode(F.when(F.col("i") == 64, F.array(F.lit(64))).otherwise(F.sequence(F.col("i") + 1, F.lit(64)))).alias("j"))
        .select("fp", F.col("fp").bitwiseXOR(one("i")).bitwiseXOR(one("j")).alias("mid"))
    )
    least = points.groupBy("mid").agg(F.min("fp").alias("a"), F.count("*").alias("n")).filter("n > 1")
    return many(points).join(many(least), "mid")


def links(fps: DataFrame, hot: int = 512) -> DataFrame:
    """Edges (a, b), a < b, between distinct fingerprints of fps(fp): their components are those of all links at most four bits long.

    A pair that shares several cells is made in the first of them only: every axis before the last chosen one differs.
    """
    rests = F.array(*[F.lit(r).cast("long") for _, r in _grids()])
    full = cut(_in_cells(fps))
    some = full.filter(F.col("n") <= hot)
    a = some.select(F.col("cell").alias("cell_a"), "grid", F.col("fp").alias("a"), _thermometer(F.col("fp")).alias("code_a"), F.element_at(rests, F.col("grid") + 1).alias("rest"))
    b = some.select(F.col("cell").alias("cell_b"), F.col("grid").alias("grid_b"), F.col("fp").alias("b"), _thermometer(F.col("fp")).alias("code_b"))
    unlike = F.col("code_a").bitwiseXOR(F.col("code_b"))
    differs = unlike
    for by in (4, 2, 1):
        differs = differs.bitwiseOR(F.shiftrightunsigned(differs, by))
    near = (
        (F.col("a") < F.col("b"))
        & (F.bit_count(unlike) <= BITS)
        & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= BITS)
        & (F.col("grid") == F.col("grid_b"))
        & (differs.bitwiseAND(F.col("rest")) == F.col("rest"))
    )
    pairs = many(a).join(many(b), (F.col("cell_a") == F.col("cell_b")) & near).select("a", "b")
    flips = full.filter(F.col("n") > hot).select("fp").distinct()
    if flips.isEmpty():
        return pairs.distinct()
    stars = _midpoints(flips).filter("a < fp").select("a", F.col("fp").alias("b"))
    return pairs.unionByName(stars).distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node and root (the smallest node reachable) of the graph edges(a, b), by alternating large-star and small-star steps.

    Each step links a node's neighbours to its smallest one; the edges end as stars. Nothing is gathered on the driver but
    whether they have. Edges that are stars from the start take no round. Each round is cut, so lineage stays short.
    """
    edges = cut(edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())

    def star(pairs: DataFrame, large: bool) -> DataFrame:
        # pairs (u, v): v are neighbours of u; m is the smallest of u and all of them
        least = pairs.groupBy("u").agg(F.min("v").alias("w")).select("u", F.least("u", "w").alias("m"))
        linked = pairs.join(least, "u")
        out = linked.filter("v > u").select(F.col("v").alias("x"), "m") if large else linked.select(F.col("v").alias("x"), "m").unionByName(linked.select(F.col("u").alias("x"), "m"))
        return out.filter("x <> m").distinct()

    def stars() -> bool:
        # whether each node hangs on one smaller node, and on none that hangs itself
        ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(0).alias("up")), F.struct(F.col("b").alias("node"), F.lit(1).alias("up")))).alias("e"))
        nodes = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.count("*").alias("n"))
        return nodes.agg(F.coalesce(F.max((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("n") > F.col("up")))), F.lit(False))).first()[0] is False

    for at in range(rounds + 1):
        if stars():
            break
        if at == rounds:
            raise RuntimeError(f"components: not settled after {rounds} rounds")
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
        grown = star(both, large=True).select(F.greatest("x", "m").alias("u"), F.least("x", "m").alias("v"))
        edges = cut(star(grown, large=False).select(F.col("m").alias("a"), F.col("x").alias("b")))
    return edges.select(F.col("b").alias("node"), F.col("a").alias("root"))


def near_duplicates(docs: DataFrame, hot: int = 512) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest doc_id reachable over links) of every row of docs.

    Copies share a fingerprint, so each distinct fingerprint enters the join once however many rows have it. The last join has
    one row a fingerprint on its smaller side, so adaptive execution can split a fingerprint that many rows share.
    """
    rows = cut(fingerprints(docs))
    by_fp = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(by_fp.select("fp"), hot)).select(F.col("node").alias("fp"), "root")
    classes = by_fp.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    smallest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(smallest, "root").select("fp", "component_id")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
