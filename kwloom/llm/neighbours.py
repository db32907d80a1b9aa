"""Nearest neighbours by randomly rotated one-bit codes.

Vectors are centred, scaled to length one and rotated by a seeded random orthogonal matrix; the signs of the result are the code,
packed to one bit a dimension. With o the unit vector and x its code's unit vector, <o, q> is estimated by <x, q> / <x, o>; its
error is at most eps * sqrt((1 - <x, o>^2) / <x, o>^2 / (D - 1)) * |q| but for a vanishing share of pairs. The candidates of best estimate are
measured on the original vectors first; then all whose lower bound can still beat the (k+1)th best of these. (The query keeps its real components,
which popcounts can't take: a block of codes is unpacked to signs for one matrix product.)

Every distinct vector is in the index, with the k + 1 smallest ids that have it: ties go to smaller ids, so no other row of a vector
can be among the nearest, and a vector that a third of all rows share costs no more than any other. Queries and candidates meet in blocks: a
candidate goes to one chunk, a query to one block of queries, and each (chunk, block) is one bounded task that hands on its k + 1 best per
query. Original vectors travel along as bytes: with one bit a dimension the bounds leave more candidates than it costs to copy all to a few large blocks.

Cases: vectors that are null, all zero, of another length than most, or hold null or non-finite components take no part; ties go
to the smaller vec_id; repeated rows of a vec_id count once (the first by their contents); fewer candidates than k give all of
them; an empty table gives no rows; a null vec_id takes no part; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import cut

K, EPS, SEED, CHUNK, BLOCK = 10, 4.0, 11, 50_000, 20_000


def rotation(dim: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix, the same in every process."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def codes(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Packed sign bits, distances from the centre, and <x, o> of each vector."""
    off = vectors - centre
    norm = np.sqrt((off * off).sum(1))
    unit = off / np.where(norm > 0, norm, 1)[:, None] @ turn
    return np.packbits(unit > 0, axis=1), norm, np.abs(unit).sum(1) / np.sqrt(vectors.shape[1])


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Euclidean distances of the rows of a from the vector b, summed in order of the components."""
    total = np.zeros(len(a))
    for j in range(a.shape[1]):
        total += (a[:, j] - b[j]) ** 2
    return np.sqrt(total)


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """vec_id and embedding (doubles) of the vectors that take part, and their length."""
    v = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"))
    fine = "embedding is not null and vec_id is not null and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('infinity')) and exists(embedding, x -> x <> 0)"
    v = v.filter(fine)
    usual = v.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    if not usual:
        return v, 0
    dim = usual[0].d
    return v.filter(F.size("embedding") == dim).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), dim


def index(vectors: DataFrame, dim: int, seed: int = SEED) -> tuple[DataFrame, np.ndarray]:
    """gid, original (doubles as bytes), code, norm, agree of every vector of vectors(gid, embedding), and the centre (the mean of all)."""
    mean = vectors.select([F.avg(F.col("embedding")[i]).alias(f"m{i}") for i in range(dim)]).first()
    centre = np.array(mean, float)

    def build(frames):
        turn = rotation(dim, seed)
        for f in frames:
            if len(f):
                vectors_of = np.stack(f.embedding.to_numpy()).astype(float)
                code, norm, agree = codes(vectors_of, centre, turn)
                yield pd.DataFrame({"gid": f.gid, "original": [v.tobytes() for v in vectors_of], "code": [c.tobytes() for c in code], "norm": norm, "agree": agree})

    return vectors.select("gid", "embedding").mapInPandas(build, f"gid {vectors.schema['gid'].dataType.simpleString()}, original binary, code binary, norm double, agree double"), centre


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """embedding, ids (the k + 1 smallest vec_ids that have it) and gid (the smallest) of every distinct vector."""
    order = Window.partitionBy("embedding").orderBy("vec_id")
    least = rows.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1)
    return least.groupBy("embedding").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")).withColumn("gid", F.col("ids")[0])


def search(vectors: DataFrame, queries: str, k: int = K, eps: float = EPS, seed: int = SEED, chunk: int = CHUNK, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest other vectors of each vector for which the SQL condition `queries` holds."""
    spark = vectors.sparkSession
    kind = vectors.schema["vec_id"].dataType.simpleString()
    usual, dim = usable(vectors)
    if not dim:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    usual = cut(usual)
    each = cut(distinct_vectors(usual, k))
    asked = cut(usual.filter(queries).join(each.select("embedding", "gid"), "embedding").select(F.col("vec_id").alias("query_id"), F.col("gid").alias("qid")))
    sought = cut(each.join(asked.select(F.col("qid").alias("gid")).distinct(), "gid", "left_semi").select("gid", "embedding"))
    coded, centre = index(each, dim, seed)
    n, m = each.count(), sought.count()
    # more blocks than queries ask for only where there are fewer chunks than cores: each block is a copy of all candidates
    chunks = n // chunk + 1
    groups = max(m // block + 1, min(m // 64 + 1, -(-spark.sparkContext.defaultParallelism // chunks)))
    part = lambda of: F.pmod(F.xxhash64("gid"), F.lit(of)).cast("int")
    every = lambda of: F.explode(F.sequence(F.lit(0), F.lit(of - 1)))
    left = coded.select("*", part(chunks).alias("chunk"), every(groups).alias("block"))
    right = sought.select("*", part(groups).alias("block"), every(chunks).alias("chunk"))

    def meet(c: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if not len(c) or not len(q):
            return pd.DataFrame({"qid": [], "gid": [], "score": []})
        c = c.sort_values("gid", kind="stable")
        turn, ids, original = rotation(dim, seed), c.gid.to_numpy(), np.frombuffer(b"".join(c.original), float).reshape(len(c), dim)
        bits = np.unpackbits(np.frombuffer(b"".join(c.code), np.uint8).reshape(len(c), -1), axis=1, count=dim)
        norm, agree = c.norm.to_numpy(), np.maximum(c.agree.to_numpy(), 1e-9)
        signs = (2.0 * bits - 1).astype(np.float32) / np.float32(np.sqrt(dim))
        slack = eps * np.sqrt(np.maximum(0, 1 - agree**2) / agree**2 / max(1, dim - 1))
        out = []
        for at in range(0, len(q), 32):
            some = q.iloc[at : at + 32]
            asked_at = np.stack(some.embedding.to_numpy()).astype(float)
            off = asked_at - centre
            size = np.sqrt((off * off).sum(1))
            inner = (off @ turn).astype(np.float32) @ signs.T / agree.astype(np.float32)
            square = norm[None, :] ** 2 + (size**2)[:, None] - 2 * norm[None, :] * inner
            loose = 2 * norm[None, :] * slack[None, :] * size[:, None] + 1e-5 * (norm[None, :] ** 2 + (size**2)[:, None])
            for i, query in enumerate(some.gid.to_numpy()):
                near = np.arange(len(ids))
                if len(ids) > 8 * (k + 1):
                    first = np.argpartition(square[i], 8 * (k + 1))[: 8 * (k + 1)]
                    reach = np.partition(distances(original[first], asked_at[i]), k)[k]
                    near = np.flatnonzero(square[i] - loose[i] <= reach * reach)
                exact = distances(original[near], asked_at[i])
                top = np.lexsort((ids[near], exact))[: k + 1]
                out.append(pd.DataFrame({"qid": query, "gid": ids[near][top], "score": exact[top]}))
        return pd.concat(out)

    met = left.groupBy("chunk", "block").cogroup(right.groupBy("chunk", "block")).applyInPandas(meet, f"qid {kind}, gid {kind}, score double")
    order = Window.partitionBy("qid").orderBy("score", "gid")
    best = met.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")
    # of vectors as near as each other the one with the smaller id comes first, so no row left out here is nearer than k + 1 others
    row = best.join(each.select("gid", "ids"), "gid").select("qid", F.explode("ids").alias("vec_id"), "score")
    order = Window.partitionBy("qid").orderBy("score", "vec_id")
    top = row.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).drop("n")
    # the query itself is among the nearest k + 1 of its vector, or all of these are as near
    found = asked.join(top, "qid").filter("vec_id <> query_id")
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH f AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT len(e) AS size FROM f GROUP BY 1 ORDER BY count(*) DESC, size DESC LIMIT 1),
v AS (SELECT vec_id, min(e) AS e FROM f WHERE len(e) = (SELECT size FROM u) GROUP BY vec_id),
d AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_distance(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score FROM d)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
