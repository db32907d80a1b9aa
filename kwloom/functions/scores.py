"""Scoring expressions."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


def idf(df: Column, n: Column) -> Column:
    return F.log((1.0 + n) / (1.0 + df)) + 1.0


def damped(value: Column, power: float) -> Column:
    return F.pow(value, F.lit(max(0.0, float(power))))


def damped_idf(df: Column, n: Column, power: float) -> Column:
    """damped(idf(df, n), power) by the C library's logarithm and power, as SQL engines have them.

    The JVM's differ from these in a last bit now and then, which decides the order of terms whose scores are equal but for it.
    """
    power = max(0.0, float(power))

    def weights(df: pa.Array, n: pa.Array) -> pa.Array:
        known: dict[tuple[int, int], float] = {}
        out = []
        for x in zip(df.to_pylist(), n.to_pylist(), strict=True):
            if x not in known:
                known[x] = math.pow(math.log((1.0 + x[1]) / (1.0 + x[0])) + 1.0, power)
            out.append(known[x])
        return pa.array(out, pa.float64())

    return F.arrow_udf(weights, "double")(df.cast("long"), n.cast("long"))


def phrase_boost(n: Column, boosts: tuple[float, float]) -> Column:
    return F.when(n == 2, boosts[0]).when(n == 3, boosts[1]).otherwise(1.0)


def recency(age_days: Column, halflife: float) -> Column:
    """Half for each half-life; a missing age counts as new, one in the future too."""
    return F.coalesce(F.pow(F.lit(0.5), F.greatest(age_days, F.lit(0.0)) / max(halflife, 0.1)), F.lit(1.0))


def engagement(score: Column, comments: Column) -> Column:
    plus = lambda c: F.greatest(F.coalesce(c, F.lit(0)), F.lit(0))
    return 1.0 + F.log1p(plus(score)) + 0.5 * F.log1p(plus(comments))


def post_weight(age_days: Column, score: Column, comments: Column, halflife: float, alpha: float) -> Column:
    return ((1.0 - alpha) + alpha * engagement(score, comments)) * recency(age_days, halflife)


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(0.0)


def anchor_factor(phrase_df: Column, token_df: Column, n: Column, power: float, mode: str, alpha: float, floor: float, cap: float, multiplier: float) -> Column:
    """How much a seed gains by an anchor: a fraction, or blended with the anchor's damped IDF; capped, then floored. A null frequency is that of no anchor."""
    if mode == "fraction":
        base = F.lit(float(multiplier))
    else:
        rare = F.greatest(damped(idf(phrase_df, F.greatest(n, F.lit(1))), power), damped(idf(token_df, F.greatest(n, F.lit(1))), power), F.lit(1.0))
        a = min(1.0, max(0.0, alpha))
        base = multiplier * ((1.0 - a) + a * rare)
    return F.greatest(F.lit(float(floor)), F.least(F.lit(float(cap)), base) if cap > 0 else base)
