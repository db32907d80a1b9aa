"""Bloom filters of a column's values, as an array of 64-bit words in one row: built in tasks, merged bit by bit, broadcast, looked up by place.

A filter only lets too much through, the more the fuller it is; its size is bounded whatever the rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HASHES, WORD, MOST = 3, 64, 28


def bits_for(n: int, most: int = MOST) -> int:
    """The bits, as a power of two, of a filter for n values: 16 to 32 a value up to 2**most."""
    return min(most, max(10, (16 * n).bit_length()))


def _places(value: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(value, F.lit(i)), F.lit(1 << bits)) for i in range(HASHES)]


def of(values: DataFrame, column: str, bits: int) -> DataFrame:
    """One row: words, the filter of the column's values. The driver gets the words that have a bit, 2**bits bits at most."""
    at = values.select(F.explode(F.array(*_places(F.col(column), bits))).alias("p")).select(F.shiftright("p", 6).alias("word"), F.expr("shiftleft(1L, cast(p % 64 as int))").alias("bit"))
    found = at.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    held = np.zeros(max(1, (1 << bits) // WORD), np.int64)
    held[found["word"].to_numpy()] = found["bits"].to_numpy()
    words = pa.ListArray.from_arrays(pa.array([0, len(held)], pa.int32()), pa.array(held))
    return values.sparkSession.createDataFrame(pa.table({"words": words}))


def marked(values: DataFrame, column: str, words: DataFrame, bits: int, name: str) -> DataFrame:
    """values with a column `name`: whether the column's value may be among those that the filter was made of."""
    held = F.lit(True)
    for p in _places(F.col(column), bits):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(WORD)).cast("int"))
        held = held & (F.get("words", F.shiftright(p, 6).cast("int")).bitwiseAND(bit) != F.expr("0L"))
    # one row of 2**bits bits
    return values.crossJoin(F.broadcast(words)).withColumn(name, held).drop("words")
