"""Document frequencies kept with the set of keys that they were counted over, extended by new keys only.

    commits/<n>           the folders of all parts and the number of documents
    parts/<id>/df, keys   what one extension counted, Parquet

A cache made over one set of keys can't be used for another: `frequencies` refuses it, by a hash of the set, where the caller names what it wants.
An extension counts only the keys that the cache doesn't have, and is there when its commit is; one that fails leaves the cache as it was.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import terms, warehouse
from ..sources.storage import Store


class Refused(RuntimeError):
    """The cache was counted over other keys than those asked for."""


class FrequencyCache:
    def __init__(self, spark: SparkSession, path: str, key: str) -> None:
        self.spark, self.key, self.store = spark, key, Store(spark, path)

    def _commit(self) -> dict:
        known = [n for n in self.store.names("commits") if n.isdigit()]
        return json.loads(self.store.read(f"commits/{known[-1]}")) if known else {"number": 0, "parts": [], "documents": 0}

    def _read(self, what: str, schema: str) -> DataFrame:
        parts = self._commit()["parts"]
        return self.spark.read.schema(schema).parquet(*[self.store.at(f"parts/{p}/{what}") for p in parts]) if parts else self.spark.createDataFrame([], schema)

    def keys(self) -> DataFrame:
        return self._read("keys", "key string")

    def key_hash(self) -> str:
        return warehouse.key_set_hash(self.keys(), "key").first().key_hash

    def extend(self, rows: DataFrame, counted: Callable[[DataFrame], DataFrame]) -> int:
        """Count rows(key, ...) of keys that the cache lacks; counted: rows to (key, term) with a row a document and term. Returns how many keys came in."""
        before = self._commit()
        new = rows.withColumn("_k", F.col(self.key).cast("string")).join(self.keys().withColumnRenamed("key", "_k"), "_k", "left_anti")
        fresh = new.select(F.col("_k").alias("key")).filter("key is not null").distinct()
        part = uuid.uuid4().hex
        fresh.write.parquet(self.store.at(f"parts/{part}/keys"))
        come = self.spark.read.parquet(self.store.at(f"parts/{part}/keys")).count()
        if not come:
            self.store.delete(f"parts/{part}")
            return 0
        tf = counted(new.drop("_k"))
        terms.document_frequency(tf, self.key).write.parquet(self.store.at(f"parts/{part}/df"))
        number = before["number"] + 1
        commit = {"number": number, "parts": [*before["parts"], part], "documents": before["documents"] + come}
        if not self.store.create(f"commits/{number:08d}", json.dumps(commit)):
            self.store.delete(f"parts/{part}")
            raise RuntimeError(f"extension {number} is taken")
        return come

    def frequencies(self, wanted: DataFrame | None = None) -> tuple[DataFrame, int]:
        """(term, df) over all parts, and the number of keys; wanted(key): the keys that must be those of the cache."""
        if wanted is not None and warehouse.key_set_hash(wanted.select(F.col(self.key).cast("string").alias("key")), "key").first().key_hash != self.key_hash():
            raise Refused("the cache's keys are not those asked for")
        return self._read("df", "term string, df long").groupBy("term").agg(F.sum("df").alias("df")), self._commit()["documents"]
