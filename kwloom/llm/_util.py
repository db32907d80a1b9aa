"""What the operators of this subpackage share: the shared folder, checkpoints, splits of rows and word hashes."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.storage import released  # noqa: F401

#: Bytes of a text that are not part of a word: ASCII except letters and digits; A-Z become a-z.
WORD_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))

_MASK = (1 << 64) - 1
_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or a temporary one where that is unset and all runs in one process (tests)."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="kwloom-")
        atexit.register(shutil.rmtree, _LOCAL[app], ignore_errors=True)
    return f"file://{_LOCAL[app]}"


def modest_batches(spark: SparkSession) -> None:
    """Hand rows to Python in batches of 8 MB: with Spark's own 64 MB a worker holds thousands of whole texts several times over. Another setting stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name) == "67108864b":
        spark.conf.set(name, "8388608b")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Delete what was written under a path of `scratch`, once nothing reads it any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def cut(df: DataFrame) -> DataFrame:
    """The rows of df, computed once and kept in the shared folder, so a lost executor costs no recomputation."""
    sc = df.sparkSession.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)


def many(df: DataFrame) -> DataFrame:
    """df for a join that mustn't broadcast it: Spark takes what explode makes of a row for one row, so by its size it would send rows by the million through the driver."""
    return df.hint("merge")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def remainder(col: str, of: int) -> Column:
    """crc32 of the id as text, modulo `of`; null for a null id, which then is in no split."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % F.lit(of)


def labelled(docs: DataFrame, labels: DataFrame, label: str, learn: Column, rows: int, size: int) -> DataFrame:
    """key (hash of doc_id), text and label of labelled rows of docs(doc_id, text) for which `learn` holds, one of each (doc_id, text).

    Ids go by their hash, and of an id's texts those with the smallest hash come first: at most `rows` of them, and as many as have `size`
    bytes together (one in any case). A label given twice counts as 1 if any is. What is broadcast and returned is bounded by that.
    """
    ids = (
        labels.select("doc_id", F.col(label).cast("int").alias("label")).filter(learn & F.col("doc_id").isNotNull() & F.col("label").isNotNull())
        .groupBy("doc_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    own = docs.select("doc_id", "text", F.xxhash64("text").alias("h"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"))
    found = own.drop("text").join(F.broadcast(ids), "doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "h").limit(rows)
    # a window over `rows` rows at most
    sofar = F.sum("bytes").over(Window.orderBy(F.xxhash64("doc_id"), "doc_id", "h"))
    chosen = found.withColumn("sofar", sofar).filter((F.col("sofar") <= size) | (F.col("sofar") == F.col("bytes"))).select("doc_id", "h", "label")
    return own.join(F.broadcast(chosen), ["doc_id", "h"]).groupBy("doc_id", "h", "label").agg(F.first("text").alias("text")).select(F.xxhash64("doc_id").alias("key"), "text", "label")


def words_of(text: str | None) -> list[bytes]:
    """Lower-case (A-Z only) words of a text, as UTF-8: runs of ASCII letters, digits and anything beyond ASCII."""
    return text.encode("utf-8", "replace").translate(WORD_TABLE).split() if text else []


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xFF51AFD7ED558CCD)
        h = h ^ (h >> np.uint64(33))
        h = h * np.uint64(0xC4CEB9FE1A85EC53)
        return h ^ (h >> np.uint64(33))


class SpanHasher:
    """Hashes of many spans of a byte buffer at once, from prefix sums of a polynomial in an odd base modulo 2**64."""

    BASE = 0x9E3779B97F4A7C15 | 1

    def __init__(self) -> None:
        rng = np.random.default_rng(7)
        self.table = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.powers = np.ones(1, np.uint64)
        self.inverse = np.ones(1, np.uint64)
        self.last = None

    def _grow(self, n: int) -> None:
        if len(self.powers) <= n:
            size = max(n + 1, 2 * len(self.powers), 1 << 16)
            with np.errstate(over="ignore"):
                for name, base in (("powers", self.BASE), ("inverse", pow(self.BASE, -1, 1 << 64))):
                    steps = np.full(size, base, np.uint64)
                    steps[0] = 1
                    setattr(self, name, np.multiply.accumulate(steps))

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        self._grow(len(buf))
        with np.errstate(over="ignore"):
            if self.last is None or self.last[0] is not buf:
                sums = np.zeros(len(buf) + 1, np.uint64)
                np.cumsum(self.table[buf] * self.powers[: len(buf)], out=sums[1:])
                self.last = buf, sums
            sums = self.last[1]
            return mix((sums[ends] - sums[starts]) * self.inverse[starts])


def word_spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than the space in a buffer that WORD_TABLE has passed."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = buf != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def blocks(texts: list[str | None], size: int = 1 << 18):
    """Consecutive runs of texts of about `size` characters; a longer text is a run of its own."""
    first, total = 0, 0
    for i, t in enumerate(texts):
        total += len(t) if t else 0
        if total >= size:
            yield first, i + 1
            first, total = i + 1, 0
    if first < len(texts):
        yield first, len(texts)


def hashed_words(texts: list[str | None], hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, bytes]:
    """Of all texts in one buffer: word hashes, starts, ends, the number of words before each text (and in all), the buffer."""
    parts = [t.encode("utf-8", "replace").translate(WORD_TABLE) if t else b"" for t in texts]
    raw = b" ".join(parts)
    buf = np.frombuffer(raw, np.uint8)
    starts, ends = word_spans(buf)
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])
    return hasher(buf, starts, ends), starts, ends, np.searchsorted(starts, at), raw


class HashTable:
    """Keys of 64 bits with a row of costs each: open addressing in arrays."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray) -> None:
        self.bits = max(4, int(len(keys) * 2.5).bit_length())
        self.keys = np.zeros(1 << self.bits, np.uint64)
        self.rows = np.zeros((1 << self.bits, rows.shape[1]), np.float32)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = self.keys[slot[left]] == 0
            put = left[free]
            _, first = np.unique(slot[put], return_index=True)
            put = put[first]
            self.keys[slot[put]], self.rows[slot[put]] = keys[put], rows[put]
            left = left[self.keys[slot[left]] != keys[left]]
            slot[left] = slot[left] + 1 & (1 << self.bits) - 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 where there is none."""
        slot = self._slot(keys)
        there = self.keys[slot]
        open_ = np.flatnonzero((there != keys) & (there != 0))
        while len(open_):
            slot[open_] = slot[open_] + 1 & (1 << self.bits) - 1
            there[open_] = self.keys[slot[open_]]
            open_ = open_[(there[open_] != keys[open_]) & (there[open_] != 0)]
        slot[there != keys] = -1
        return slot
