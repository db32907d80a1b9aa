"""Language identification by prediction by partial matching (PPM).

Each language has a context tree of bytes up to ORDER deep. A symbol in a context seen n times with d distinct followers costs
-log2(count / (n + d)); one not seen there costs the escape, -log2(d / (n + d)), and then its cost in the context shortened by a
byte; below order 0 all bytes are alike. Statistics are frozen and nothing is excluded after an escape, so the code length of a
text is a sum of looked-up costs. Trees of all languages are one table: a (context, symbol) key has a vector with its whole cost
in each language, escapes included; a context key has a vector with the escape costs.

Learning uses at most `rows` distinct texts of each language, those with the smallest hash, as many as have `size` characters together (one
in any case), and of a longer text than `longest` characters its first ones: a documented bound. The counts are made on the executors. What the
driver gathers and broadcasts is bounded by size + longest characters a language.

Cases: a null text, or one without a letter, is "und" with score 0; without any training rows every text is; ties go to the
language first in order; repeated rows are predicted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ._util import HashTable, blocks, modest_batches, remainder

ORDER, ROWS, LONGEST, SIZE, UNKNOWN, BROADCAST_ROWS = 4, 300, 1 << 20, 16 << 20, "und", 100_000


def _padded(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, each behind ORDER zero bytes, and a flag for the bytes that count."""
    parts = []
    for t in texts:
        parts += [bytes(ORDER), t.encode("utf-8", "replace") if t else b""]
    buf = np.frombuffer(b"".join(parts), np.uint8)
    real = np.ones(len(buf), bool)
    at = np.cumsum([0] + [len(p) for p in parts])
    for i in range(ORDER):
        real[at[:-1:2] + i] = False
    return buf, real


def _keys(buf: np.ndarray, at: np.ndarray, order: int) -> np.ndarray:
    """For each position: the `order` bytes before it and its own, with the order above them."""
    out = np.full(len(at), order + 1, np.uint64)
    for i in range(order, -1, -1):
        out = out << np.uint64(8) | buf[at - i].astype(np.uint64)
    return out


class Model:
    """The languages' frozen statistics: from arrays language (number), key, count."""

    def __init__(self, languages: list[str], language: np.ndarray, key: np.ndarray, count: np.ndarray) -> None:
        self.languages, n = languages, len(languages)
        order = key >> np.uint64(8)  # the key without its symbol
        level = np.zeros(len(key), np.int64)
        for k in range(ORDER, -1, -1):
            level[key >> np.uint64(8 * (k + 1)) == k + 1] = k
        self.symbols, self.contexts = [None] * (ORDER + 1), [None] * (ORDER + 1)
        lower = None
        for k in range(ORDER + 1):
            mine = level == k
            lang, keys, counts, context = language[mine], key[mine], count[mine].astype(float), order[mine]
            contexts, place = np.unique(context, return_inverse=True)
            total, kinds = np.zeros((len(contexts), n)), np.zeros((len(contexts), n))
            np.add.at(total, (place, lang), counts)
            np.add.at(kinds, (place, lang), 1)
            escape = np.where(kinds > 0, -np.log2(np.maximum(kinds, 1) / np.maximum(total + kinds, 1)), 0)
            symbols, which = np.unique(keys, return_inverse=True)
            cost = escape[np.searchsorted(contexts, symbols >> np.uint64(8))] + (8.0 if k == 0 else lower(symbols))
            cost[which, lang] = -np.log2(counts / (total + kinds)[place, lang])
            self.symbols[k], self.contexts[k] = HashTable(symbols, cost), HashTable(contexts, escape)
            lower = self._shorter(k)

    def _shorter(self, k: int):
        """The costs of keys of order k + 1 in their contexts shortened by a byte."""

        def costs(keys: np.ndarray) -> np.ndarray:
            low = (np.uint64(1) << np.uint64(8 * (k + 1))) - np.uint64(1)
            return self._cost(keys & low | np.uint64(k + 1) << np.uint64(8 * (k + 1)), k)

        return costs

    def _cost(self, keys: np.ndarray, k: int) -> np.ndarray:
        slot = self.symbols[k].find(keys)
        out = self.symbols[k].rows[slot]
        miss = np.flatnonzero(slot < 0)
        if len(miss):
            at = self.contexts[k].find(keys[miss] >> np.uint64(8))
            escape = np.where((at < 0)[:, None], np.float32(0), self.contexts[k].rows[at])
            out[miss] = escape + (np.float32(8) if k == 0 else self._shorter(k - 1)(keys[miss]))
        return out

    def bits(self, texts: list[str | None]) -> np.ndarray:
        """Code lengths in bits: a row a text, a column a language."""
        buf, real = _padded(texts)
        at = np.flatnonzero(real)
        lengths = np.array([len(t.encode("utf-8", "replace")) if t else 0 for t in texts])
        out = np.zeros((len(texts), len(self.languages)))
        if len(at):
            cost = self._cost(_keys(buf, at, ORDER), ORDER)
            sums = np.zeros((len(at) + 1, cost.shape[1]))
            np.cumsum(cost, axis=0, dtype=float, out=sums[1:])
            ends = np.cumsum(lengths)
            out = sums[ends] - sums[ends - lengths]
        return out


def train(docs: DataFrame, rows: int = ROWS, longest: int = LONGEST, size: int = SIZE) -> Model | None:
    """The model of documents outside the held-out third; None without any."""
    learn = docs.select(F.substring("text", 1, longest).alias("text"), "lang", F.xxhash64("text").alias("h"), F.least(F.length("text"), F.lit(longest)).cast("long").alias("chars")).filter((remainder("doc_id", 3) != 1) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # only hashes below a bound that leaves some four times `rows` distinct texts of a language are ranked, so no task ranks a whole language
    sizes = learn.groupBy("lang").agg(F.approx_count_distinct("h", 0.02).alias("size"))
    few = len(sizes.take(BROADCAST_ROWS + 1)) <= BROADCAST_ROWS
    hashed = learn.select("lang", "h", "chars").join(F.broadcast(sizes) if few else sizes, "lang")
    low = hashed.filter(F.col("h") / F.lit(2.0**64) + 0.5 <= F.lit(4.0 * rows) / F.col("size"))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = low.groupBy("lang", "h").agg(F.max("chars").alias("chars")).withColumn("n", F.row_number().over(order)).filter(F.col("n") <= rows)
    chosen = chosen.withColumn("sofar", F.sum("chars").over(order)).filter((F.col("n") == 1) | (F.col("sofar") <= size)).select("lang", "h")
    small = len(chosen.take(BROADCAST_ROWS + 1)) <= BROADCAST_ROWS
    # of copies of a text one is learnt from; each task leaves at most one of each for the shuffle
    texts = learn.join(F.broadcast(chosen) if small else chosen, ["lang", "h"]).groupBy("lang", "h").agg(F.first("text").alias("text")).select("lang", "text")

    def count(batches):
        for b in batches:
            languages = b.column("lang").to_pylist()
            texts_of: dict[str, list] = {}
            for language, text in zip(languages, b.column("text").to_pylist(), strict=True):
                texts_of.setdefault(language, []).append(text)
            for language, texts in texts_of.items():
                for first, last in blocks(texts):
                    buf, real = _padded(texts[first:last])
                    at = np.flatnonzero(real)
                    for k in range(ORDER + 1):
                        keys, n = np.unique(_keys(buf, at, k), return_counts=True)
                        yield pa.RecordBatch.from_arrays([pa.array([language] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["lang", "key", "n"])

    found = texts.mapInArrow(count, "lang string, key bigint, n bigint").groupBy("lang", "key").agg(F.sum("n").alias("n")).toArrow()
    if not found.num_rows:
        return None
    languages = sorted(set(found["lang"].unique().to_pylist()))
    number = {x: i for i, x in enumerate(languages)}
    lang = np.array([number[x] for x in found["lang"].to_pylist()])
    return Model(languages, lang, found["key"].to_numpy().view(np.uint64), found["n"].to_numpy())


def identify(docs: DataFrame, rows: int = ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs(doc_id, text, lang); the score is the share that the best language
    has of all, of their probabilities to the power 1 over the root of the bytes: longer texts are surer, but not all are 1."""
    import regex

    modest_batches(docs.sparkSession)

    shared = docs.sparkSession.sparkContext.broadcast(train(docs, rows))
    letter = regex.compile(r"\p{L}")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def predict(batches):
        model = shared.value
        for b in batches:
            texts, names, scores = b.column("text").to_pylist(), [], []
            for first, last in blocks(texts):
                some = texts[first:last]
                bits = model.bits(some) if model else np.zeros((len(some), 1))
                best = bits.argmin(1)
                size = np.array([max(1, len(t.encode("utf-8", "replace"))) if t else 1 for t in some])
                share = 1 / np.exp2(-(bits - bits.min(1, keepdims=True)) / np.sqrt(size)[:, None]).sum(1)
                for t, i, p in zip(some, best, share, strict=True):
                    known = model is not None and t is not None and letter.search(t) is not None
                    names.append(model.languages[i] if known else UNKNOWN)
                    scores.append(float(p) if known else 0.0)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"])

    found = docs.select("doc_id", "text").mapInArrow(predict, f"doc_id {kind}, lang_pred string, score double")
    return found.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")
