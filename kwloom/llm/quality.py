"""Quality classifier by supervised subword embeddings.

A text's features are its words (runs without ASCII white space, case kept), pairs of neighbouring words, and the byte n-grams of words
with a mark at either end; each is hashed to one of 2**bits rows of an embedding table. A pair of equal words is one feature whatever
the word, since a repetition says the same of any. The rows' mean over all of a text's features goes through a linear layer and a softmax;
table and layer are learnt together by stochastic gradient descent in numpy.

After learning, each row's part in the logit is a number of its own, so what is broadcast is one integer a row (WHOLE parts of one), and a
text's score is the logistic function of a mean of integers: the same whatever batch a text comes in.

The learner sees at most `rows` labelled rows and `size` bytes of text (`_util.labelled`), a documented bound; every text is scored, whole.

Cases: a null or empty text has no features and scores the bias alone; a label that is null takes no part, one given twice counts as 1 if
any is; without usable labels every score is 0.5; repeated rows are scored each; a null doc_id is scored and not held out; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import SpanHasher, blocks, labelled, modest_batches, remainder, word_spans

BITS, DIM, ROWS, SIZE, THRESHOLD, GRAMS, EPOCHS, RATE, WHOLE = 17, 8, 4_000, 64 << 20, 0.3, (2, 3, 4), 6, 0.5, 1 << 24


def features(texts: list[str | None], hasher: SpanHasher, bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of feature: the table's row at each place and where each text's places begin (and the end); -1 where a place has none."""
    parts = [b" ".join(t.encode("utf-8", "replace").split()) if t else b"" for t in texts]
    buf = np.frombuffer(b" " + b" ".join(parts) + b" ", np.uint8)
    at = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) + 1 for p in parts], out=at[1:])  # text i has the bytes at[i] (a space) up to at[i + 1]
    starts, ends = word_spans(buf)
    shift = np.uint64(64 - bits)
    words, before = hasher(buf, starts, ends) if len(starts) else np.zeros(0, np.uint64), np.searchsorted(starts, at)
    out = [((words >> shift).astype(np.int64), before)]
    pairs = np.full(len(words), -1, np.int64)
    if len(words) > 1:
        with np.errstate(over="ignore"):
            pairs[:-1] = ((words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:]) * np.uint64(0xFF51AFD7ED558CCD) >> shift).astype(np.int64)
        pairs[:-1][words[:-1] == words[1:]] = 0
        pairs[before[1:][before[1:] > 0] - 1] = -1  # a text's last word has none after it
    out.append((pairs, before))
    space = buf == 32
    for n in GRAMS:
        places = len(buf) - n + 1
        if places < 1:
            continue
        key, across = np.full(places, n, np.uint64), np.zeros(places, bool)
        for i in range(n):
            key = key << np.uint64(8) | buf[i : places + i]
            if 0 < i < n - 1:
                across |= space[i : places + i]
        if n == 2:
            across = space[:places] & space[1 : places + 1]
        with np.errstate(over="ignore"):
            rows = (key * np.uint64(0x9E3779B97F4A7C15) >> shift).astype(np.int64)
        rows[across] = -1
        out.append((rows, np.minimum(at, places)))
    return out


def _counted(texts: list[str | None], hasher: SpanHasher, bits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Each text's rows, once each, and the share of its features that each has."""
    found = features(texts, hasher, bits)
    out = []
    for i in range(len(texts)):
        rows = np.concatenate([f[b[i] : b[i + 1]] for f, b in found])
        rows, n = np.unique(rows[rows >= 0], return_counts=True)
        out.append((rows.astype(np.int32), (n / max(1, n.sum())).astype(np.float32)))
    return out


class Embeddings:
    """An embedding table and a softmax layer over the mean of its rows."""

    def __init__(self, bits: int = BITS, dim: int = DIM, classes: int = 2) -> None:
        rng = np.random.default_rng(11)
        self.table = rng.uniform(-1 / dim, 1 / dim, (1 << bits, dim)).astype(np.float32)
        self.layer, self.bias = np.zeros((classes, dim), np.float32), np.zeros(classes, np.float32)

    def learn(self, rows: np.ndarray, share: np.ndarray, label: int, rate: float) -> None:
        """One step down the gradient of the cross entropy; rows of the table move by their share relative to the text's root mean square."""
        mean = share @ self.table[rows]
        z = self.layer @ mean + self.bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        back = self.layer.T @ p
        self.layer -= rate * np.outer(p, mean)
        self.bias -= np.float32(0.1 * rate) * p
        if len(rows):
            self.table[rows] -= rate * np.outer(share / np.sqrt((share * share).sum()), back)

    def logits(self) -> tuple[np.ndarray, float]:
        """What each row of the table adds to the logit of class 1 against class 0 where it has a share of one, and the bias."""
        return self.table @ (self.layer[1] - self.layer[0]), float(self.bias[1] - self.bias[0])


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, size: int = SIZE, bits: int = BITS, epochs: int = EPOCHS, rate: float = RATE) -> tuple[np.ndarray, float]:
    """The logit parts of all rows of the table in WHOLE parts of one, and the bias; learnt from labelled rows outside the held-out fifth."""
    texts = labelled(docs, labels, "quality", remainder("doc_id", 5) != 0, rows, size)

    def count(batches):
        hasher = SpanHasher()
        for b in batches:
            keys, marks, some = b.column("key").to_pylist(), b.column("label").to_pylist(), b.column("text").to_pylist()
            for first, last in blocks(some):
                found = _counted(some[first:last], hasher, bits)
                cols = pa.array(keys[first:last], pa.int64()), pa.array(marks[first:last], pa.int32()), pa.array([r.tobytes() for r, _ in found], pa.binary()), pa.array([s.tobytes() for _, s in found], pa.binary())
                yield pa.RecordBatch.from_arrays(list(cols), ["key", "label", "at", "share"])

    sample = [(r.key, bytes(r.at), bytes(r.share), r.label) for r in texts.mapInArrow(count, "key bigint, label int, at binary, share binary").toLocalIterator()]
    sample.sort()
    if not sample:
        return np.zeros(1 << bits, np.int64), 0.0
    model, steps = Embeddings(bits), epochs * len(sample)
    for epoch in range(epochs):
        order = np.random.default_rng(epoch).permutation(len(sample))
        for step, i in enumerate(order):
            _, at, share, label = sample[i]
            model.learn(np.frombuffer(at, np.int32), np.frombuffer(share, np.float32), int(label), rate * (1 - (epoch * len(sample) + step) / steps))
    parts, bias = model.logits()
    return np.rint(parts.astype(float) * WHOLE).astype(np.int64), bias


def scores(texts: list[str | None], parts: np.ndarray, bias: float, hasher: SpanHasher) -> np.ndarray:
    """The probability of class 1 of each text."""
    bits = len(parts).bit_length() - 1
    total, n = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
    for rows, begin in features(texts, hasher, bits):
        there = rows >= 0
        sums, counts = np.zeros(len(rows) + 1, np.int64), np.zeros(len(rows) + 1, np.int64)
        np.cumsum(np.where(there, parts[rows], 0), out=sums[1:])
        np.cumsum(there, out=counts[1:])
        total += sums[begin[1:]] - sums[begin[:-1]]
        n += counts[begin[1:]] - counts[begin[:-1]]
    return 1 / (1 + np.exp(-np.clip(total / WHOLE / np.maximum(n, 1) + bias, -500, 500)))


def quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = ROWS, size: int = SIZE, bits: int = BITS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs(doc_id, text), learnt from labels(doc_id, quality)."""
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, rows, size, bits))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def score(batches):
        hasher, (parts, bias) = SpanHasher(), shared.value
        for b in batches:
            texts, p = b.column("text").to_pylist(), np.zeros(b.num_rows)
            for first, last in blocks(texts):
                p[first:last] = scores(texts[first:last], parts, bias, hasher)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(p)], ["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
