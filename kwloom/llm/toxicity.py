"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Features are the distinct unigrams, bigrams and skip-bigrams (one word left out) of a text, and its words cut to their first four
and six bytes, which inflected forms share; all hashed to `bits` bits. Only whether they occur has a part in a score. Learning keeps a rate per coordinate and an L1 term that leaves most weights at
zero, so what is broadcast for scoring is a short list of (feature, weight).

The learner sees at most `rows` labelled rows, those with the smallest hash of doc_id, one of each (doc_id, text), and `size` bytes of
text: a documented bound, the same at every size of the table. Everything is scored, whole.

Cases: a null or empty text scores the bias alone; a label that is null takes no part, one given twice counts as toxic if any is;
without usable labels every score is 0; repeated rows are scored each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import SpanHasher, blocks, hashed_words, labelled, mix, modest_batches, remainder, words_of

BITS, ROWS, SIZE, THRESHOLD, STEMS = 20, 6_000, 64 << 20, 0.3, (4, 6)


class Ftrl:
    """FTRL-proximal logistic regression for binary features; feature 2**bits is the bias, which L1 leaves alone."""

    def __init__(self, bits: int = BITS, alpha: float = 0.3, beta: float = 1.0, l1: float = 2.0, l2: float = 0.5) -> None:
        self.alpha, self.beta, self.l2 = alpha, beta, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.l1 = np.full((1 << bits) + 1, l1)
        self.l1[-1] = 0

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        shrunk = np.sign(z) * np.maximum(0, np.abs(z) - self.l1[at])
        return -shrunk / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        more = self.n[at] + g * g
        self.z[at] += g - (np.sqrt(more) - np.sqrt(self.n[at])) / self.alpha * w
        self.n[at] = more


def features(texts: list[str | None], hasher: SpanHasher, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of texts, those of each text together, and where each text's begin (and the end); not made distinct."""
    h, starts, ends, before, raw = hashed_words(texts, hasher)
    buf = np.frombuffer(raw, np.uint8)
    stems = [hasher(buf, starts, np.minimum(starts + n, ends)) ^ np.uint64(n) for n in STEMS]
    doc = np.repeat(np.arange(len(texts)), np.diff(before))
    shift = np.uint64(64 - bits)
    with np.errstate(over="ignore"):
        pair = mix(h[:-1] * np.uint64(3) + h[1:])[doc[:-1] == doc[1:]] if len(h) > 1 else h[:0]
        skip = mix(h[:-2] * np.uint64(5) + h[2:])[doc[:-2] == doc[2:]] if len(h) > 2 else h[:0]
    owner = np.concatenate([doc, *[doc] * len(stems), doc[1:][doc[:-1] == doc[1:]], doc[2:][doc[:-2] == doc[2:]]])
    hashed = (np.concatenate([h, *stems, pair, skip]) >> shift).astype(np.int64)
    order = np.argsort(owner, kind="stable")
    return hashed[order], np.searchsorted(owner[order], np.arange(len(texts) + 1))


def counted(batches, bits: int = BITS):
    """For batches of (key, text, label) those of (key, toxic, at): the distinct features of each text, found for a block of texts at a time."""
    hasher = SpanHasher()
    for b in batches:
        keys, marks, texts = b.column("key"), b.column("label"), b.column("text").to_pylist()
        for first, last in blocks(texts):
            at, starts = features(texts[first:last], hasher, bits)
            found = [np.unique(at[s:e]).astype(np.int32).tobytes() for s, e in zip(starts, starts[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([keys.slice(first, last - first), marks.slice(first, last - first), pa.array(found, pa.binary())], ["key", "toxic", "at"])


def train(docs: DataFrame, labels: DataFrame, rows: int = ROWS, size: int = SIZE, bits: int = BITS, epochs: int = 4) -> tuple[np.ndarray, np.ndarray, float]:
    """Feature numbers and weights that are not zero, and the bias, learnt from labelled documents outside the held-out quarter."""
    modest_batches(docs.sparkSession)
    texts = labelled(docs, labels, "toxic", remainder("doc_id", 4) != 2, rows, size)

    def fit(batches):
        rows = sorted(row for b in batches for row in zip(b.column("key").to_pylist(), b.column("at").to_pylist(), b.column("toxic").to_pylist(), strict=True))
        model = Ftrl(bits)
        for _ in range(epochs):
            for _, at, toxic in rows:
                model.learn(np.append(np.frombuffer(at, np.int32), 1 << bits), toxic)
        if rows:
            weights = model.weights(np.arange((1 << bits) + 1))
            used = np.append(np.flatnonzero(weights[:-1]), 1 << bits)
            yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(weights[used])], ["at", "weight"])

    # one task learns, as rows and size bound it; only the weights come to the driver, the bias last
    sample = texts.mapInArrow(lambda batches: counted(batches, bits), "key bigint, toxic int, at binary")
    found = sample.repartition(1).mapInArrow(fit, "at bigint, weight double").toArrow()
    if not found.num_rows:
        return np.zeros(0, np.int64), np.zeros(0), -np.inf
    at, weights = found["at"].to_numpy(), found["weight"].to_numpy()
    return at[:-1], weights[:-1], float(weights[-1])


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = ROWS, bits: int = BITS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of docs(doc_id, text)."""
    scored = _mapped(docs.select("doc_id", "text"), train(docs, labels, rows, bits=bits), bits, lambda b, p: ([b.column("doc_id"), pa.array(p)], ["doc_id", "score"]), [docs.schema["doc_id"], T.StructField("score", T.DoubleType())])
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def _mapped(docs: DataFrame, model: tuple, bits: int, make, fields: list) -> DataFrame:
    """What `make` returns (columns and names) for each batch of docs and its rows' scores."""
    modest_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(batches):
        used, weights, bias = shared.value
        dense = np.zeros(1 << bits)
        dense[used] = weights
        kept, hasher = np.zeros(1 << bits, bool), SpanHasher()
        kept[used] = True
        for b in batches:
            texts, sums = b.column(b.schema.get_field_index("text")).to_pylist(), np.zeros(b.num_rows)
            for first, last in blocks(texts):
                at, starts = features(texts[first:last], hasher, bits)
                doc = np.repeat(np.arange(last - first), np.diff(starts))
                told = kept[at]
                both = np.unique(doc[told] << bits | at[told])
                sums[first:last] = np.bincount(both >> bits, dense[both & (1 << bits) - 1], last - first)
            with np.errstate(over="ignore"):
                p = 1 / (1 + np.exp(-(sums + bias)))
            columns, names = make(b, p)
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.mapInArrow(score, T.StructType(fields))


def acceptable(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, and those without a word, which have nothing to be rejected for; with all their columns
    whatever their names. A null doc_id is no matter."""

    def keep(b, p):
        wordless = [not words_of(t) for t in b.column(b.schema.get_field_index("text")).to_pylist()] if (p >= threshold).any() else False
        kept = b.filter(pa.array((p < threshold) | wordless))
        return kept.columns, kept.schema.names

    return _mapped(docs, train(docs, labels), BITS, keep, docs.schema.fields)
