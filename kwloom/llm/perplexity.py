"""Language-model scores by a hashed maximum-entropy model with a class-factored softmax.

A token is a word or the end of a text, known by a 64-bit hash. Every word of the corpus has a class and a group: classes join word
endings that follow alike neighbours (`word_classes`), groups divide a class by hash. P(token) = P(class | context) * P(group | class,
context) * P(token | group). The first two factors are softmaxes over the log shares of the training counts plus hashed weights of the active
features: the word before, the two before, the word two before (a skip), the classes of the three before. The last is the token's smoothed share
of its group's counts (an unseen word has what one more word with no count would have), so the scores are probabilities and no word is left out.

Learning: a first round counts every training document, from zero weights, where the expectation is the shares whatever the context, so its gradient
needs the counts of (feature, class) alone and its step can be a whole Newton step. Then the training documents are dealt by a hash of their text to ROUNDS
rounds, each of which refines the weights by the full softmax gradient over all its documents: every training document is in the counts and in one gradient. A round's
sums are made on the executors, by blocks of weights and in two steps, and the driver takes one step, scaled per weight by its counts. Counts of words grow
with the corpus and stay in tables; the table of weights is hashed to 2**BITS rows. Only weights, shares and the `common` most frequent words (all bounded)
are broadcast; the counts of all other words meet the documents in a join.

Two words of one 64-bit hash would count as one: with a thousand million distinct words that happens to some pair with a chance of 3 in 100.

Cases: a null text counts as empty and has the end alone; without training documents every count is 0 and the model uniform; repeated rows are scored each; an empty table
gives no rows; a null doc_id is in no split (it is scored, not learnt); a long text is worked on in slices; other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import HashTable, SpanHasher, blocks, cut, mix, modest_batches, remainder, scratch, word_spans

CLASSES, GROUPS, BITS, COMMON = 32, 16, 16, 1 << 18
ENDINGS, NEIGHBOURS = 12, 6  # bits of a hashed word ending, and of that of the word before it
ROUNDS, BLOCKS, FOLD, SLICE, WIDE, PER_TASK = 2, 256, 256, 1 << 13, 1 << 16, 4_000_000
#: How far the first step goes for each feature, and how many tokens a feature must outweigh.
RATES, PRIOR, STEP = (0.5, 0.2, 0.3, 0.5), 5.0, 0.2
_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_U = np.uint64


def tokens(texts: list[str | None], hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts' tokens in a row: hashes, hashed endings, and where each text's begin. The end is a line feed, which no word holds."""
    raw = b" \n ".join([t.encode("utf-8", "replace").translate(_LOWER) if t else b"" for t in texts]) + b" \n"
    buf = np.frombuffer(raw, np.uint8)
    starts, ends = word_spans(buf)
    size = ends - starts
    code = buf[ends - 1].astype(_U)
    for i in (2, 3):
        code |= np.where(size >= i, buf[np.maximum(ends - i, 0)], 0).astype(_U) << _U(8 * (i - 1))
    last = np.flatnonzero(buf[starts] == 10)
    return hasher(buf, starts, ends), (mix(code + _U(1)) >> _U(64 - ENDINGS)).astype(np.int64), np.append(0, last[:-1] + 1)


def before(values: np.ndarray, starts: np.ndarray, by: int, none: int) -> np.ndarray:
    """The value `by` tokens before each, `none` beyond the text's start."""
    out = np.concatenate([np.full(min(by, len(values)), none, values.dtype), values[:-by]])
    for i in range(by):
        at = starts + i
        out[at[at < np.append(starts[1:], len(values))]] = none
    return out


def word_classes(pairs: np.ndarray, classes: int = CLASSES) -> np.ndarray:
    """The class of each word ending from how often it follows each (hashed) ending: weighted k-means of the main directions of the shares' roots."""
    n = pairs.sum(1)
    some = np.flatnonzero(n)
    out = np.zeros(len(pairs), np.int64)
    if not len(some):
        return out
    weight = n[some]
    x = np.sqrt(pairs[some] / weight[:, None])
    x -= np.average(x, axis=0, weights=weight)
    _, _, turn = np.linalg.svd(x * np.sqrt(weight)[:, None], full_matrices=False)
    x = x @ turn[:12].T
    centres = x[np.argsort(-weight, kind="stable")[:classes]].copy()
    for _ in range(25):
        mine = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
        for c in range(len(centres)):
            if (mine == c).any():
                centres[c] = np.average(x[mine == c], axis=0, weights=weight[mine == c])
    out[some] = mine
    return out


class Model:
    """Shares and weights; `outer` rows are hashed features, `inner` rows hashed features and class."""

    def __init__(self, classes: np.ndarray, counts: np.ndarray, kinds: np.ndarray, bits: int = BITS) -> None:
        #: counts and kinds of words in each (class, group); each group has room for one unseen word
        self.classes, self.bits = classes, bits
        self.mass = counts + 0.1 * (kinds + 1)
        self.outer_share = np.log(self.mass.sum(1) / self.mass.sum()).astype(np.float32)
        self.inner_share = np.log(self.mass / self.mass.sum(1, keepdims=True)).astype(np.float32)
        self.outer = np.zeros((1 << bits, CLASSES), np.float32)
        self.inner = np.zeros((1 << bits, GROUPS), np.float32)

    def place(self, hashes: np.ndarray, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Class and group of words."""
        return self.classes[endings], (hashes >> _U(20) & _U(GROUPS - 1)).astype(np.int64)

    def rows(self, hashes: np.ndarray, classes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows of `outer` (tokens, 4) and of `inner` (tokens, 2) for each token's context; each feature has an equal part of the rows."""
        one, two = before(hashes, starts, 1, 7), before(hashes, starts, 2, 7)
        three = [before(classes, starts, i, CLASSES).astype(_U) for i in (1, 2, 3)]
        wide = _U(CLASSES + 1)
        with np.errstate(over="ignore"):
            features = [mix(one + _U(1)), mix(one * _U(3) + two * _U(5) + _U(2)), mix(two * _U(7) + _U(3)), mix(((three[0] * wide + three[1]) * wide + three[2]) * _U(11) + _U(4))]
            own = (classes.astype(_U) + _U(1)) * _U(0x9E3779B97F4A7C15)
            outer, inner = features, [mix(f ^ own) for f in features[:2]]
            return tuple(np.stack([(f >> _U(64 - self.bits)) // _U(len(fs)) + _U((i << self.bits) // len(fs)) for i, f in enumerate(fs)], axis=1).astype(np.int64) for fs in (outer, inner))

    @staticmethod
    def _logits(weights: np.ndarray, rows: np.ndarray, share: np.ndarray) -> np.ndarray:
        out = np.take(weights, rows[:, 0], axis=0)
        for f in range(1, rows.shape[1]):
            out += np.take(weights, rows[:, f], axis=0)
        out += share
        out -= out.max(1, keepdims=True)
        return out

    def _factors(self, outer_rows, inner_rows, classes, groups):
        """(logits, right answer, rows) of both softmaxes."""
        yield self._logits(self.outer, outer_rows, self.outer_share), classes, outer_rows
        yield self._logits(self.inner, inner_rows, self.inner_share[classes]), groups, inner_rows

    def log_probabilities(self, hashes: np.ndarray, endings: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Natural logarithms of P(class, group | context) of each token."""
        classes, groups = self.place(hashes, endings)
        outer, inner = self.rows(hashes, classes, starts)
        out = np.empty(len(hashes))
        for at in range(0, len(hashes), SLICE):
            s = slice(at, at + SLICE)
            total = 0.0
            for logits, right, _ in self._factors(outer[s], inner[s], classes[s], groups[s]):
                total = total + logits[np.arange(len(right)), right] - np.log(np.exp(logits).sum(1))
            out[s] = total
        return out

    def add_counts(self, hashes, endings, starts, sums: tuple[np.ndarray, np.ndarray]) -> None:
        """Add how often each class follows each feature, and each group each feature and class."""
        classes, groups = self.place(hashes, endings)
        for total, rows, right in zip(sums, self.rows(hashes, classes, starts), (classes, groups), strict=True):
            flat = total.reshape(-1)
            flat += np.bincount((rows * total.shape[1] + right[:, None]).ravel(), minlength=len(flat)).astype(np.float32)

    def add_gradients(self, hashes, endings, starts, sums: tuple[np.ndarray, np.ndarray]) -> None:
        """Add expectation less observation under the present weights."""
        classes, groups = self.place(hashes, endings)
        outer, inner = self.rows(hashes, classes, starts)
        for lo in range(0, len(hashes), WIDE):
            hi = min(lo + WIDE, len(hashes))
            found = np.empty((CLASSES, hi - lo)), np.empty((GROUPS, hi - lo))
            for at in range(lo, hi, SLICE):
                s = slice(at, min(at + SLICE, hi))
                for p, (logits, right, _) in zip(found, self._factors(outer[s], inner[s], classes[s], groups[s]), strict=True):
                    np.exp(logits, out=logits)
                    logits /= logits.sum(1, keepdims=True)
                    logits[np.arange(len(right)), right] -= 1
                    p[:, at - lo : s.stop - lo] = logits.T
            # a column at a time: the features' rows are counted with the column's values as weights
            for total, p, rows in zip(sums, found, (outer, inner), strict=True):
                flat = rows[lo:hi].T.ravel()
                for c, values in enumerate(p):
                    total[:, c] += np.bincount(flat, np.tile(values, rows.shape[1]), len(total))

    def first_step(self, sums: tuple[np.ndarray, np.ndarray]) -> None:
        """From zero weights: the logarithm of each count over what the shares expect, at the rate of the feature."""
        self.counts = sums
        for weights, n, share in ((self.outer, sums[0], np.exp(self.outer_share)), (self.inner, sums[1], np.full(GROUPS, 1 / GROUPS, np.float32))):
            weights[:] = np.log((n + PRIOR * share) / (n.sum(1, keepdims=True) + PRIOR) / share)
        for weights, rates in ((self.outer, RATES), (self.inner, RATES[:2])):
            for part, rate in zip(np.split(weights, len(rates)), rates, strict=True):
                part *= rate

    def step(self, sums: tuple[np.ndarray, np.ndarray], part: float) -> None:
        """One gradient step from a part of the documents, given as a share of those counted."""
        for weights, g, n in zip((self.outer, self.inner), sums, self.counts, strict=True):
            weights -= STEP * g / (n * part + PRIOR)


def word_counts(docs: DataFrame) -> DataFrame:
    """h, ending, n of every word of the training documents; rows with the ending -1 count pairs of endings (h: the two, hashed)."""

    def count(batches):
        hasher, kept = SpanHasher(), []

        def merged(limit: int):
            if sum(len(x[0]) for x in kept) > limit:
                keys, at, which = np.unique(np.concatenate([x[0] for x in kept]), return_index=True, return_inverse=True)
                n = np.bincount(which, np.concatenate([x[2] for x in kept])).astype(np.int64)
                kept[:] = [(keys, np.concatenate([x[1] for x in kept])[at], n)]

        def out():
            merged(0)
            keys, endings, n = kept.pop() if kept else (np.zeros(0, _U), np.zeros(0, np.int64), np.zeros(0, np.int64))
            for at in range(0, len(keys), 100_000):
                s = slice(at, at + 100_000)
                yield pa.RecordBatch.from_arrays([pa.array(keys[s].view(np.int64)), pa.array(endings[s].astype(np.int32)), pa.array(n[s])], ["h", "ending", "n"])

        pairs = np.zeros(1 << ENDINGS + NEIGHBOURS, np.int64)
        for b in batches:
            texts = b.column("text").to_pylist()
            for first, last in blocks(texts):
                h, endings, starts = tokens(texts[first:last], hasher)
                keys, at, n = np.unique(h, return_index=True, return_counts=True)
                kept.append((keys, endings[at], n))
                pairs += np.bincount(endings << NEIGHBOURS | before(endings, starts, 1, 0) >> ENDINGS - NEIGHBOURS, minlength=len(pairs))
                merged(1_000_000)
                if len(kept) == 1 and len(kept[0][0]) > 500_000:
                    yield from out()
        yield from out()
        used = np.flatnonzero(pairs)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(np.full(len(used), -1, np.int32)), pa.array(pairs[used])], ["h", "ending", "n"])

    return docs.filter(remainder("doc_id", 10) != 0).select("text").mapInArrow(count, "h bigint, ending int, n bigint").groupBy("h", "ending").agg(F.sum("n").alias("n"))


def prepared(counts: DataFrame, bits: int = BITS) -> Model:
    """The model without weights, of the table that word_counts makes."""
    cells = counts.filter("ending = -1").select("h", "n").toArrow()  # at most 2**(ENDINGS + NEIGHBOURS) rows
    pairs = np.zeros(1 << ENDINGS + NEIGHBOURS)
    pairs[cells["h"].to_numpy()] = cells["n"].to_numpy()
    classes = word_classes(pairs.reshape(1 << ENDINGS, -1))
    model = Model(classes, np.zeros((CLASSES, GROUPS)), np.zeros((CLASSES, GROUPS)), bits=0)

    def fold(batches):
        mass = np.zeros((2, CLASSES * GROUPS), np.int64)
        for b in batches:
            c, g = model.place(b.column("h").to_numpy().view(_U), b.column("ending").to_numpy())
            at = c * GROUPS + g
            mass[0] += np.bincount(at, b.column("n").to_numpy(), mass.shape[1]).astype(np.int64)
            mass[1] += np.bincount(at, minlength=mass.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(mass.shape[1], dtype=np.int32)), pa.array(mass[0]), pa.array(mass[1])], ["at", "n", "kinds"])

    rows = counts.filter("ending >= 0").mapInArrow(fold, "at int, n bigint, kinds bigint").groupBy("at").agg(F.sum("n"), F.sum("kinds")).collect()  # a row a group
    mass = np.zeros((2, CLASSES * GROUPS))
    for at, n, kinds in rows:
        mass[:, at] = n, kinds
    return Model(classes, mass[0].reshape(CLASSES, GROUPS), mass[1].reshape(CLASSES, GROUPS), bits)


def _summed(learn: DataFrame, model: Model, first: bool) -> tuple[np.ndarray, np.ndarray]:
    """The sums over all texts of `learn` of counts (the first round) or gradients."""
    shared = learn.sparkSession.sparkContext.broadcast(model)
    high = (1 << model.bits) // BLOCKS

    def add(batches):
        m, hasher, any_ = shared.value, SpanHasher(), False
        sums = np.zeros(m.outer.shape, np.float32), np.zeros(m.inner.shape, np.float32)
        for b in batches:
            texts = b.column("text").to_pylist()
            for lo, hi in blocks(texts):
                any_ = True
                (m.add_counts if first else m.add_gradients)(*tokens(texts[lo:hi], hasher), sums)
        for at in range(0, BLOCKS if any_ else 0, 32):
            cut_up = [np.concatenate([s[k * high : (k + 1) * high].ravel() for s in sums]).tobytes() for k in range(at, at + 32)]
            yield pa.RecordBatch.from_arrays([pa.array(range(at, at + 32), pa.int32()), pa.array(cut_up, pa.binary())], ["block", "sums"])

    def fold(key, table):
        total = np.zeros(high * (CLASSES + GROUPS))
        for x in table["sums"]:
            total += np.frombuffer(x.as_buffer(), np.float32)
        names = table.column_names
        return pa.table({n: pa.array([total.astype(np.float32).tobytes()], pa.binary()) if n == "sums" else table[n].slice(0, 1) for n in names})

    # a group sums at most FOLD tasks' parts, and then the groups' sums
    parts = learn.select("text").mapInArrow(add, "block int, sums binary").withColumn("fold", F.floor(F.spark_partition_id() / FOLD).cast("int"))
    whole = parts.groupBy("block", "fold").applyInArrow(fold, "block int, sums binary, fold int").drop("fold").groupBy("block").applyInArrow(fold, "block int, sums binary")
    sums = np.zeros(model.outer.shape, np.float32), np.zeros(model.inner.shape, np.float32)
    for row in whole.toLocalIterator():  # BLOCKS rows of a fixed size
        a, s = np.frombuffer(bytes(row.sums), np.float32), slice(row.block * high, (row.block + 1) * high)
        sums[0][s], sums[1][s] = a[: high * CLASSES].reshape(high, -1), a[high * CLASSES :].reshape(high, -1)
    return sums


def train(docs: DataFrame, counts: DataFrame, bits: int = BITS) -> Model:
    """The model of the training documents of docs(doc_id, text); counts: what word_counts makes of them."""
    model = prepared(counts, bits)
    # every task hands on a whole table of sums: small partitions are read by one task, so that tables stay few beside the texts
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, int(model.mass.sum()) // PER_TASK + 1)
    learn = docs.filter(remainder("doc_id", 10) != 0).coalesce(tasks)
    model.first_step(_summed(learn, model, True))
    mine = F.pmod(F.xxhash64("text"), F.lit(ROUNDS))
    for i in range(ROUNDS):
        model.step(_summed(learn.filter(mine == i), model, False), 1 / ROUNDS)
    del model.counts
    return model


def scores(docs: DataFrame, common: int = COMMON, bits: int = BITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row of docs(doc_id, text)."""
    spark = docs.sparkSession
    modest_batches(spark)
    kind = docs.schema["doc_id"].dataType.simpleString()
    path = scratch(spark, "words")
    word_counts(docs).write.parquet(path)
    counts = spark.read.parquet(path)
    words = counts.filter("ending >= 0").select("h", "n")
    n_all, n_kinds = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    top = words.orderBy(F.desc("n"), "h").limit(common).toArrow()
    floor = math.log10(n_all + 0.1 * (n_kinds + 1)) if n_all else math.log10(0.1)
    model = train(docs, counts, bits)
    shared = spark.sparkContext.broadcast((model, top["h"].to_numpy().view(_U), top["n"].to_numpy()))

    def score(batches):
        from pyspark import TaskContext

        m, keys, n = shared.value
        # what each common word counts for; slot -1 of the table is for all others
        table = HashTable(np.maximum(keys, _U(1)), np.log10(n + 0.1)[:, None].astype(float))
        logs = np.append(table.rows[:, 0], 0.0)
        share = np.log10(m.mass)
        hasher, row = SpanHasher(), TaskContext.get().partitionId() << 40
        for b in batches:
            texts = b.column("text").to_pylist()
            for first, last in blocks(texts):
                h, endings, starts = tokens(texts[first:last], hasher)
                slots = table.find(np.maximum(h, _U(1)))
                far = np.flatnonzero(slots < 0)
                base = logs[slots]
                model_logs = m.log_probabilities(h, endings, starts) / math.log(10) - share[m.place(h, endings)]
                lengths = np.diff(np.append(starts, len(h)))
                at = np.append(0, np.cumsum(np.add.reduceat((slots < 0).astype(np.int64), starts)))
                cols = [pa.array(np.arange(row, row + len(starts))), pa.array(lengths), pa.array(np.add.reduceat(base, starts)), pa.array(np.add.reduceat(model_logs, starts)), pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(h[far].view(np.int64)))]
                row += len(starts)
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(first, last - first), *cols], ["doc_id", "row", "n_tokens", "common_logs", "model_logs", "far"])

    # written once: the rows' numbers must be the same wherever they are read
    rows = cut(docs.select("doc_id", "text").mapInArrow(score, f"doc_id {kind}, row bigint, n_tokens bigint, common_logs double, model_logs double, far array<bigint>"))
    value = F.log10(F.coalesce(F.col("n"), F.lit(0)) + F.lit(0.1))
    met = rows.select("row", F.explode("far").alias("h")).join(words, "h", "left")
    rest = met.groupBy("row").agg(F.sum(value).alias("logs"), F.sum(F.col("n").isNull().cast("long")).alias("unknown"))
    logs = F.coalesce("logs", F.lit(0.0))
    return rows.drop("far").join(rest, "row", "left").select(
        "doc_id",
        F.coalesce(remainder("doc_id", 10) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        (F.col("n_tokens") - F.coalesce("unknown", F.lit(0))).alias("n_known"),
        F.lit(n_all).cast("long").alias("train_tokens"),
        (F.col("common_logs") + logs - F.col("n_tokens") * F.lit(floor)).alias("base_score"),
        (F.col("model_logs") + F.col("common_logs") + logs).alias("score"),
    )
