import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kwloom.llm import language, license, neighbours, perplexity, pii, toxicity
from kwloom.llm._util import SpanHasher, labelled

from .fixtures import SCHEMA, docs, documents, none

LOW = {c: c + 32 for c in range(65, 91)}
PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def held(i, of):
    return zlib.crc32(str(i).encode()) % of


def test_toxicity(spark):
    r = random.Random(0)
    text = lambda bad: " ".join(r.choice(["scum", "idiot"]) if bad and k in (3, 7) else f"w{r.randint(0, 300)}" for k in range(30))
    rows = [(i, text(i % 4 == 0), None, None, 0, "clash") for i in range(1200)]
    d = spark.createDataFrame([*rows, (5000, None, None, None, 0, ""), (5001, "", None, None, 0, ""), rows[0]], SCHEMA)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1200)] + [(0, 1, None), (9999, 1, 1)], "doc_id bigint, quality int, toxic int")
    got = toxicity.toxicity(d, labels).collect()
    assert len(got) == 1203 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) and x.held_out == (held(x.doc_id, 4) == 2) for x in got)
    right = [x.predicted == (x.doc_id % 4 == 0) for x in got if x.held_out and x.doc_id < 1200]
    assert sum(right) > 0.95 * len(right)
    kept = {x.doc_id for x in toxicity.acceptable(d, labels).collect()}
    assert kept == {x.doc_id for x in got if not x.predicted}
    odd = d.withColumn("_score", F.lit(1)).withColumn("_SCORE_", F.lit("x"))
    assert toxicity.acceptable(odd, labels).columns == odd.columns and toxicity.acceptable(odd, labels).count() == toxicity.acceptable(d, labels).count()
    lost = spark.createDataFrame([(None, "scum idiot " * 20_000), (None, None)], "doc_id bigint, text string")
    assert [r.predicted for r in toxicity.toxicity(lost, spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1200)], "doc_id bigint, quality int, toxic int")).collect()] == [0, 0]
    assert toxicity.toxicity(none(spark), labels).count() == 0
    assert {x.score for x in toxicity.toxicity(d, labels.limit(0)).collect()} == {0.0}


def test_toxicity_learns_in_a_task(spark, monkeypatch):
    monkeypatch.delattr(toxicity.Ftrl, "learn")  # in the driver only
    d = spark.createDataFrame([(i, "bad word" if i % 2 else "good text") for i in range(200)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id bigint, toxic int")
    used, weights, bias = toxicity.train(d, labels)
    assert len(used) == len(weights) > 0 and weights.all() and np.isfinite(bias)
    assert toxicity.train(d, labels.limit(0))[2] == -np.inf


def test_toxicity_learns_from_a_block_of_texts_at_a_time(monkeypatch):
    texts = [None, "", *[f"w{i} v{i} " * 500 for i in range(600)], "z " * 300_000, "last one"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([i % 2 for i in range(len(texts))]), pa.array(texts)], ["key", "label", "text"])
    whole, seen = toxicity.features, []
    at, starts = whole(texts, SpanHasher())

    def noted(some, *rest):
        seen.append(max(sum(len(t or "") for t in some[:-1]), 0))
        return whole(some, *rest)

    monkeypatch.setattr(toxicity, "features", noted)
    got = [r for b in toxicity.counted([batch]) for r in b.to_pylist()]
    assert max(seen) < 1 << 18 and len(seen) > 10
    assert [r["key"] for r in got] == list(range(len(texts))) and [r["toxic"] for r in got] == [i % 2 for i in range(len(texts))]
    assert [r["at"] for r in got] == [np.unique(at[s:e]).astype(np.int32).tobytes() for s, e in zip(starts, starts[1:], strict=False)]


def test_labelled_rows_are_bounded(spark):
    """One id with very many rows, and long texts: at most `rows` rows and `size` bytes are learnt from, of each (id, text) one."""
    hot = spark.createDataFrame([(1, f"text {i % 5000}") for i in range(20_000)] + [(2, "x" * 1000), (2, "x" * 1000), (3, "y" * 10), (4, None), (None, "z"), (5, "no label")], "doc_id bigint, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (3, 0), (4, 1), (None, 1), (5, None)], "doc_id bigint, toxic int")
    every = labelled(hot, marks, "toxic", F.lit(True), 10_000, 1 << 30).collect()
    assert Counter((len(r.text or ""), r.label) for r in every if (r.text or "")[:4] != "text") == {(1000, 1): 1, (10, 0): 1, (0, 1): 1} and len(every) == 5003
    assert len(labelled(hot, marks, "toxic", F.lit(True), 10, 1 << 30).collect()) == 10
    some = labelled(hot, marks, "toxic", F.lit(True), 10_000, 500).collect()
    assert 0 < len(some) and (sum(len(r.text or "") for r in some) <= 500 or len(some) == 1)
    assert len(labelled(hot, marks, "toxic", F.lit(True), 10_000, 0).collect()) >= 1
    used, _, _ = toxicity.train(hot, marks, rows=10)
    assert len(used) < 200


def test_ftrl_matches_a_plain_form():
    """The vectorised learner against the update rule written out for one coordinate at a time."""
    r = random.Random(9)
    rows = [(sorted(r.sample(range(12), r.randint(1, 6))), r.randint(0, 1)) for _ in range(300)]
    m = toxicity.Ftrl(4)
    z, n = Counter(), Counter()

    def weight(i):
        l1 = 0.0 if i == 16 else 2.0
        return 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.3 + 0.5)

    for at, label in rows:
        m.learn(np.append(at, 16), label)
        w = {i: weight(i) for i in [*at, 16]}
        g = 1 / (1 + math.exp(-sum(w.values()))) - label
        for i, x in w.items():
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / 0.3 * x
            n[i] += g * g
    assert np.allclose(m.weights(np.arange(17)), [weight(i) for i in range(17)])


def base(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if pii.valid(pii.KINDS[k], m[0]))


def test_pii_patterns(spark):
    r = random.Random(2)
    for _ in range(4000):
        s = "".join(r.choice("a@.1 2-+(") for _ in range(40))
        assert pii.base_spans(s) == base(s), s
    for r_ in pii.find(docs(spark)).collect():
        b = base(dict((x[0], x[1]) for x in documents())[r_.doc_id])
        assert [r_.n_email, r_.n_ip, r_.n_card, r_.n_phone] == [sum(x[1] == k for x in b) for k in range(4)]
        assert r_.base_sha256 == hashlib.sha256(pii.joined(b).encode()).hexdigest()
        assert set(filter(None, pii.joined(b).split(","))) <= set(r_.spans.split(","))
    assert pii.find(docs(spark)).count() == len(documents()) and pii.find(none(spark)).count() == 0


def test_pii_network(spark):
    ids, tags = pii.examples(200, seed=77)
    tagger = pii.trained()
    assert (tagger.viterbi(tagger.emissions(ids)) == tags).mean() > 0.95
    small = pii.Tagger(4, 3, 1)
    small.p = {k: v.astype(float) for k, v in small.p.items()}
    few = ids[:9, :3], tags[:9, :3]
    grads = small.gradients(*few)[1]
    for name, g in grads.items():
        at = tuple(n // 2 for n in g.shape) if name != "emb" else (int(ids[4, 1]), 1)
        small.p[name][at] += 1e-4
        up = small.gradients(*few)[0]
        small.p[name][at] -= 2e-4
        down = small.gradients(*few)[0]
        small.p[name][at] += 1e-4
        assert abs((up - down) / 2e-4 - g[at]) < 2e-3, name
    _, spans = pii.all_spans(tagger, ["please call (743) 555-3824 now, thanks"])[0]
    assert spans == [(12, 3, 26)]
    texts = ["mail john_d4 at example dot com today", "we met at noon. Then dot by dot", "at 10.30 on 2001-02-03, " + "12 " * 400]
    assert [len(s) - len(b) for b, s in pii.all_spans(tagger, texts)] == [1, 0, 0]
    rng, want, added = np.random.default_rng(123), set(), set()
    for n in range(60):
        text, tag = pii.passage(rng, 600)
        begins = [i for i in range(len(text)) if tag[i] % 2]
        gold = {(i, tag[i] // 2, next((j for j in range(i + 1, len(text)) if tag[j] != tag[i] + 1), len(text))) for i in begins}
        b, spans = pii.all_spans(tagger, [text])[0]
        want |= {(n, *g) for g in gold if not any(y[0] < g[2] and g[0] < y[2] for y in b)}
        added |= {(n, *x) for x in set(spans) - set(b)}
    assert len(added & want) > 0.98 * len(added) and len(added & want) > 0.75 * len(want)
    # a run of many pieces gives the spans of its parts
    part = "call (743) 555-3824 or 10 . 20 . 30 . 40 now 17 and 18; "
    one, many = pii.all_spans(tagger, [part * 8])[0][1], pii.all_spans(tagger, [part * 800])[0][1]
    assert len(one) == 16 and len(many) >= 0.99 * 1600
    assert pii.mask("a b@c.de 1", [(2, 0, 8)]) == "a [EMAIL] 1"
    out = {r.doc_id: r for r in pii.masked(docs(spark)).collect()}
    for i, t, *_ in documents():
        assert (out[i].text != t) >= bool(base(t)) and out[i].n_chars == (None if t is None else len(out[i].text))
    long = "x" * 100_000 + " 10.0.0.1 " + "7" * 100_000
    assert pii.base_spans(long) == base("y" * 100_000 + " 10.0.0.1 ")


def phrases(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOW))
    places = [(i, label) for p, label in license.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    return len(w), len(places), min((i for i, _ in places), default=None), max((i for i, _ in places), default=None), ",".join(sorted({x for _, x in places}))


def test_license(spark):
    rows = documents() + [(200 + i, t, None, None, 0, "") for i, t in enumerate(["mit mit license license apache license gnu general public license cc by cc by", "MIT-License! CC  BY", "the license of mit", "Licensed under the Apache License, Version 2.0.", "K mit license İ", "x Permission is hereby granted, free of charge, to any person obtaining a copy of this software"])]
    got = license.scan(spark.createDataFrame(rows, SCHEMA)).collect()
    want = {r[0]: phrases(r[1]) for r in rows}
    assert len(got) == len(rows)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want[r.doc_id], r
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1 + 1e-9
        assert (r.score > 0) == bool(r.labels)
    by = {r.doc_id: r for r in got}
    assert by[203].labels == "apache,apache-2.0" and abs(by[203].score - 1) < 1e-9
    assert "gpl-3.0" in by[51].labels and "mit-notice" in by[51].labels and by[205].labels == "mit-grant"
    assert license.scan(none(spark)).count() == 0
    counts = license.document_frequencies(spark.createDataFrame(rows, SCHEMA))
    sets = [set(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (r[1] or "").translate(LOW))) for r in rows]
    assert {w: sum(w in x for x in sets) for w in license.vocabulary()} == {w: counts.get(w, 0) for w in license.vocabulary()} and counts[""] == len(rows)
    long = spark.createDataFrame([(None, "x " * 200_000 + "released under the MIT license"), (1, None)], "doc_id bigint, text string")
    assert [(r.doc_id, r.n_words, r.base_labels, r.labels) for r in license.scan(long).orderBy("n_words").collect()] == [(1, 0, "", ""), (None, 200_005, "mit", "mit,mit-notice")]


def test_perplexity(spark):
    rows = documents()
    got = perplexity.scores(docs(spark), common=8).collect()
    words = lambda t: [w for w in re.split(r"[\x20\x09-\x0D]+", (t or "").translate(LOW)) if w] + [None]
    counts = Counter(w for r in rows if held(r[0], 10) for w in words(r[1]))
    n, v = sum(counts.values()), len(counts)
    want = {r[0]: (len(words(r[1])), sum(w in counts for w in words(r[1])), sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words(r[1]))) for r in rows}
    assert len(got) == len(rows)
    for r in got:
        a, b, c = want[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(r.doc_id, 10) == 0, a, b, n)
        assert abs(r.base_score - c) < 1e-6 * abs(c) + 1e-9 and r.score < 0
    assert perplexity.scores(none(spark)).count() == 0
    assert {(r.n_known, r.train_tokens) for r in perplexity.scores(docs(spark).filter("crc32(cast(doc_id as string)) % 10 = 0")).collect()} == {(0, 0)}


def small_model(texts, bits=10):
    """The model of texts in this process, and counts by hash: what the executors' tables hold."""
    data = perplexity.tokens(texts, SpanHasher())
    hashes, at, n = np.unique(data[0], return_index=True, return_counts=True)
    pairs = np.zeros(1 << perplexity.ENDINGS + perplexity.NEIGHBOURS)
    np.add.at(pairs, data[1] << perplexity.NEIGHBOURS | perplexity.before(data[1], data[2], 1, 0) >> perplexity.ENDINGS - perplexity.NEIGHBOURS, 1)
    classes = perplexity.word_classes(pairs.reshape(1 << perplexity.ENDINGS, -1))
    counts, kinds = np.zeros((2, perplexity.CLASSES, perplexity.GROUPS))
    m = perplexity.Model(classes, counts, kinds, bits)
    c, g = m.place(hashes, data[1][at])
    np.add.at(counts, (c, g), n)
    np.add.at(kinds, (c, g), 1)
    return perplexity.Model(classes, counts, kinds, bits), data, dict(zip(hashes.tolist(), n.tolist(), strict=True)), data[1][at]


def test_perplexity_is_a_distribution_and_learns():
    r = random.Random(1)
    texts = [" ".join(f"w{i % 7}a" if r.random() < 0.9 else f"{r.randint(0, 99)}b" for i in range(300)) for _ in range(10)]
    m, data, counts, endings = small_model(texts)
    zero = m.log_probabilities(*data).mean()
    sums = np.zeros(m.outer.shape, np.float32), np.zeros(m.inner.shape, np.float32)
    m.add_counts(*data, sums)
    m.first_step(sums)
    first = m.log_probabilities(*data).mean()
    for _ in range(3):
        sums = np.zeros(m.outer.shape, np.float32), np.zeros(m.inner.shape, np.float32)
        m.add_gradients(*data, sums)
        m.step(sums, 1.0)
    assert m.log_probabilities(*data).mean() > first > zero + 0.3
    # over all words and, in each group, one unseen word the probabilities add up to 1 in any context
    classes, groups = m.place(data[0], data[1])
    outer, inner = m.rows(data[0], classes, data[2])
    at = 5
    logits = m._logits(m.outer, outer[[at]], m.outer_share)
    total = 0.0
    for c in range(perplexity.CLASSES):
        rows = m.rows(data[0], np.where(np.arange(len(classes)) == at, c, classes), data[2])[1][[at]]
        own = np.exp(m._logits(m.inner, rows, m.inner_share[[c]]))[0]
        held = np.zeros(perplexity.GROUPS)
        for h, e in zip(np.array(list(counts), np.uint64), endings, strict=True):
            k, g = m.place(np.array([h]), np.array([e]))
            held[g[0]] += (counts[int(h)] + 0.1) * (k[0] == c)
        total += np.exp(logits)[0, c] / np.exp(logits).sum() * (own / own.sum() * (held + 0.1) / m.mass[c]).sum()
    assert abs(total - 1) < 1e-4


def test_perplexity_gradients_match_differences():
    m, data, *_ = small_model(["a b c a b d", "b c a", ""], bits=6)
    rng = np.random.default_rng(0)
    m.outer[:] = rng.standard_normal(m.outer.shape) / 3
    m.inner[:] = rng.standard_normal(m.inner.shape) / 3
    sums = np.zeros(m.outer.shape, np.float32), np.zeros(m.inner.shape, np.float32)
    m.add_gradients(*data, sums)
    classes = m.place(data[0], data[1])[0]
    for weights, rows, g in zip((m.outer, m.inner), m.rows(data[0], classes, data[2]), sums, strict=True):
        row, col = int(rows[3, 0]), 2
        weights[row, col] += 1e-2
        up = m.log_probabilities(*data).sum()
        weights[row, col] -= 2e-2
        down = m.log_probabilities(*data).sum()
        weights[row, col] += 1e-2
        assert abs((down - up) / 2e-2 - g[row, col]) < 1e-2


def test_every_training_document_is_counted_and_in_one_softmax_gradient(spark, monkeypatch):
    rounds, whole = [], perplexity._summed

    def summed(learn, model, first):
        rounds.append((first, sorted(r.text or "" for r in learn.select("text").collect())))
        return whole(learn, model, first)

    monkeypatch.setattr(perplexity, "_summed", summed)
    perplexity.train(docs(spark), perplexity.word_counts(docs(spark)))
    learnt = sorted(r[1] or "" for r in documents() if held(r[0], 10))
    assert [t for first, t in rounds if first] == [learnt]
    assert sorted(x for first, t in rounds if not first for x in t) == learnt


def test_perplexity_learns_from_every_word_and_counts_like_a_dictionary(spark):
    counts = perplexity.word_counts(docs(spark)).toPandas()
    words = counts[counts.ending >= 0]
    want = Counter(w for r in documents() if held(r[0], 10) for w in [*(r[1] or "").translate(LOW).encode().split(), b"\n"])
    assert sorted(words.n) == sorted(want.values())
    assert counts[counts.ending < 0].n.sum() == sum(want.values())
    long = spark.createDataFrame([(1, "long " * 60_000), (None, "no id"), (2, "x" * 300_000)], "doc_id bigint, text string")
    got = {r.doc_id: r for r in perplexity.scores(long).collect()}
    assert got[1].n_tokens == 60_001 and got[None].n_tokens == 3 and got[None].n_known == 1 and not got[None].held_out and got[2].n_tokens == 2


def test_language(spark):
    r = random.Random(3)
    make = {"en": "the of and to in is that it was for with".split(), "de": "der die und das nicht ist mit auf für ein über".split()}
    rows = [(i, " ".join(r.choice(make[k]) for _ in range(12)), k, None, 0, "clash") for i in range(300) for k in [r.choice(["en", "de"])]]
    odd = [(900, None, "en", None, 0, ""), (901, "", "en", None, 0, ""), (902, "123 !!", None, None, 0, ""), (903, "the that", None, None, 0, "")]
    got = language.identify(spark.createDataFrame([*rows, *odd, rows[0]], SCHEMA)).collect()
    want = {x[0]: x[2] for x in rows} | {900: "und", 901: "und", 902: "und", 903: "en"}
    assert len(got) == 305 and all(g.lang_pred == want[g.doc_id] and 0 <= g.score <= 1 and g.held_out == (held(g.doc_id, 3) == 1) for g in got)
    assert language.identify(none(spark)).count() == 0
    assert {g.lang_pred for g in language.identify(docs(spark).selectExpr("doc_id", "text", "cast(null as string) lang")).collect()} == {"und"}


def test_language_of_many_copies_is_learnt(spark):
    copies = [(i, "der die und das nicht ist mit auf", "de", None, 0, "") for i in [next(k for k in range(99) if held(k, 3) != 1)] * 20_000]
    rows = [*copies, *[(i, f"the of and to in is {i}", "en", None, 0, "") for i in range(50)]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert language.train(df, rows=10).languages == ["de", "en"]
    probe = spark.createDataFrame([(None, "das ist nicht", "en", None, 0, ""), (7, "in the " * 30_000, None, None, 0, "")], SCHEMA)
    got = {r.doc_id: (r.lang_pred, r.held_out) for r in language.identify(df.unionByName(probe)).filter("doc_id is null or doc_id = 7").distinct().collect() if r.doc_id is None}
    assert got == {None: ("de", False)}


def test_language_of_long_texts_is_learnt(spark):
    r = random.Random(8)
    long = lambda: " ".join(r.choice("der die und das nicht ist mit auf".split()) for _ in range(400))
    rows = [(i, long(), "de") for i in range(6)] + [(i + 50, f"the of and to in is that it was {i}", "en") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    cut, bounded = language.train(df, longest=200), language.train(df, size=100)
    assert cut.languages == bounded.languages == ["de", "en"]
    assert [m.bits(["das ist nicht mit", "it was the"]).argmin(1).tolist() for m in (cut, bounded)] == [[0, 1], [0, 1]]


def test_language_costs_match_a_plain_tree():
    texts = {"a": ["banana band", "ananas"], "b": ["abba cabbage"]}
    counts = {x: Counter((k, bytes(4 + 0)[:0] + (bytes(4) + t.encode())[i + 4 - k : i + 5]) for t in ts for i in range(len(t.encode())) for k in range(5)) for x, ts in texts.items()}
    names, langs, keys, ns = sorted(texts), [], [], []
    for x, c in counts.items():
        for (k, s), n in c.items():
            langs.append(names.index(x))
            keys.append((k + 1) << 8 * (k + 1) | int.from_bytes(s, "big"))
            ns.append(n)
    m = language.Model(names, np.array(langs), np.array(keys, np.uint64), np.array(ns))

    def cost(c, s, k):
        if k < 0:
            return 8.0
        seen = {x[1][-1]: n for x, n in c.items() if x[0] == k and x[1][:-1] == s[:-1]}
        if not seen:
            return cost(c, s[1:], k - 1)
        n, d = sum(seen.values()), len(seen)
        return -math.log2(seen[s[-1]] / (n + d)) if s[-1] in seen else -math.log2(d / (n + d)) + cost(c, s[1:], k - 1)

    tests = ["banana", "zzbanab", "", "abbey é", "cabbage ananas"]
    want = [[sum(cost(counts[x], (bytes(4) + t.encode())[i : i + 5], 4) for i in range(len(t.encode()))) for x in names] for t in tests]
    assert np.allclose(m.bits(tests), want, rtol=1e-4)


def test_neighbours(spark):
    rng = np.random.default_rng(1)
    v = rng.standard_normal((400, 16)).astype(np.float32)
    v[7] = v[8] = v[9]
    rows = [(i, [float(x) for x in r], 0) for i, r in enumerate(v)]
    bad = [(1000, None, 0), (1100, [0.0] * 16, 0), (1200, [float("nan")] * 16, 0), (1300, [None] * 16, 0), (1400, [1.0] * 3, 0), (1500, [float("inf")] * 16, 0)]
    df = spark.createDataFrame([*rows, *bad, rows[5]], "vec_id bigint, embedding array<float>, score int")
    got = sorted(tuple(r) for r in neighbours.search(df, "vec_id % 7 = 0", chunk=90, block=20).collect())
    want, x = [], v.astype(float)
    for q in range(0, 400, 7):
        d = np.sqrt(((x - x[q]) ** 2).sum(1))
        near = [i for i in np.lexsort((np.arange(400), d)) if i != q][:10]
        want += [(q, k + 1, int(i), d[i]) for k, i in enumerate(near)]
    hit = len({(a, c) for a, _, c, _ in got} & {(a, c) for a, _, c, _ in want}) / len(want)
    assert hit > 0.99 and len(got) == len(want)
    assert np.allclose([g[3] for g in got], [w[3] for w in sorted(want)], rtol=1e-9)
    # copies of a vector: the smaller ids are nearest, and a repeated vec_id counts with its smallest vector
    same = spark.createDataFrame([*[(i, [1.0, 2.0], 0) for i in range(40)], *[(100 + i, [float(i), 0.5], 0) for i in range(5)], (3, [9.0, 9.0], 0)], "vec_id bigint, embedding array<float>, score int")
    near = sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in neighbours.search(same, "vec_id in (0, 20, 39)", chunk=7, block=1).collect())
    assert near == [(q, n + 1, i, 0.0) for q in (0, 20, 39) for n, i in enumerate([i for i in range(40) if i != q][:10])]
    few = neighbours.search(df.filter("vec_id < 4"), "vec_id = 0").collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert neighbours.search(df.limit(0), "vec_id = 0").count() == 0
