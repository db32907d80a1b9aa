import math
import random
import zlib

import numpy as np
import pytest

from kwloom.llm import quality
from kwloom.llm._util import SpanHasher

from .fixtures import SCHEMA, docs, none

LABELS = "doc_id bigint, quality int, toxic int"


def held(i):
    return zlib.crc32(str(i).encode()) % 5 == 0


def rows(n=900):
    r = random.Random(1)
    word = lambda: "".join(r.choice("abcdefghijklmno") for _ in range(r.randint(2, 8)))
    made = []
    for i in range(n):
        words = [word() for _ in range(r.randint(5, 60))]
        kind = i % 6
        if kind == 0:
            words = [w + "###" for w in words]
        if kind == 1:
            words = [words[0]] * len(words)
        made.append((i, " ".join(words), None, None, 0, "clash"))
    return made


def test_quality(spark):
    made = rows()
    odd = [(5000, None, None, None, 0, ""), (5001, " \n", None, None, 0, ""), (None, "word " * 50_000, None, None, 0, ""), made[4]]
    d = spark.createDataFrame([*made, *odd], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 6 > 1), 0) for i in range(900)] + [(2, None, 1), (3, 0, 0), (9999, 1, 0), (None, 0, 0)], LABELS)
    got = quality.quality(d, labels).collect()
    assert len(got) == 904 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.3) and x.held_out == (x.doc_id is not None and held(x.doc_id)) for x in got)
    right = [x.predicted == int(x.doc_id % 6 > 1) for x in got if x.held_out and x.doc_id < 900]
    assert len(right) > 100 and sum(right) > 0.97 * len(right)
    by = {x.doc_id: x.score for x in got}
    assert by[5000] == by[5001] and by[None] < 0.3
    assert sorted(x.score for x in quality.quality(d.repartition(7), labels).collect()) == sorted(x.score for x in got)
    assert quality.quality(none(spark), labels).count() == 0
    assert {x.score for x in quality.quality(docs(spark), labels.limit(0)).collect()} == {0.5}


def test_scores_match_a_plain_form():
    """Features by slicing, the score from the table itself."""
    hasher, bits = SpanHasher(), 10
    texts = ["a", "ab  cd ab ab", None, "", "é a\tbcdef", "x x x x y"]
    model = quality.Embeddings(bits, 4)
    model.layer = np.random.default_rng(2).normal(size=(2, 4)).astype(np.float32)
    parts, bias = model.logits()
    got = quality.scores(texts, np.rint(parts.astype(float) * quality.WHOLE).astype(np.int64), bias, hasher)
    for t, p in zip(texts, got, strict=True):
        words = (t or "").encode().split()
        line = b" " + b" ".join(words) + b" "
        number = lambda b: int(hasher(np.frombuffer(b, np.uint8), np.array([0]), np.array([len(b)]))[0])
        at = [number(w) >> 64 - bits for w in words]
        at += [0 if a == b else ((number(a) * 0x9E3779B97F4A7C15 + number(b)) * 0xFF51AFD7ED558CCD & (1 << 64) - 1) >> 64 - bits for a, b in zip(words, words[1:], strict=False)]
        for n in (2, 3, 4) if words else ():
            for i in range(len(line) - n + 1):
                g = line[i : i + n]
                if b" " not in g[1:-1] and g != b"  ":
                    key = n
                    for c in g:
                        key = key << 8 | c
                    at.append((key * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - bits)
        z = float(np.mean([parts[i] for i in at])) + bias if at else bias
        assert p == pytest.approx(1 / (1 + math.exp(-z)), abs=1e-5)


def test_a_step_goes_down_the_gradient():
    model = quality.Embeddings(6, 3)
    model.layer = np.random.default_rng(5).normal(size=(2, 3)).astype(np.float32)
    rows_, share = np.array([1, 5, 9], np.int32), np.array([0.5, 0.25, 0.25], np.float32)

    def loss(table, layer):
        z = layer @ (share @ table[rows_])
        return float(np.log(np.exp(z).sum()) - z[1])

    table, layer = model.table.astype(float), model.layer.astype(float)
    model.learn(rows_, share, 1, 1e-3)
    moved = (layer - model.layer) / 1e-3
    for i, j in ((0, 0), (1, 2)):
        up, down = layer.copy(), layer.copy()
        up[i, j] += 1e-4
        down[i, j] -= 1e-4
        assert moved[i, j] == pytest.approx((loss(table, up) - loss(table, down)) / 2e-4, abs=1e-3)
    # the table moves along its gradient, scaled by the share's root
    step = (table - model.table) / 1e-3 * np.sqrt((share * share).sum())
    for i, j in ((1, 0), (9, 2)):
        up, down = table.copy(), table.copy()
        up[i, j] += 1e-4
        down[i, j] -= 1e-4
        assert step[i, j] == pytest.approx((loss(up, layer) - loss(down, layer)) / 2e-4, abs=1e-3)
    assert loss(model.table, model.layer) < loss(table, layer)
