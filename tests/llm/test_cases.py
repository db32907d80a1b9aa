"""Rows without an id, very long texts and repeated rows, in the operators that treat each row by itself."""

import hashlib

import pytest

from kwloom.llm import bpe, language, license, perplexity, pii, quality, tokenfile, toxicity, winnow

TEXTS = ["call +1 (743) 555-3824 or me.b@mail.example.com from 10.0.0.1", "under the mit license or apache", "x y " * 50_000 + "MIT License a@b.co", "", None, "   \n", "é 的 \U0001f600 end"]


def rows(spark):
    """Each text with an id, twice, and without one."""
    return spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] * 2 + [(None, t) for t in TEXTS] * 2, "doc_id bigint, text string")


def apply(spark, name):
    d = rows(spark)
    labels = spark.createDataFrame([(i, i % 2, 1 - i % 2) for i in range(7)], "doc_id bigint, quality int, toxic int")
    return {
        "pii": lambda: pii.find(d), "license": lambda: license.scan(d), "bpe": lambda: bpe.round_trip(d),
        "winnow": lambda: winnow.contamination(d, spark.createDataFrame([(1, "x y " * 6), (None, "under the mit license or apache")], "item_id bigint, text string")),
        "tokenfile": lambda: tokenfile.token_file_digest(d).drop("start"), "toxicity": lambda: toxicity.toxicity(d, labels).drop("held_out"), "quality": lambda: quality.quality(d, labels).drop("held_out"),
        "perplexity": lambda: perplexity.scores(d).drop("held_out"), "language": lambda: language.identify(d.selectExpr("*", "if(doc_id % 2 = 0, 'en', 'de') lang")).drop("held_out"),
    }[name]()


@pytest.mark.parametrize("name", ["pii", "license", "bpe", "winnow", "tokenfile", "toxicity", "quality", "perplexity", "language"])
def test_a_row_without_an_id_gets_what_its_text_gets(spark, name):
    got = [r.asDict() for r in apply(spark, name).collect()]
    assert len(got) == 4 * len(TEXTS)
    plain = lambda r: repr(sorted((k, v) for k, v in r.items() if k != "doc_id"))
    with_id, without = (sorted(plain(r) for r in got if (r["doc_id"] is None) == none) for none in (False, True))
    assert with_id == without
    by_id = {}
    for r in got:
        if r["doc_id"] is not None:
            by_id.setdefault(r["doc_id"], set()).add(plain(r))
    assert set(by_id) == set(range(len(TEXTS))) and all(len(v) == 1 for v in by_id.values())


def test_long_and_empty_texts_have_their_plain_values(spark):
    got = {r.doc_id: r for r in pii.find(rows(spark)).collect()}
    assert got[2].n_email == 1 and got[3].base_sha256 == got[4].base_sha256 == hashlib.sha256(b"").hexdigest() and got[0].n_phone == got[0].n_ip == 1
    words = {r.doc_id: (r.n_words, r.base_labels) for r in license.scan(rows(spark)).collect()}
    assert words[2] == (100_005, "mit") and words[3] == words[4] == (0, "")
    hit = {r.doc_id: (r.n_words, r.n_hit, r.n_items) for r in winnow.contamination(rows(spark), spark.createDataFrame([(1, "x y " * 6)], "item_id bigint, text string")).collect()}
    assert hit[2] == (100_005, 100_000, 1) and hit[3] == hit[4] == (0, 0, 0)
