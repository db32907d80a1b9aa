"""A small table of documents with the awkward cases: nulls, empty texts, repeats, ties, odd characters, a column named like a result."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string"
OWN = ["the", "and", "of", "thing", "idiot", "license", "Über", "año", "x1", "don't", "42", "foo,", "bar."]


def documents() -> list[tuple]:
    r = random.Random(4)
    texts = [" ".join(r.choice(OWN) for _ in range(r.randint(1, 60))) for _ in range(40)]
    texts += [texts[0], texts[1] + " more", texts[2].upper(), None, "", "   \n\t ", "!!! 123 ???", "word", "a\x00b \x1c x y   z　w"]
    texts += ["call +1 (743) 555-3824 or me.b@mail.example.com 10.0.0.1 4539 1488 0343 6467", "x " * 3000 + "the end"]
    texts += ["Released under the MIT License. This work is licensed under the GNU General Public License, version 3.", "CC BY cc-by CC\nBY 4.0 <|endoftext|> done"]
    rows = [(i, t, r.choice(["en", "fr", None]), "src0", len(t) if t else 0, "clash") for i, t in enumerate(texts)]
    return [*rows, rows[3], rows[3]]


def docs(spark):
    return spark.createDataFrame(documents(), SCHEMA)


def none(spark):
    return spark.createDataFrame([], SCHEMA)
