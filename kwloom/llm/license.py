"""Licence scan with a positional rare-token index, in DataFrame functions alone.

Templates (notices and bare phrases) are kept as postings token -> (template, position), for their rarest tokens. IDFs come from the
whole corpus: in how many of all documents each licence word occurs (one aggregate over the table, a row a licence word). A document looks up its licence words; each word and posting names the
place where the template would begin, and words of one template that name the same place are the intersection of its postings.
Such a place counts when the words found there hold enough of the template's IDF and its mandatory key phrase stands at its
place word by word. The bare phrases are templates that are all key phrase, so their places are exact.

Everything is decided within a row: nothing but the licence words' document frequencies is shuffled, so neither copies nor a hot
source make a large task.

Cases: a null text counts as empty; no words or no licence gives zero counts, empty labels and score 0; a null doc_id is an id as any other; repeated
rows are scanned each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bare phrases and their labels.
PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

#: Notices, as (label, words, mandatory key phrase).
NOTICES = [
    ("gpl-3.0", "this work is licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "you can redistribute it and or modify it under the terms of the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("agpl", "under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("mit-notice", "released under the mit license", "under the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted free of charge"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc0", "released under cc0 1 0 universal", "cc0 1 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use copy modify and or distribute this software"),
    ("proprietary", "all rights reserved", "all rights reserved"),
]

RARE, SHARE = 5, 0.6
#: A text with no match of this has none of the templates' key phrases.
GATE = r"(?i)licen[cs]e|permission|redistribution|cc0|rights[^0-9A-Za-z\x{80}-\x{10FFFF}]+reserved|cc[^0-9A-Za-z\x{80}-\x{10FFFF}]+by"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: ASCII that is in no word.
BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())


def templates() -> list[dict]:
    """Words, label, key phrase with its place, and whether it is a bare phrase, of every template."""
    bare = [{"label": label, "words": p.split(), "key": p.split(), "at": 0, "bare": True} for p, label in PHRASES.items()]
    out = list(bare)
    for label, notice, key in NOTICES:
        words, phrase = notice.split(), key.split()
        at = next(i for i in range(len(words)) if words[i : i + len(phrase)] == phrase)
        out.append({"label": label, "words": words, "key": phrase, "at": at, "bare": False})
    return out


def vocabulary() -> list[str]:
    return sorted({w for t in templates() for w in t["words"]})


def _words(text: Column) -> Column:
    """The text's words in lower case (A-Z only)."""
    plain = F.trim(F.translate(text, UPPER + BETWEEN, LOWER + " " * len(BETWEEN)))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, " +"))


def document_frequencies(docs: DataFrame) -> dict[str, int]:
    """In how many of all documents each licence word occurs; under the empty word, how many documents there are."""
    known = F.array(*[F.lit(w) for w in vocabulary()])
    held = F.array_append(F.array_intersect(_words(F.coalesce("text", F.lit(""))), known), F.lit(""))
    return {r.w: r["count"] for r in docs.select(F.explode(held).alias("w")).groupBy("w").count().collect()}  # a row a licence word


def inverse_frequencies(counts: dict[str, int]) -> dict[str, float]:
    """The IDF of each licence word."""
    return {w: math.log((1 + counts.get("", 0)) / (1 + counts.get(w, 0))) + 1 for w in vocabulary()}


def _named(word: str, at: int) -> Column:
    return F.transform(F.filter("found", lambda x: x["w"] == F.lit(word)), lambda x: x["i"] - F.lit(at))


def _rare(t: dict, idf: dict[str, float]) -> list[int]:
    """The template's rarest words, by place; a bare phrase is looked up by its one rarest word: the key phrase then decides."""
    return sorted(range(len(t["words"])), key=lambda i: (-idf[t["words"][i]], i))[: 1 if t["bare"] else RARE]


def _places(t: dict, idf: dict[str, float]) -> Column:
    """Where the template begins: sorted places at which enough of its rare words' IDF and its key phrase stand."""
    rare = _rare(t, idf)
    # places of each rare word in the document, less its place in the template
    lists = [_named(t["words"][i], i) for i in rare]
    named = F.array_distinct(F.flatten(F.array(*lists)))
    total = sum(idf[t["words"][i]] for i in rare)

    def stands(at: Column, i: int, w: str) -> Column:
        return F.get(F.col("words"), at + i) == F.lit(w)

    def counts(at: Column) -> Column:
        share = sum((F.when(stands(at, i, t["words"][i]), F.lit(idf[t["words"][i]] / total)).otherwise(F.lit(0.0)) for i in rare), F.lit(0.0))
        whole = F.lit(True)
        for j, w in enumerate(t["key"]):
            whole = whole & F.coalesce(stands(at, t["at"] + j, w), F.lit(False))
        return whole & (share >= SHARE - 1e-9)

    return F.array_sort(F.filter(named, counts))


def _share(t: dict, idf: dict[str, float], places: Column) -> Column:
    """The largest part of the template's whole IDF that stands at one of its places."""
    total = sum(idf[w] for w in t["words"])

    def held(at: Column) -> Column:
        return sum((F.when(F.get(F.col("words"), at + i) == F.lit(w), F.lit(idf[w] / total)).otherwise(F.lit(0.0)) for i, w in enumerate(t["words"])), F.lit(0.0))

    return F.coalesce(F.array_max(F.transform(places, held)), F.lit(0.0))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row of docs(doc_id, text)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    idf, every = inverse_frequencies(document_frequencies(docs)), templates()
    rows = docs.select("doc_id", F.col("text").rlike(GATE).alias("gate"), _words(text).alias("words"))
    empty = F.array().cast("array<string>")
    rows = rows.select("doc_id", F.size("words").cast("long").alias("n_words"), F.when(F.col("gate"), F.col("words")).otherwise(empty).alias("words"))
    # the places of the words that some template is looked up by
    sought = F.array(*[F.lit(w) for w in sorted({t["words"][i] for t in every for i in _rare(t, idf)})])
    rows = rows.withColumn("found", F.filter(F.transform("words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: F.array_contains(sought, x["w"])))
    rows = rows.select("doc_id", "n_words", "words", *[_places(t, idf).alias(f"t{j}") for j, t in enumerate(every)])
    bare = [f"t{j}" for j, t in enumerate(every) if t["bare"]]
    none = F.lit(None).cast("string")
    label = lambda only: F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*[F.when(F.size(f"t{j}") > 0, F.lit(t["label"])).otherwise(none) for j, t in enumerate(every) if t["bare"] or not only])))), ",")
    return rows.select(
        "doc_id",
        "n_words",
        sum((F.size(c) for c in bare), F.lit(0)).cast("long").alias("n_base"),
        F.array_min(F.flatten(F.array(*bare))).cast("long").alias("first_word"),
        F.array_max(F.flatten(F.array(*bare))).cast("long").alias("last_word"),
        label(True).alias("base_labels"),
        label(False).alias("labels"),
        # parts of a whole may add up to a little over one
        F.least(F.lit(1.0), F.greatest(*[_share(t, idf, F.col(f"t{j}")) for j, t in enumerate(every)])).alias("score"),
    )
