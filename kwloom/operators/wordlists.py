"""Word lists met by one multi-pattern automaton (Aho-Corasick), and the findings that ask for a list and a context.

`hits` looks every distinct value up once for all lists together: the automaton reads a value from its first letter to its last whatever the
number of words, where a chain of contains() reads it once for each. What it finds is a row a value, so it joins back to where values came from.

Cases: values are looked at in lower case; a null or empty value has no hits; a word found several times in a value is one hit; a list
without words has none; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Terms of games and news, and names of communities where they belong.
CONTEXTS = {
    "gaming": (["hollow knight", "silksong", "marvel rivals", "steam", "nintendo"], ["gaming", "game", "nintendo", "steam"]),
    "news": (["breaking news", "world news", "headline"], ["news", "politics", "world"]),
}
# Brands, by pieces of a term that name them; the first may stand anywhere.
BRANDS = {"reddit": ["ask reddit", "askreddit"], "steam": ["steam", "steampowered"], "nintendo": ["nintendo"], "youtube": ["youtube"]}
ANYWHERE = ["reddit"]
# Words that hold a composed phrase together, and fields of meaning by pieces of words.
HOLDING = "the and of in to for with a an is are".split()
FIELDS = {
    "technology": "app software computer phone digital online website".split(),
    "entertainment": "movie show game music video youtube netflix".split(),
    "food": "food restaurant cooking recipe eat drink pizza chicken".split(),
    "emotion": "happy sad angry funny scared excited love hate".split(),
    "location": "city country home office school hospital store".split(),
    "action": "running walking eating sleeping working playing watching".split(),
    "time": "day night week month year time today tomorrow".split(),
}


class Automaton:
    """All words of all lists in one automaton; a word may be in several lists."""

    def __init__(self, lists: Mapping[str, Sequence[str]]) -> None:
        import ahocorasick

        owners: dict[str, list[tuple[str, str]]] = {}
        for name, words in lists.items():
            for w in words:
                if w:
                    owners.setdefault(w.lower(), []).append((name, w))
        self.found = ahocorasick.Automaton()
        for w, own in owners.items():
            self.found.add_word(w, own)
        self.any = bool(owners)
        if self.any:
            self.found.make_automaton()

    def __call__(self, value: str | None) -> list[tuple[str, str]]:
        """The (list, word) pairs that a value holds, once each, sorted."""
        if not value or not self.any:
            return []
        return sorted({pair for _, own in self.found.iter(value.lower()) for pair in own})


def hits(values: DataFrame, column: str, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """(column, hits): of each distinct value that holds a word of a list, the pairs (list, word), sorted."""
    kind = "array<struct<list:string,word:string>>"
    lists = {k: list(v) for k, v in lists.items()}

    def look(batches):
        automaton = Automaton(lists)
        for b in batches:
            asked = b.column(0).to_pylist()
            found = [automaton(v) for v in asked]
            rows = [(v, [{"list": x, "word": w} for x, w in f]) for v, f in zip(asked, found, strict=True) if f]
            if rows:
                cols = pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.list_(pa.struct([("list", pa.string()), ("word", pa.string())])))
                yield pa.RecordBatch.from_arrays(list(cols), [column, "hits"])

    return values.select(column).distinct().mapInArrow(look, f"`{column}` string, hits {kind}")


def listed(values: DataFrame, column: str, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """The rows of values with `lists`, the names of the lists that the column's value holds a word of (sorted), and `hits`."""
    found = hits(values, column, lists)
    none = F.array().cast("array<struct<list:string,word:string>>")
    out = values.join(found, column, "left").withColumn("hits", F.coalesce("hits", none))
    return out.withColumn("lists", F.array_sort(F.array_distinct(F.transform("hits", lambda x: x["list"])))).select(*values.columns, "lists", "hits")


def mismatches(keywords: DataFrame, names: DataFrame, key: str, top: int = 15) -> DataFrame:
    """(key, rank, term, context) of best terms from a context that the community's name, names(key, name), doesn't speak of."""
    return _misplaced(keywords.filter(F.col("rank") <= top), names, key, {c: w for c, (w, _) in CONTEXTS.items()}, {c: w for c, (_, w) in CONTEXTS.items()}).withColumnRenamed("list", "context")


def brand_misuse(keywords: DataFrame, names: DataFrame, key: str, top: int = 20, least: int = 3) -> DataFrame:
    """(key, rank, term, brand) of composed best terms of `least` words or more with a brand that the community's name doesn't hold."""
    some = _composed(keywords, top, least)
    return _misplaced(some, names, key, {b: w for b, w in BRANDS.items() if b not in ANYWHERE}, {b: [b] for b in BRANDS if b not in ANYWHERE}).withColumnRenamed("list", "brand")


def _misplaced(keywords: DataFrame, names: DataFrame, key: str, terms: Mapping[str, Sequence[str]], contexts: Mapping[str, Sequence[str]]) -> DataFrame:
    """(key, rank, term, list): terms with a word of a list whose community's name has none of the list's context; a community without a name has none."""
    found = listed(keywords.select(key, "rank", "term"), "term", terms).filter("size(lists) > 0")
    known = listed(names.select(key, "name").filter("name is not null"), "name", contexts).groupBy(key).agg(F.array_distinct(F.flatten(F.collect_list("lists"))).alias("own"))
    out = found.join(known, key, "left").withColumn("list", F.explode(F.array_except("lists", F.coalesce("own", F.array().cast("array<string>")))))
    return out.select(key, "rank", "term", "list")


def _words(term: Column) -> Column:
    return F.filter(F.split(term, r"\s+"), lambda w: w != "")


def _composed(keywords: DataFrame, top: int, least: int) -> DataFrame:
    return keywords.filter((F.col("rank") <= top) & F.col("source").contains("composed") & (F.size(_words(F.col("term"))) >= least))


def fragmented(keywords: DataFrame, key: str, top: int = 20, fields: int = 2) -> DataFrame:
    """(key, rank, term, lists) of composed best terms of four words or more, none of which holds the phrase together, from more than two fields of meaning."""
    some = _composed(keywords, top, 4).filter(~F.arrays_overlap(_words(F.lower("term")), F.array(*[F.lit(w) for w in HOLDING])))
    return listed(some.select(key, "rank", "term"), "term", FIELDS).filter(F.size("lists") > fields).drop("hits")
