"""Text functions on columns, all Catalyst expressions, and `segment`, which operators.segment applies to distinct words."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import CJK, CYRILLIC, DOMAINS, EXPANSIONS, FILE_ENDINGS, GREEK, SHORT_WORDS, SUFFIXES, TAIL_WORDS, WEB_WORDS

ENTRY = r"[^\p{L}\p{N}]+"

# letters whose full capital form is several letters (all are below 2**16), and their capitals of one letter
_WIDE = "".join(c for c in map(chr, range(0x80, 1 << 16)) if len(c.upper()) > 1)
_NARROW = "".join("\u1e9e" if c == "\u00df" else c.title() if len(c.title()) == 1 else c for c in _WIDE)


def strings(values: Iterable[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def tokens(text: Column) -> Column:
    """Lower-case words of letters and digits; null gives none."""
    return F.filter(F.split(F.lower(F.regexp_replace(F.coalesce(text, F.lit("")), ENTRY, " ")), " "), lambda t: t != "")


def sentences(text: Column) -> Column:
    """Arrays of tokens, one for each sentence that has any."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), r"[.!?\n]+"), tokens), lambda s: F.size(s) > 0)


def bounded(parts: Column) -> Column:
    """Sentences' tokens in one array, with a null after each sentence."""
    return F.flatten(F.transform(parts, lambda s: F.concat(s, F.array(F.lit(None).cast("string")))))


def is_stop(token: Column, stopwords: Iterable[str], min_len: int = 2) -> Column:
    """Whether a token is no keyword: a stopword, digits, a year, or too short."""
    return token.isin(list(stopwords)) | token.rlike(r"^\p{Nd}+$") | ((F.length(token) < min_len) & ~token.isin(SHORT_WORDS))


def stop_filtered(words: Column, stopwords: Iterable[str], min_len: int = 2) -> Column:
    """Tokens with a null (a boundary that no n-gram crosses) for each that is dropped."""
    stops = list(stopwords)
    return F.transform(words, lambda t: F.when(t.isNull() | is_stop(t, stops, min_len), F.lit(None).cast("string")).otherwise(t))


def ngrams(words: Column, n: int) -> Column:
    """Space-joined runs of n tokens without a boundary, as structs (gram, n, pos).

    Runs grow by a token at a time against the array shifted by one more place; a null in a run makes the run null.
    """
    runs = words
    for k in range(2, n + 1):
        runs = F.zip_with(runs, F.slice(words, F.lit(k), F.size(words)), lambda a, b: F.concat(a, F.lit(" "), b))
    placed = F.transform(runs, lambda g, i: F.struct(g.alias("gram"), F.lit(n).alias("n"), (i + 1).alias("pos")))
    return F.filter(placed, lambda r: r["gram"].isNotNull())


def all_ngrams(words: Column, max_n: int) -> Column:
    """n-grams of every length up to max_n, shorter ones first."""
    return F.concat(*[ngrams(words, n) for n in range(1, max_n + 1)])


def word_count(term: Column) -> Column:
    return F.size(F.split(term, " "))


def dedupe_key(term: Column) -> Column:
    """Lower-case ASCII letters and digits only: what near-duplicate terms share."""
    return F.regexp_replace(F.lower(F.trim(F.coalesce(term, F.lit("")))), "[^0-9A-Za-z]+", "")


def collapse_repeats(term: Column) -> Column:
    """Of words that repeat the one before, in any case, the first."""
    words = F.split(F.trim(term), r"\s+")
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(words, F.lit(1), F.size(words) - 1))
    return F.array_join(F.array_compact(F.zip_with(words, before, lambda w, b: F.when(b.isNull() | (F.lower(w) != F.lower(b)), w))), " ")


def camel_split(token: Column) -> Column:
    """Parts at changes of case and between letters and digits; short acronyms stay whole."""
    acronym = (F.upper(token) == token) & (F.lower(token) != token) & (F.length(token) <= 5)
    parts = F.split(token, r"(?<=[a-z0-9])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])|[^0-9A-Za-z]+")
    return F.when(acronym, F.array(token)).otherwise(F.filter(parts, lambda p: p != ""))


def expand(token: Column) -> Column:
    """What an acronym stands for, else null."""
    pairs = [F.lit(x) for kv in EXPANSIONS.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), F.lower(token))


def community_key(name: Column, url: Column) -> Column:
    """Lower-case key from r/<key> in the name, else from /r/<key> in the url."""
    of = lambda c, p: F.nullif(F.lower(F.regexp_extract(F.coalesce(c, F.lit("")), p, 1)), F.lit(""))
    return F.coalesce(of(name, r"(?i)r/([^/\s]+)"), of(url, r"(?i)/r/([^/\s]+)"), F.lit(""))


def crawl_name(name: Column) -> Column:
    """A community's bare name, without address, slashes and r/."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(name), r"(?i)^https?://[^/]+", ""), r"^/+|/+$", "")
    return F.regexp_replace(F.regexp_replace(bare, r"(?i)^r/", ""), r"/.*$", "")


def display_key(name: Column) -> Column:
    """A community's bare name in its own case."""
    return F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(name, F.lit(""))), "(?i)^r/+", ""), "^/+|/+$", "")


def canonical_key(name: Column) -> Column:
    return F.lower(display_key(name))


def recased(term: Column, key: Column, display: Column, phrase: Column, title: Column) -> Column:
    """A term for display: the title in place of the anchor phrase at its start, or the name in its own case in place of the key."""
    starts = lambda a: (F.coalesce(a, F.lit("")) != "") & F.startswith(term, F.concat(a, F.lit(" ")))
    rest = lambda a: F.substring(term, F.length(a) + 1, F.length(term))
    return F.when(starts(phrase) & (F.coalesce(title, F.lit("")) != ""), F.concat(title, rest(phrase))).when(starts(key) & (F.coalesce(display, F.lit("")) != ""), F.concat(display, rest(key))).otherwise(term)


def display_word(word: Column) -> Column:
    """A word of a name for display: upper case and mixed case stay, lower case begins with a capital."""
    return F.when((F.lower(word) == word) & (F.upper(word) != word), F.initcap(word)).otherwise(word)


def capital(letter: Column) -> Column:
    """A letter's capital, one letter for one as SQL engines have it: one whose full capital form is several letters has its title form if that is one, else stays; ß has ẞ."""
    return F.when(F.length(F.upper(letter)) > 1, F.translate(letter, _WIDE, _NARROW)).otherwise(F.upper(letter))


def capitalised(text: Column) -> Column:
    """The text with its first letter as a capital."""
    return F.concat(capital(F.left(text, F.lit(1))), text.substr(F.lit(2), F.length(text)))


def count_text(text: Column) -> Column:
    """The number in "1,234" or "1.4K" (the first digits of anything else, 0 without)."""
    s = F.upper(F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), ",", "")))
    thousands = (F.regexp_extract(s, r"^([0-9]*\.?[0-9]+)K$", 1).try_cast("double") * 1000).cast("bigint")
    return F.coalesce(F.when(s.endswith("K"), thousands), F.regexp_extract(s, r"([0-9]+)", 1).try_cast("bigint"), F.lit(0).cast("bigint"))


def post_id(permalink: Column) -> Column:
    found = F.regexp_extract(F.coalesce(permalink, F.lit("")), r"/comments/([a-z0-9]+)/", 1)
    return F.when(found != "", F.concat(F.lit("t3_"), found))


def nonascii_ratio(text: Column) -> Column:
    s = F.coalesce(text, F.lit(""))
    return F.when(F.length(s) == 0, F.lit(0.0)).otherwise((F.length(s) - F.length(F.regexp_replace(s, r"[^\x00-\x7F]", ""))) / F.length(s))


def has_script(text: Column, ranges: str = CJK + CYRILLIC + GREEK) -> Column:
    return F.coalesce(text, F.lit("")).rlike(f"[{ranges}]")


def is_artifact(term: Column, strong: bool = False) -> Column:
    """Whether a term is a piece of an address, a file name or a hash."""
    words = F.filter(F.split(F.lower(F.trim(F.coalesce(term, F.lit("")))), r"\s+"), lambda w: w != "")
    hits = lambda test: F.size(F.filter(words, test))
    out = F.exists(words, lambda w: w.contains("http") | w.contains("www")) | (hits(lambda w: w.isin(WEB_WORDS)) >= 2)
    out = out | (F.exists(words, lambda w: w.isin(DOMAINS)) & F.exists(words, lambda w: ~w.isin(DOMAINS) & w.rlike("^[a-z]{3,}$")))
    out = out | F.exists(words, lambda w: w.rlike("|".join(FILE_ENDINGS)))
    out = out | (hits(lambda w: w.rlike("^[0-9a-f]{6,}$")) >= F.greatest(F.lit(1), F.floor(F.size(words) / 2)))
    if strong:
        out = out | F.exists(words, lambda w: (F.length(w) >= 18) & w.rlike(r"^[\p{L}\p{N}]+$") & ~w.rlike("[aeiou]"))
    out = out | (F.array_contains(words, "preview") & F.array_contains(words, "redd"))
    return F.when(F.size(words) == 0, F.lit(False)).otherwise(out)


def drop_reason(term: Column, nonlatin: bool = True, max_ratio: float = -1.0) -> Column:
    """Why a term is dropped, the first reason that holds; null if it stays."""
    reason = F.when(is_artifact(term), "tech")
    if nonlatin:
        reason = reason.when(has_script(term, CJK), "cjk").when(has_script(term, CYRILLIC), "cyrillic").when(has_script(term, GREEK), "greek")
    return reason.when(nonascii_ratio(term) > max_ratio, "nonascii") if max_ratio >= 0 else reason


def equal_loose(a: Column, b: Column) -> Column:
    """Whether two terms differ by spaces, case or one final s at most; empty ones equal nothing."""
    bare = lambda t: F.regexp_replace(F.regexp_replace(F.lower(F.trim(F.coalesce(t, F.lit("")))), r"\s+", ""), "lives$", "life")
    cut = lambda t: F.regexp_replace(t, "s$", "")
    x, y = bare(a), bare(b)
    return (x != "") & (y != "") & (cut(x) == cut(y))


def simplify_seed(term: Column) -> Column:
    """A seed without repeated words and without generic words at its end; one word stays."""
    words = F.split(collapse_repeats(term), " ")
    last = F.aggregate(F.transform(words, lambda w, i: F.when(~w.isin(TAIL_WORDS), i + 1).otherwise(0)), F.lit(1), lambda a, x: F.greatest(a, x.cast("int")))
    return F.array_join(F.slice(words, F.lit(1), last), " ")


def source_rank(source: Column) -> Column:
    """The best place of a term's sources in the order composed, posts, description, name; 999 for none of them."""
    order = {"posts_composed": 0, "posts": 1, "description": 2, "name": 3}
    rank = lambda p: F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in order.items() for x in kv]), p), F.lit(999))
    return F.array_min(F.transform(F.split(F.coalesce(source, F.lit("")), r"\+"), rank))


def in_pool(source: Column, pool: str) -> Column:
    """Whether a term's sources put it in a document-frequency pool."""
    parts = F.split(F.coalesce(source, F.lit("")), r"\+")
    has = lambda p: F.array_contains(parts, p)
    return {"union": F.lit(True), "posts": has("posts"), "posts_composed": has("posts_composed"), "posts_union": has("posts") | has("posts_composed"), "desc": has("description"), "non_name": F.exists(parts, lambda p: (p != "name") & (p != ""))}[pool]


def in_embed_pool(source: Column, pool: str) -> Column:
    """As in_pool, but by substring, so that "posts" holds for posts_composed too."""
    s = F.coalesce(source, F.lit(""))
    return F.lit(True) if pool == "union" else s.contains({"desc": "description", "posts": "posts", "name": "name"}[pool])


def theme_summary(terms: Column, limit: int = 120) -> Column:
    """A line that names the theme, cut to a length."""
    line = F.concat(F.lit("Theme: "), F.array_join(terms, " ; "))
    return F.when(F.length(line) > limit, F.concat(F.rtrim(F.substring(line, 1, limit - 1)), F.lit("…"))).otherwise(line)


def timestamp_of(text: Column) -> Column:
    """ISO times with an offset, with or without parts of a second, and with Z."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(p)) for p in ("yyyy-MM-dd'T'HH:mm:ss.SSSSSSZ", "yyyy-MM-dd'T'HH:mm:ssZ", "yyyy-MM-dd'T'HH:mm:ssX", "yyyy-MM-dd'T'HH:mm:ss")])


def segment(word: str, suffixes: Iterable[str] = SUFFIXES) -> list[str]:
    """A glued lower-case word cut at a known ending, else at a vowel followed by a consonant past its middle; long parts again."""
    import re

    if not word.isalpha() or len(word) <= 8:
        return [word]
    for s in suffixes:
        if word.endswith(s) and len(word) > len(s) + 2:
            parts = [word[: -len(s)], s]
            break
    else:
        half = len(word) // 2
        found = re.search("[aeiouy][^aeiouy]", word[half:])
        at = half + found.end() - 1 if found else 0
        if not 3 <= at <= len(word) - 3:
            return [word]
        parts = [word[:at], word[at:]]
    return [x for p in parts for x in (segment(p, suffixes) if p.isalpha() and len(p) > 10 else [p])]

