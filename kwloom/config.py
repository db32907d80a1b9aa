"""Defaults of the keyword engine, and its fixed word lists."""

from __future__ import annotations

from dataclasses import dataclass, field

# Words that are never keywords.
STOPWORDS = """
    a about after all also am amp an and another any anyone anything apr april are as at aug august be been before being but by can cannot cant collection
    collections community could dec december dedicated did discuss discussion do does doing done each eight either else etc every everyone everything fan
    fans feb february few film films five focus focused focusedon for forum four from gallery game games gaming global great guys he help her here hers
    his home how i if image images in include includes including international into is it its jan january join jul july jun june least less many mar march
    may me might mine more most movie movies much must my neither news nine no not nother nov november oct october of off official on one only onto or
    other our over own photo photos pic pics picture pictures place please post posting posts r read reddit related rules safe same sep sept september
    series seven several shall share sharing she should show shows six sn so some someone something space stuff sub subreddit such talk ten than that the
    their them then there these they things this those three to tv two under unofficial updates us various very video videogame videogames videos was we
    welcome were what when where which who whom whose why will with without won wont work working works world would you your
""".split()


# Acronyms and what they stand for.
EXPANSIONS = {
    "fc": "football club",
    "uk": "united kingdom",
    "us": "united states",
    "usa": "united states",
    "eu": "europe",
    "3ds": "nintendo 3ds",
    "ai": "artificial intelligence",
    "ml": "machine learning",
    "mlops": "machine learning operations",
    "ux": "user experience",
    "ui": "user interface",
    "diy": "do it yourself",
    "rpg": "role playing game",
    "ttrpg": "tabletop role playing game",
    "fps": "first person shooter",
}

# Endings by which a glued lower-case word is cut, in the order in which they are tried.
SUFFIXES = (
    "club food house houses baking cooking music girls boys games game garden gardening coding code design dev devs dogs dog cats cat "
    "jobs job news art arts sports sport cars car coin coins crypto market markets fashion makeup beauty support trading stocks nails "
    "drama school schools theory gardeners photography fc"
).split()

# Words trimmed from the end of a seed phrase.
TAIL_WORDS = "minute minutes hour hours day days today yesterday tomorrow question help".split()

# Words that hint at web addresses, top-level domains among them, and file endings.
WEB_WORDS = "http https www www2 com net org io co gg tv fm ly store shop coupon promo subscribe login signin download update version release playlist stream".split()
DOMAINS = "com net org io co gg tv fm ly".split()
FILE_ENDINGS = "jpg jpeg png gif webp mp4 mov m4a mp3 pdf zip rar 7z tar gz svg bmp tiff heic".split()

# Short words that are kept.
SHORT_WORDS = ["ai", "vr", "uk", "us", "eu", "3d"]

# Script ranges, as the inside of a character class.
CJK, CYRILLIC, GREEK = "぀-ヿ㐀-䶿一-鿿豈-﫿ｦ-ﾝ", "Ѐ-ӿ", "Ͱ-Ͽ"


@dataclass(frozen=True)
class KeywordConfig:
    """Tunable values of the keyword plans."""

    topk: int = 25
    max_ngram: int = 3
    min_token_len: int = 2
    stopwords: tuple[str, ...] = field(default_factory=lambda: tuple(STOPWORDS))
    name_weight: float = 3.0
    desc_weight: float = 1.0
    posts_weight: float = 1.5
    composed_weight: float | None = None
    desc_boosts: tuple[float, float] = (1.2, 1.4)
    posts_boosts: tuple[float, float] = (1.25, 1.5)
    desc_idf_power: float = 0.85
    posts_idf_power: float = 0.65
    ensure_k: int = 3
    halflife_days: float = 7.0
    engagement_alpha: float = 0.0
    min_df_bigram: int = 2
    min_df_trigram: int = 2
    desc_generic_ratio: float | None = 0.10
    desc_generic_phrase_ratio: float | None = None
    posts_generic_ratio: float | None = None
    posts_generic_phrase_ratio: float | None = 0.35
    anchor_generic_ratio: float = 0.05
    anchor_multiplier: float = 0.9
    replace_generic: bool = False
    skip_promoted: bool = True
    drop_nonlatin_posts: bool = False
    max_nonascii_ratio: float = -1.0
    include_preview: bool = False
    posts_stopwords: tuple[str, ...] = ()
    posts_phrases: tuple[str, ...] = ()
    frequent_words: tuple[str, ...] = ()
    compose_multiplier: float = 1.0
    compose_top_m: int = 20
    compose_unigrams: bool = False
    compose_max_words: int = 6
    compose_mode: str = "idf_blend"
    compose_alpha: float = 0.7
    compose_floor: float = 1.0
    compose_cap: float = 2.0
    compose_max_per_doc: int = 8
    compose_min_base: float = 3.0
    compose_max_ratio: float = 2.0
    token_with_phrase: bool = False
    compose_seeds: str = "hybrid"
    seed_embed_alpha: float = 0.6
    seed_pool: int = 200
    dynamic_common: bool = True
    anchor_generics: bool = True
    require_posts: bool = False
    ensure_name: bool = True
    drop_nonlatin: bool = False
    term_nonascii_ratio: float = -1.0
    core_topk: int | None = None
    theme_k: int = 6
    theme_penalty: float = 0.65
    embed_alpha: float = 0.35
    embed_k: int = 100
    segment_by_counts: bool = False
