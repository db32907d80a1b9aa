"""DuckDB SQL with the same rows as the queries of the catalogue."""

from __future__ import annotations

from .config import CJK, CYRILLIC, DOMAINS, FILE_ENDINGS, GREEK, SHORT_WORDS, WEB_WORDS, KeywordConfig
from .operators import reports
from .operators.quality import ADDRESS, CONNECTORS, PROMOTION


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _tokens(c: str) -> str:
    return f"list_filter(string_split(lower(regexp_replace(coalesce({c}, ''), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')), ' '), lambda t: t <> '')"


def _key(c: str) -> str:
    return f"regexp_replace(lower(trim({c})), '[^0-9A-Za-z]+', '', 'g')"


def _collapse(c: str) -> str:
    w = f"regexp_split_to_array(trim({c}), '\\s+')"
    return f"array_to_string(list_filter({w}, lambda w, i: i = 1 OR lower(w) <> lower(({w})[i - 1])), ' ')"


def _artifact(c: str) -> str:
    w = f"list_filter(regexp_split_to_array(lower(trim({c})), '\\s+'), lambda w: w <> '')"
    n = lambda test: f"len(list_filter({w}, lambda w: {test}))"
    web, tld = f"list_contains({_list(WEB_WORDS)}, w)", f"list_contains({_list(DOMAINS)}, w)"
    return f"""(len({w}) > 0 AND ({n("contains(w, 'http') OR contains(w, 'www')")} > 0 OR {n(web)} >= 2
      OR ({n(tld)} > 0 AND {n(f"NOT {tld} AND regexp_full_match(w, '[a-z]{{3,}}')")} > 0)
      OR {n(f"regexp_matches(w, '{'|'.join(FILE_ENDINGS)}')")} > 0
      OR {n("regexp_full_match(w, '[0-9a-f]{6,}')")} >= greatest(1, len({w}) // 2)
      OR (list_contains({w}, 'preview') AND list_contains({w}, 'redd'))))"""


def _reason(c: str) -> str:
    return f"CASE WHEN {_artifact(c)} THEN 'tech' WHEN regexp_matches({c}, '[{CJK}]') THEN 'cjk' WHEN regexp_matches({c}, '[{CYRILLIC}]') THEN 'cyrillic' WHEN regexp_matches({c}, '[{GREEK}]') THEN 'greek' END"


def _mechanical(c: str) -> str:
    w = f"string_split(lower({c}), ' ')"
    return f"(len({w}) >= 4 AND NOT list_has_any({w}, {_list(CONNECTORS)}) AND NOT {_repeats(c)})"


def _repeats(c: str) -> str:
    w = f"string_split(lower({c}), ' ')"
    return f"(len(list_distinct({w})) < len({w}))"


def _issue(c: str) -> str:
    w = f"string_split(lower({c}), ' ')"
    return f"({_repeats(c)} OR (len({w}) > 5 AND NOT list_has_any({w}, {_list(CONNECTORS)})) OR regexp_matches(lower({c}), '{ADDRESS}'))"


def _pairs(like: str) -> str:
    """The mean of an expression over neighbouring words of the list w."""
    return f"(CASE WHEN len(w) < 2 THEN 1 ELSE list_sum(list_transform(range(1, len(w)), lambda i: {like})) / (len(w) - 1) END)"


def _reports(keywords: str, cfg: KeywordConfig) -> dict[str, str]:
    """SQL for the report heuristics; w are a term's lower-case words."""
    a, b = "w[i]", "w[i + 1]"
    longer = f"greatest(length({a}), length({b}), 1)"
    lengths = f"(1 - abs(length({a}) - length({b})) / {longer}) * 0.3::DOUBLE"
    same = f"len(list_intersect(list_distinct(string_split({a}, '')), list_distinct(string_split({b}, ''))))"
    every = f"len(list_distinct(list_concat(string_split({a}, ''), string_split({b}, ''))))"
    ends = f"(starts_with({a}, left({b}, 2)) OR starts_with({b}, left({a}, 2)) OR ends_with({a}, right({b}, 2)) OR ends_with({b}, right({a}, 2)))"
    fragment = _pairs(f"{lengths} + {same} / {longer} * 0.4::DOUBLE + CASE WHEN {ends} AND length({a}) > 2 THEN 0.3::DOUBLE ELSE 0 END")
    alike = f"(left({a}, 2) = left({b}, 2) OR right({a}, 2) = right({b}, 2))"
    smooth = _pairs(f"{lengths} + {same} / {every} * 0.5::DOUBLE + CASE WHEN {alike} AND length({a}) > 2 AND length({b}) > 2 THEN 0.06::DOUBLE ELSE 0 END")
    holds = lambda c, pieces: "(" + " OR ".join(f"contains({c}, '{p}')" for p in pieces) + ")"
    count = lambda ws, test: f"len(list_filter({ws}, lambda x: {test}))"
    fields = " + ".join(f"CAST({count('w', holds('x', pieces))} > 0 AS INTEGER)" for pieces in reports.FIELDS.values())
    common = f"list_contains({_list(reports.COMMON)}, lower(x))"
    unrelated = f"(len(w) >= 4 AND NOT list_has_any(w, {_list(reports.WHOLE)}) AND len(list_distinct(raw)) = len(raw) AND ({fields} > 2 OR ({count('raw', f'length(x) > 6 AND NOT {common}')} >= 2 AND {count('w', common)} > 0)))"
    tests = {
        "coherence": f"len(w) >= 4 AND least(1, {fragment}) < 0.3",
        "names": f"{count('raw', f"length(x) > 3 AND regexp_matches(x, '{reports.TITLE}')")} > 0",
        "repeats": "len(list_distinct(w)) < len(w)",
        "letters": "regexp_matches(term, '[^\\x00-\\x7F]')",
        "fragments": f"len(w) >= 5 AND {count('w', 'length(x) > 3')} = 0",
        "structure": f"len(w) >= 4 AND NOT {holds('lower(term)', reports.STRUCTURE)}",
    }
    issues = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {t} THEN '{n}' END" for n, t in tests.items()) + "], lambda x: x IS NOT NULL), '|')"
    kind = f"CASE WHEN {holds('lower(term)', reports.ADVERTS)} THEN 'promotional' WHEN len(list_distinct(w)) < len(w) OR (len(w) > 3 AND {count('w', 'length(x) > 2')} < len(w) * 0.6::DOUBLE) THEN 'low' WHEN {holds('lower(term)', reports.BRANDS)} AND len(w) >= 3 THEN 'high' ELSE 'medium' END"
    well = f"(len(raw) >= 2 AND (NOT {holds('w[1]', reports.NAME_STARTS)} OR (len(raw) <= 5 AND NOT regexp_matches(array_to_string(raw[2:], ' '), '[0-9]|https?'))))"
    score = f"{smooth} * 0.4::DOUBLE + CASE WHEN len(w) <= 3 THEN 0.3::DOUBLE WHEN len(w) = 4 THEN 0.2 ELSE 0.1 END + CASE WHEN regexp_matches(term, '{reports.ADDRESS}') THEN 0::DOUBLE ELSE 0.2 END + CASE WHEN contains(source, 'composed') AND NOT {well} THEN 0::DOUBLE ELSE 0.1 END"
    words = "string_split(term, ' ') AS raw, string_split(lower(term), ' ') AS w"
    made = keywords + f", kc AS (SELECT doc_id, rank, term, score, CASE WHEN length(term) % 2 = 0 THEN 'posts_composed' ELSE 'posts' END AS source, {words} FROM k)"
    themes = "th2 AS (SELECT doc_id, p_name AS name, text AS description, list_concat(regexp_extract_all(replace(lower(coalesce(p_name, '')), 'r/', ''), '[a-z]+'), list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}_]+'), lambda x: regexp_full_match(x, '[a-z]{3,}'))[1:10]) AS raw_theme FROM documents LEFT JOIN part ON p_partkey = doc_id)"
    first = "list_filter(raw_theme, lambda x, i: i = 1 OR NOT list_contains(raw_theme[1:i - 1], x))"
    versions = """, v1 AS (SELECT * FROM kc WHERE rank <= 15), v2 AS (SELECT * FROM (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY s DESC, term) AS rank, term, s AS score, source, raw, w
        FROM (SELECT *, score * CASE WHEN length(term) % 2 = 0 THEN 1.25::DOUBLE ELSE 1 END AS s FROM kc)) WHERE rank <= 15)"""

    def measured(v: str) -> str:
        cover = "len(list_intersect(list_distinct(list_filter(w, lambda x: regexp_matches(x, '[a-z]'))), raw_theme)) / greatest(len(list_distinct(list_filter(w, lambda x: regexp_matches(x, '[a-z]')))), 1)"
        top, last = "avg(score) FILTER (WHERE rank <= 5)", "avg(score) FILTER (WHERE rank > n - 5)"
        return f"m{v} AS (SELECT doc_id, sum({cover} / rank * score) FILTER (WHERE rank <= 10) AS theme, avg({score}) FILTER (WHERE rank <= 10) AS phrase, CASE WHEN max(n) >= 5 AND {top} > 0 THEN ({top} - {last}) / {top} ELSE 0 END AS spread FROM (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM v{v}) JOIN th2 USING (doc_id) GROUP BY 1)"

    metrics = lambda fall: f""", fu AS (SELECT avg(CASE WHEN n >= {cfg.topk} THEN 1.0::DOUBLE ELSE 0 END) * 100 AS "full" FROM (SELECT count(*) AS n FROM kc GROUP BY doc_id)),
        dm AS (SELECT rank, count(*) AS n, avg(score) AS mean FROM kc GROUP BY 1), dd AS (SELECT rank, CASE WHEN n >= 10 THEN (lag(mean) OVER (ORDER BY rank) - mean) / lag(mean) OVER (ORDER BY rank) * 100 END AS fall FROM dm),
        mm AS (SELECT "full", (SELECT min(rank) FROM dd WHERE fall > {fall}) AS cliff, lw AS low, pr AS promotional FROM fu, (SELECT avg(CASE WHEN kind = 'low' THEN 1.0::DOUBLE ELSE 0 END) AS lw, avg(CASE WHEN kind = 'promotional' THEN 1.0::DOUBLE ELSE 0 END) AS pr FROM (SELECT {kind} AS kind FROM kc WHERE contains(source, 'composed'))))"""  # noqa: E731
    best = lambda v, keep: f"(SELECT doc_id, string_agg(term, '|' ORDER BY rank) AS t FROM {v} WHERE {keep} GROUP BY 1)"
    return {
        "phrase_issues": keywords + f", pt AS (SELECT DISTINCT CASE WHEN length(term) % 5 = 0 THEN upper(left(term, 1)) || substr(term, 2) ELSE term END AS term FROM k WHERE contains(term, ' ')), pw AS (SELECT term, {words} FROM pt) SELECT term, {issues} AS issues, {unrelated} AS unrelated, {kind} AS class FROM pw",
        "phrase_scores": made + f" SELECT DISTINCT term, source, round({score}, 6) AS quality FROM kc",
        "community_themes": f"WITH {themes} SELECT doc_id, array_to_string({first}, ' ') AS theme FROM th2",
        "version_scores": made + versions + f", {themes}, {measured('1')}, {measured('2')}, gains AS (SELECT doc_id, b.theme - a.theme AS t, b.phrase - a.phrase AS p, b.spread - a.spread AS s FROM m1 a JOIN m2 b USING (doc_id)), total AS (SELECT *, t * 0.4::DOUBLE + p * 0.4::DOUBLE + s * 0.2::DOUBLE AS overall FROM gains) SELECT doc_id, round(t, 6) + 0.0::DOUBLE AS theme_gain, round(p, 6) + 0.0::DOUBLE AS phrase_gain, round(s, 6) + 0.0::DOUBLE AS spread_gain, round(overall, 6) + 0.0::DOUBLE AS overall, CASE WHEN round(overall, 9) > 0 THEN 'improvement' ELSE 'degradation' END AS verdict FROM total",
        "topk_metrics": made + metrics(5.0) + ' SELECT round("full", 6) AS "full", cliff, round(low, 6) AS low, round(promotional, 6) AS promotional FROM mm',
        "topk_advice": made + metrics(20.0) + f""" SELECT 'increase' AS action, CAST(CASE WHEN cliff > {cfg.topk} THEN least(cliff - 2, 60) ELSE 50 END AS INTEGER) AS new_topk, CASE WHEN cliff > {cfg.topk} THEN 'high' ELSE 'medium' END AS priority FROM mm WHERE "full" > 90
            UNION ALL SELECT 'decrease', CAST(greatest(cliff - 2, 20) AS INTEGER), 'medium' FROM mm WHERE "full" < 50 AND cliff < {cfg.topk} UNION ALL SELECT 'quality_filter', NULL, 'high' FROM mm WHERE low > 0.3 UNION ALL SELECT 'promotion_filter', NULL, 'high' FROM mm WHERE promotional > 0.1""",
        "side_by_side": made + versions + f""", {themes} SELECT th2.doc_id, name, md5(left(coalesce(description, ''), 200)) AS about, x.t AS terms_a, y.t AS terms_b, z.t AS titles FROM th2 JOIN {best('v1', 'doc_id % 3 <> 0')} x USING (doc_id) LEFT JOIN {best('v2', 'doc_id % 5 <> 0')} y USING (doc_id)
            LEFT JOIN (SELECT conv_id AS doc_id, string_agg(text, '|' ORDER BY turn) AS t FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS r FROM conversations) WHERE r <= 5 GROUP BY 1) z USING (doc_id)""",
    }


def common_tables(cfg: KeywordConfig) -> dict[str, str]:
    """CTEs that many queries begin with: description terms (desc), these ranked (top), the best k (keywords); posts terms, and these ranked."""
    stop = f"(list_contains({_list(cfg.stopwords)}, t) OR regexp_full_match(t, '\\p{{Nd}}+') OR (length(t) < {cfg.min_token_len} AND NOT list_contains({_list(SHORT_WORDS)}, t)))"
    sentences = f"list_filter(list_transform(regexp_split_to_array(coalesce(text, ''), '[.!?\\n]+'), lambda s: {_tokens('s')}), lambda s: len(s) > 0)"

    def grams(words: str, source: str, key: str) -> str:
        """CTEs ending in tf(key.., term, n, tf, pos) of lists of tokens in which '' marks a boundary."""
        return f"""
        w AS (SELECT {key}, unnest({words}) AS t0, unnest(range(1, len({words}) + 1)) AS pos FROM {source}),
        b AS (SELECT {key}, pos, CASE WHEN t0 = '' OR {stop.replace('t,', 't0,').replace(', t)', ', t0)').replace('(t)', '(t0)')} THEN NULL ELSE t0 END AS a FROM w),
        l AS (SELECT {key}, pos, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c FROM b WINDOW o AS (PARTITION BY {key} ORDER BY pos)),
        g AS (SELECT {key}, pos, 1 AS n, a AS term FROM l WHERE a IS NOT NULL
          UNION ALL SELECT {key}, pos, 2, a || ' ' || b FROM l WHERE a IS NOT NULL AND b IS NOT NULL
          UNION ALL SELECT {key}, pos, 3, a || ' ' || b || ' ' || c FROM l WHERE a IS NOT NULL AND b IS NOT NULL AND c IS NOT NULL)"""

    bounded = f"string_split(array_to_string(list_transform({sentences}, lambda s: array_to_string(s, ' ')), '  '), ' ')"
    desc = f"""WITH src AS (SELECT doc_id, {bounded} AS ws FROM documents WHERE len({sentences}) > 0), {grams('ws', 'src', 'doc_id')},
        tf AS (SELECT doc_id, term, n, count(*) AS tf, min(pos) AS pos FROM g GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)"""

    def scored(n_docs: str, weight: str, power: float, boosts, drop: str, generic: str, key: str = "doc_id") -> str:
        boost = f"CASE n WHEN 2 THEN {boosts[0]} WHEN 3 THEN {boosts[1]} ELSE 1.0 END"
        return f""",
        j AS (SELECT tf.*, df, {n_docs} AS total, ({drop}) AS dropped, ({generic}) AS generic FROM tf JOIN df USING (term)),
        sc AS (SELECT *, CASE WHEN NOT dropped THEN {weight} * pow(ln((1.0 + total) / (1.0 + df)) + 1.0, {power}) * ({boost})::DOUBLE END AS score FROM j),
        sp AS (SELECT *, row_number() OVER (PARTITION BY {key}, (dropped AND n >= 2 AND NOT generic) ORDER BY tf DESC, n, pos, term) AS place FROM sc),
        es AS (SELECT {key}, term, n, tf, pos, df, coalesce(score, tf * ({boost})::DOUBLE) AS score FROM sp WHERE NOT dropped OR (n >= 2 AND NOT generic AND place <= {cfg.ensure_k})),
        rk AS (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY score DESC, term) AS rank FROM es)"""

    minimum = f"(n = 2 AND df < {cfg.min_df_bigram}) OR (n = 3 AND df < {cfg.min_df_trigram})"
    top = desc + scored("(SELECT count(*) FROM documents)", "tf", cfg.desc_idf_power, cfg.desc_boosts, f"{minimum} OR (n = 1 AND df / (SELECT count(*) FROM documents) >= {cfg.desc_generic_ratio})", "false")
    keywords = top + f", k AS MATERIALIZED (SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, round(score, 6) AS score, CASE rank % 3 WHEN 0 THEN 'posts' WHEN 1 THEN 'description' ELSE 'description+posts' END AS source FROM rk WHERE rank <= {cfg.topk})"
    posts = f"""WITH p AS (SELECT conv_id AS doc_id, turn, {_tokens('text')} AS ws, pow(0.5, turn * 0.5 / {cfg.halflife_days}) AS wt FROM conversations WHERE role <> 'system'),
        src AS (SELECT * FROM p WHERE len(ws) > 0), {grams('ws', 'src', 'doc_id, turn, wt')},
        tf AS (SELECT doc_id, term, n, sum(c)::BIGINT AS tf, sum(c * wt) AS weighted, min(pos) AS pos FROM (SELECT doc_id, turn, wt, term, n, count(*) AS c, min(pos) AS pos FROM g GROUP BY ALL) GROUP BY ALL),
        df AS (SELECT term, count(*) AS df FROM tf GROUP BY term), nd AS (SELECT count(DISTINCT doc_id) AS nd FROM tf)"""
    phrase = f"(n >= 2 AND df / (SELECT nd FROM nd) >= {cfg.posts_generic_phrase_ratio})"
    posts_top = posts + scored("(SELECT nd FROM nd)", "weighted", cfg.posts_idf_power, cfg.posts_boosts, f"{minimum} OR {phrase}", phrase)
    return {"stop": stop, "sentences": sentences, "desc": desc, "top": top, "keywords": keywords, "posts": posts, "posts_top": posts_top}


def _coherence() -> str:
    """SQL for the mean likeness of neighbouring words of the list w."""
    each = """list_transform(range(1, len(w)), lambda i:
        (CASE WHEN abs(length(w[i]) - length(w[i + 1])) / greatest(greatest(length(w[i]), length(w[i + 1])), 1) < 0.5 THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END)
        + 0.4::DOUBLE * len(list_intersect(string_split(w[i], ''), string_split(w[i + 1], ''))) / greatest(len(list_distinct(list_concat(string_split(w[i], ''), string_split(w[i + 1], '')))), 1)
        + (CASE WHEN w[i][1:2] = w[i + 1][1:2] OR right(w[i], 2) = right(w[i + 1], 2) THEN 0.3::DOUBLE ELSE 0.0::DOUBLE END))"""
    return f"(list_sum({each}) / (len(w) - 1))"

def build(cfg: KeywordConfig) -> dict[str, str]:
    """SQL by query name."""
    core = common_tables(cfg)
    stop, sentences = core["stop"], core["sentences"]
    desc, top, keywords, posts, posts_top = core["desc"], core["top"], core["keywords"], core["posts"], core["posts_top"]

    week = lambda w: f"SELECT 'u' || (user_id % 997) AS name, count(*) * 100 AS subscribers, min(event_id) AS rank FROM events WHERE strftime(ts, '%G-W%V') = '{w}' GROUP BY 1"
    changes = f"""WITH b AS ({week('2024-W01')}), a AS ({week('2024-W02')}), ch AS (
        SELECT coalesce(b.name, a.name) AS name, CASE WHEN b.name IS NULL THEN 'new' WHEN a.name IS NULL THEN 'disappeared' WHEN b.rank <> a.rank THEN 'moved' ELSE 'same' END AS status,
        b.rank AS old_rank, a.rank AS new_rank, b.rank - a.rank AS rank_change, b.subscribers AS old_subscribers, a.subscribers AS new_subscribers, a.subscribers - b.subscribers AS subscriber_change,
        CASE WHEN b.subscribers > 0 THEN round((a.subscribers - b.subscribers) / b.subscribers * 100, 6) WHEN a.subscribers - b.subscribers IS NOT NULL THEN 0.0 END AS growth
        FROM b FULL JOIN a ON b.name = a.name)"""
    targets = "t AS (SELECT lower(s_name) AS name, min(coalesce(CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey END, 1000000000000)) AS rank FROM supplier GROUP BY 1)"
    errors = ["", "net::ERR_CONNECTION_REFUSED at x", "Timeout 30000ms exceeded", "Target closed", "page crashed", "getaddrinfo ENOTFOUND", "odd"]
    results = f"r AS (SELECT s_name AS name, ({_list(errors)})[s_suppkey % 7 + 1] AS error FROM supplier)"
    bucket = lambda op: f"CASE WHEN o_totalprice {op} 1000000 THEN '1M' WHEN o_totalprice {op} 100000 THEN '100K' WHEN o_totalprice {op} 10000 THEN '10K' WHEN o_totalprice {op} 1000 THEN '1K' ELSE 'small' END"
    theme = lambda where: f"th AS (SELECT doc_id, list_distinct(flatten(list(string_split(term, ' ') ORDER BY r))) AS theme FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS r FROM k WHERE {where}) WHERE r <= 6 GROUP BY doc_id)"
    cleaned = keywords + f""", d0 AS (SELECT doc_id, term, score, source, {_key('term')} AS raw, {_collapse('term')} AS t2 FROM k),
        kd AS (SELECT raw AS dkey, count(*) AS df FROM (SELECT DISTINCT doc_id, raw FROM d0 WHERE raw <> '' AND contains(source, 'posts')) GROUP BY 1),
        d1 AS (SELECT doc_id, t2 AS term, score, source, {_key('t2')} AS dkey, (SELECT count(DISTINCT doc_id) FROM k) AS n FROM d0),
        d2 AS (SELECT d1.*, CASE WHEN score < 2.0 THEN 'score' WHEN {_reason('term')} IS NOT NULL THEN {_reason('term')} WHEN n >= 5 AND contains(source, 'posts') AND NOT contains({_key('term')}, 'the') AND coalesce(df, 0) / n >= 0.25 THEN 'df' WHEN dkey = '' THEN 'empty' END AS reason FROM d1 LEFT JOIN kd USING (dkey)),
        d3 AS (SELECT *, row_number() OVER (PARTITION BY doc_id, dkey, reason IS NULL ORDER BY score DESC, CASE source WHEN 'description' THEN 2 ELSE 1 END, term, source) AS r FROM d2),
        d4 AS (SELECT doc_id, term, score, source, CASE WHEN reason IS NULL AND r > 1 THEN 'duplicate' ELSE reason END AS reason FROM d3)"""
    has = lambda s: f"list_contains(string_split(source, '+'), '{s}')"
    share = lambda c: f"round(avg(CASE WHEN {c} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6)"
    cosine = lambda a, b: f"(list_dot_product({a}::DOUBLE[], {b}::DOUBLE[]) / (sqrt(list_dot_product({a}::DOUBLE[], {a}::DOUBLE[])) * sqrt(list_dot_product({b}::DOUBLE[], {b}::DOUBLE[]))))"
    community = lambda s: f"SELECT c_custkey + {(s - 1) * 100} AS community_id, c_name || '/{s}' AS name, c_custkey * {s} AS rank, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE c_mktsegment || ' {s}' END AS description, '2024-01-0{s}T00:00:00Z' AS seen_at, '2024-01-0{3 - s}T00:00:00Z' AS scraped_at, {s} AS seq FROM customer"
    link = lambda seq, q: f"SELECT l_suppkey AS community_id, l_partkey AS keyword_id, {q} AS score, {seq} AS seq FROM lineitem"
    return {
        "text_tokens": f"SELECT doc_id, CAST(len({_tokens('text')}) AS INTEGER) AS n, md5(array_to_string({_tokens('text')}, ' ')) AS digest FROM documents",
        "text_stop_filtered": f"SELECT doc_id, md5(array_to_string(list_transform({_tokens('text')}, lambda t: CASE WHEN {stop} THEN '|' ELSE t END), ' ')) AS digest FROM documents",
        "text_sentences": f"SELECT doc_id, CAST(len({sentences}) AS INTEGER) AS n, md5(array_to_string(list_transform({sentences}, lambda s: array_to_string(s, ' ')), '|')) AS digest FROM documents",
        "text_terms": f"SELECT doc_id, {_key('text')} AS dkey, CASE WHEN length(text) > 0 THEN round((length(text) - length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))) / length(text), 9) ELSE 0.0 END AS ratio, regexp_matches(text, '[{CJK}{CYRILLIC}{GREEK}]') AS script FROM documents",
        "text_counts": "SELECT c_custkey, CAST(CASE c_custkey % 3 WHEN 0 THEN trunc(CAST(printf('%.1f', c_custkey / 10) AS DOUBLE) * 1000) WHEN 1 THEN c_custkey * 1000 ELSE 0 END AS BIGINT) AS count FROM customer",
        "text_artifacts": f"WITH e AS (SELECT w, count(*) AS n FROM (SELECT unnest({_tokens('html')}) AS w FROM pages) GROUP BY w) SELECT w, n, coalesce({_reason('w')}, 'kept') AS reason FROM e",
        "text_keys": "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'page' ELSE 'p' END || page_id AS key, 'P' || page_id AS crawl, 't3_ab' || page_id AS post FROM pages",
        "text_theme_summary": f"WITH l AS (SELECT doc_id, 'Theme: ' || array_to_string({_tokens('text')}, ' ; ') AS line FROM documents) SELECT doc_id, CASE WHEN length(line) > 120 THEN rtrim(line[1:119]) || '…' ELSE line END AS line FROM l",
        "desc_document_frequency": desc + " SELECT term, df FROM df",
        "desc_common_words": desc + ", nn AS (SELECT count(*) AS n FROM documents) SELECT term FROM df, nn WHERE NOT contains(term, ' ') AND n >= 5 AND df >= greatest(2, round_even(0.05 * n, 0)) AND df / n >= 0.10",
        "doc_keywords_topk": keywords + " SELECT doc_id, rank, term, score FROM k",
        "posts_keywords_topk": posts_top + f" SELECT doc_id, CAST(rank AS INTEGER) AS rank, term, score FROM (SELECT doc_id, term, round(score, 6) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY round(score, 6) DESC, term) AS rank FROM es) WHERE rank <= {cfg.topk}",
        "posts_document_frequency": posts + " SELECT term, df FROM df",
        "merged_sources": keywords + """, m AS (SELECT doc_id, term, sum(score * w) AS score, array_to_string(list_sort(list_distinct(list(s))), '+') AS source FROM (
            SELECT *, 1.0 AS w, 'description' AS s FROM k WHERE rank <= 15 UNION ALL SELECT *, 1.5, 'posts' FROM k WHERE rank >= 10 UNION ALL SELECT *, 3.0, 'name' FROM k WHERE rank = 1) GROUP BY 1, 2)
            SELECT doc_id, term, round(score, 6) AS score, source, round(score / CASE WHEN sum(score) OVER o = 0 THEN 1 ELSE sum(score) OVER o END, 6) AS weight FROM m WINDOW o AS (PARTITION BY doc_id)""",
        "topk_with_phrase": keywords + """, x AS (SELECT k.doc_id, k.term, k.score, k.term = p.term AS own, row_number() OVER (PARTITION BY k.doc_id ORDER BY k.score DESC, k.term) AS place FROM k LEFT JOIN (SELECT doc_id, term FROM k WHERE rank = 20) p USING (doc_id)),
            y AS (SELECT *, max(CASE WHEN own THEN place END) OVER (PARTITION BY doc_id) AS own_at FROM x)
            SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, term) AS INTEGER) AS rank, term, score FROM y WHERE coalesce(own, false) OR place <= CASE WHEN own_at > 10 THEN 9 ELSE 10 END""",
        "core_and_extended": keywords + f" SELECT doc_id, rank, term FROM k e WHERE rank >= 5 AND NOT EXISTS (SELECT 1 FROM k c WHERE c.rank <= 8 AND c.doc_id = e.doc_id AND {_key('c.term')} = {_key('e.term')})",
        "theme_penalised": keywords + f", {theme('rank <= 12')}, zz AS MATERIALIZED (SELECT k.doc_id, rank, term, round(CASE WHEN len(theme) > 0 AND NOT list_has_any(string_split(term, ' '), theme) THEN score * 0.65::DOUBLE ELSE score END, 6) AS score FROM k LEFT JOIN th USING (doc_id)) SELECT * FROM zz",
        "anchored_keywords": keywords + f""", v AS (SELECT doc_id, 'f o o ' || term AS term, score * {cfg.anchor_multiplier}::DOUBLE AS score FROM k WHERE len(string_split(term, ' ')) <= 2 AND rank / 100 >= {cfg.anchor_generic_ratio} AND NOT contains(' ' || term || ' ', ' foo '))
            SELECT doc_id, term, round(score, 6) AS score FROM k UNION ALL SELECT doc_id, term, round(score, 6) FROM v WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.doc_id = v.doc_id AND k.term = v.term)""",
        "vector_similarity": f"SELECT a.vec_id, round({cosine('a.embedding', 'b.embedding')}, 6) AS cosine FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1",
        "reranked_keywords": keywords + f""", r AS (SELECT *, contains(source, 'posts') AS inside, row_number() OVER (PARTITION BY doc_id, contains(source, 'posts') ORDER BY score DESC, term) AS p FROM k)
            SELECT r.doc_id, rank, term, round(CASE WHEN inside AND p <= {cfg.embed_k} AND v.vec_id IS NOT NULL AND t.vec_id IS NOT NULL THEN score * ({1 - cfg.embed_alpha}::DOUBLE + {cfg.embed_alpha}::DOUBLE * ({cosine('v.embedding', 't.embedding')} + 1) / 2) ELSE score END, 6) AS score
            FROM r LEFT JOIN embeddings v ON v.vec_id = length(term) LEFT JOIN embeddings t ON t.vec_id = r.doc_id""",
        "cleaned_keywords": cleaned + " SELECT doc_id, term, round(score, 6) AS score, round(score / CASE WHEN sum(score) OVER o = 0 THEN 1 ELSE sum(score) OVER o END, 6) AS weight, source FROM d4 WHERE reason IS NULL WINDOW o AS (PARTITION BY doc_id)",
        "cleaning_drops": cleaned + " SELECT doc_id, reason, count(*) AS dropped FROM d4 WHERE reason IS NOT NULL GROUP BY ALL",
        "upserted_communities": f"WITH a AS ({community(1)} UNION ALL {community(2)}) SELECT community_id, max_by(name, seq) AS name, max_by(rank, seq) AS rank, max_by(description, CASE WHEN description <> '' THEN seq END) FILTER (WHERE description <> '') AS description, min_by(seen_at, seq) AS first_seen_at, max_by(seen_at, seq) AS last_seen_at, max(scraped_at) AS last_scraped_at FROM a GROUP BY 1",
        "keyword_dictionary": "WITH known AS (SELECT min(p_partkey) AS id, p_brand AS term FROM part GROUP BY 2), new AS (SELECT DISTINCT p_name AS term FROM part WHERE p_name NOT IN (SELECT term FROM known)) SELECT id, term FROM known UNION ALL SELECT (SELECT max(id) FROM known) + row_number() OVER (ORDER BY term), term FROM new",
        "upserted_links": f"WITH a AS ({link('l_orderkey * 10 + l_linenumber', 'l_quantity')} UNION ALL {link('l_orderkey * 10 + l_linenumber + 100000000', 'l_quantity + 1')}) SELECT community_id, keyword_id, score, seq FROM (SELECT *, row_number() OVER (PARTITION BY community_id, keyword_id ORDER BY seq DESC) AS r FROM a) WHERE r = 1",
        "changed_ingests": "WITH l AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) SELECT c_custkey AS input_file, 'F' AS file_hash FROM customer WHERE NOT EXISTS (SELECT 1 FROM l WHERE r = 1 AND o_custkey = c_custkey AND o_orderstatus = 'F' AND o_orderkey % 5 <> 0)",
        "orphaned_links": "SELECT (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0)) AS no_community, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)) AS no_keyword",
        "one_per_page": "WITH r AS (SELECT l_suppkey AS page, CASE WHEN l_partkey % 3 = 0 THEN '' ELSE CAST(l_partkey AS VARCHAR) END AS community_id, l_returnflag AS name, l_linestatus AS url, l_orderkey * 10 + l_linenumber AS seq FROM lineitem) SELECT page, community_id, name, url, seq FROM (SELECT *, row_number() OVER (PARTITION BY page, CASE WHEN community_id = '' THEN name || '/' || url ELSE community_id END ORDER BY seq) AS k FROM r) WHERE k = 1",
        "weekly_changes": changes + " SELECT * FROM ch",
        "weekly_summary": changes + " SELECT count(*) FILTER (WHERE status <> 'new') AS before, count(*) FILTER (WHERE status <> 'disappeared') AS after, count(*) FILTER (WHERE status = 'moved') AS moved, count(*) FILTER (WHERE abs(subscriber_change) > 300) AS large_changes, count(*) FILTER (WHERE status = 'new') AS new, count(*) FILTER (WHERE status = 'disappeared') AS disappeared FROM ch",
        "weekly_largest": changes + " SELECT name, subscriber_change FROM ch WHERE subscriber_change <> 0 ORDER BY abs(subscriber_change) DESC, name LIMIT 50",
        "snapshot_ids": "SELECT strftime(ts, '%G-W%V') AS week, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y-%m') AS month, count(*) AS n FROM events GROUP BY ALL",
        "work_splits": f"WITH {targets} SELECT name, rank, CAST((row_number() OVER o - 1) % 7 AS INTEGER) AS worker, CAST(ntile(7) OVER o - 1 AS INTEGER) AS block, CAST((row_number() OVER o - 1) // 9 AS INTEGER) AS chunk FROM t WINDOW o AS (ORDER BY rank, name)",
        "crawl_order": f"WITH {targets} SELECT name, rank FROM t ORDER BY rank, name LIMIT 40 OFFSET 5",
        "pending_targets": f"WITH {results} SELECT s_name AS name, CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey END AS rank FROM supplier WHERE s_name NOT IN (SELECT name FROM r WHERE error = '')",
        "error_kinds": f"WITH {results} SELECT CASE error WHEN '' THEN 'none' WHEN '{errors[1]}' THEN 'refused' WHEN '{errors[2]}' THEN 'timeout' WHEN '{errors[3]}' THEN 'closed' WHEN '{errors[4]}' THEN 'crashed' WHEN '{errors[5]}' THEN 'connectivity' ELSE 'other' END AS kind, count(*) AS n FROM r GROUP BY 1",
        "retry_list": f"WITH {results} SELECT DISTINCT 'r/' || name AS value FROM r WHERE error <> ''",
        "required_fields": "SELECT count(*) AS n, count(*) FILTER (WHERE o_orderkey % 9 = 0) AS missing_name, count(*) FILTER (WHERE o_orderkey % 5 = 0) AS missing_url, min(o_orderkey) AS least, max(o_orderkey) AS most, CAST(floor(sum(o_orderkey) / count(*)) AS BIGINT) AS mean, (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)) AS repeated FROM orders",
        "candidate_posts": "WITH p AS (SELECT user_id % 500 AS community, event_id AS pos, value AS score, CASE WHEN event_type <> 'error' THEN event_type END AS kind, event_id % 40 / 2 AS age_days FROM events) SELECT community, pos, score, kind, age_days FROM (SELECT *, row_number() OVER (PARTITION BY community ORDER BY pos) AS r FROM p WHERE score >= 10 AND (kind IS NULL OR kind IN ('view', 'click')) AND age_days <= 12) WHERE r <= 5",
        "keyword_shares": keywords + f" SELECT count(*) AS n, {share('NOT contains(term, chr(32))')} AS unigrams, {share('contains(term, chr(32))')} AS phrases, {share(has('name'))} AS name, {share(has('description'))} AS description, {share(has('posts'))} AS posts, {share(has('posts_composed'))} AS posts_composed FROM k",
        "score_quantiles": keywords + ", o AS (SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM k) SELECT max(score) FILTER (WHERE i = CAST(round_even(0.95 * (n - 1), 0) AS BIGINT)) AS nearest, max(score) FILTER (WHERE i = CAST(floor(n * 0.95) AS BIGINT)) AS floor, round(quantile_cont(score, 0.5), 6) AS p50, round(quantile_cont(score, 0.95), 6) AS p95 FROM o",
        "score_statistics": keywords + " SELECT count(score) AS n, round(avg(score), 6) AS mean, round(stddev_pop(score), 6) AS stdev, min(score) AS least, max(score) AS most FROM k",
        "threshold_retention": keywords + ", per AS (SELECT t AS threshold, doc_id, count(*) FILTER (WHERE score >= t) AS kept, count(*) AS n FROM k, (SELECT unnest([2, 5, 8, 12, 20])::DOUBLE AS t) GROUP BY ALL) SELECT threshold, CAST(sum(kept) AS BIGINT) AS kept, round(sum(kept) / sum(n), 6) AS share, round(avg(kept), 6) AS mean_kept, round(quantile_cont(kept, 0.5), 6) AS median_kept FROM per GROUP BY 1",
        "rank_decay": keywords + ", m AS (SELECT rank, count(*) AS n, avg(score) AS mean FROM k GROUP BY 1) SELECT rank, n, round(mean, 6) AS mean, round((mean - lead(mean, 5) OVER o) / mean * 100, 6) AS drop_ahead, CASE WHEN n >= 10 THEN round((lag(mean, 1) OVER o - mean) / lag(mean, 1) OVER o * 100, 6) END AS drop_before FROM m WINDOW o AS (ORDER BY rank)",
        "variant_groups": "WITH e AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '\\s+')) AS term FROM documents), g AS (SELECT regexp_replace(lower(term), '[^0-9a-z]+', '', 'g') AS dkey, list_sort(list(term)) AS v FROM e GROUP BY 1) SELECT dkey, CAST(len(v) AS INTEGER) AS n, md5(array_to_string(v, ' ')) AS digest FROM g WHERE len(v) > 1 AND dkey <> ''",
        "redundant_pairs": keywords + ", rj AS MATERIALIZED (SELECT a.doc_id, a.rank AS rank_a, a.term AS a, b.rank AS rank_b, b.term AS b FROM k a JOIN k b ON a.doc_id = b.doc_id AND a.rank < b.rank), c AS MATERIALIZED (SELECT *, CASE WHEN contains(a, b) OR contains(b, a) THEN 'substring' WHEN len(list_intersect(string_split(a, ' '), string_split(b, ' '))) / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' ')))) >= 0.7 THEN 'overlap' END AS kind FROM rj) SELECT * FROM c WHERE kind IS NOT NULL",
        "source_mix": keywords + " SELECT source, count(*) AS n, round(avg(score), 6) AS mean, contains(source, '+') AS several FROM k GROUP BY source",
        "tier_issues": keywords + f" SELECT CASE WHEN score >= 50 THEN '50+' WHEN score >= 20 THEN '20-50' WHEN score >= 10 THEN '10-20' WHEN score >= 5 THEN '5-10' ELSE '0-5' END AS tier, count(*) AS n, {share(_issue('term'))} AS issues FROM k GROUP BY 1",
        "dominant_words": keywords + ", dw AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(string_split(lower(term), ' ')) AS word FROM k) GROUP BY ALL), s AS (SELECT *, n / sum(n) OVER (PARTITION BY doc_id) AS share FROM dw) SELECT doc_id, word, n, round(share, 6) AS share FROM s WHERE share > 0.1",
        "version_diff": keywords + f""", va AS (SELECT DISTINCT doc_id, term FROM k WHERE rank <= 15), vb AS (SELECT DISTINCT doc_id, term FROM k WHERE score >= 5),
            x AS (SELECT coalesce(a.doc_id, b.doc_id) AS doc_id, coalesce(a.term, b.term) AS term, a.term IS NOT NULL AS was, b.term IS NOT NULL AS is_now FROM va a FULL JOIN vb b ON a.doc_id = b.doc_id AND a.term = b.term),
            d AS (SELECT doc_id, count(*) FILTER (WHERE is_now AND NOT was) AS gained, count(*) FILTER (WHERE was AND NOT is_now) AS lost, count(*) FILTER (WHERE was AND is_now) AS same, count(*) FILTER (WHERE was AND {_mechanical('term')}) AS mechanical_before, count(*) FILTER (WHERE is_now AND {_mechanical('term')}) AS mechanical_after FROM x WHERE doc_id IN (SELECT doc_id FROM va) AND doc_id IN (SELECT doc_id FROM vb) GROUP BY 1)
            SELECT *, CASE WHEN mechanical_after < mechanical_before THEN 'better' WHEN mechanical_after > mechanical_before THEN 'worse' ELSE 'same' END AS verdict FROM d""",
        "theme_alignment": keywords + f", {theme('rank > 3')} SELECT k.doc_id, round(sum(len(list_filter(string_split(term, ' '), lambda t: list_contains(theme, t))) / len(string_split(term, ' ')) * score / rank), 6) AS alignment FROM k JOIN th USING (doc_id) WHERE rank <= 10 GROUP BY 1",
        "score_separation": keywords + ", z AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM k) SELECT doc_id, round((avg(score) FILTER (WHERE rank <= 5) - avg(score) FILTER (WHERE rank > n - 5)) / avg(score) FILTER (WHERE rank <= 5), 6) AS separation, count(DISTINCT source) FILTER (WHERE rank <= 10) / 10 AS diversity FROM z GROUP BY 1",
        "phrase_quality": keywords + f", p AS (SELECT DISTINCT term, string_split(lower(term), ' ') AS w FROM k WHERE contains(term, ' ')) SELECT term, round({_coherence()}, 6) AS coherence, {_mechanical('term')} AS mechanical, {_issue('term')} AS issue, list_has_any(w, {_list(PROMOTION)}) AS promotional FROM p",
        "size_buckets": f"SELECT {bucket('>=')} AS bucket, {bucket('>')} AS exclusive, count(*) AS n FROM orders GROUP BY ALL",
        "event_windows": "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
    } | _reports(keywords, cfg)
