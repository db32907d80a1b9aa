"""DuckDB SQL with the same rows as the catalogue's queries over `measures`."""

from __future__ import annotations

from .catalog_sql import _coherence, _issue, _list, _mechanical, _repeats, common_tables
from .config import KeywordConfig
from .operators.measures import LOW_VALUE, TAIL_ADVERTS
from .operators.quality import CONNECTORS


def _marked(c: str) -> str:
    """SQL that puts a bar where the parts of a name meet."""
    out = f"regexp_replace({c}, '[^0-9A-Za-z]+', '|', 'g')"
    for left, right in (("[a-z0-9]", "[A-Z]"), ("[A-Z]", "[A-Z][a-z]"), ("[A-Za-z]", "[0-9]"), ("[0-9]", "[A-Za-z]")):
        out = f"regexp_replace({out}, '({left})({right})', '\\1|\\2', 'g')"
    return out


def build(cfg: KeywordConfig) -> dict[str, str]:
    """SQL by query name."""
    core = common_tables(cfg)
    keywords, posts_top = core["keywords"], core["posts_top"]
    mixed = keywords + ", kc AS (SELECT doc_id, rank, term, score, CASE WHEN length(term) % 2 = 0 THEN 'posts_composed' WHEN rank % 3 = 0 THEN 'posts' ELSE 'description+posts' END AS source FROM k)"
    off = mixed + """, th AS (SELECT doc_id, list_distinct(flatten(list(string_split(term, ' ')))) AS theme FROM kc WHERE rank <= 4 AND doc_id % 3 = 0 GROUP BY 1),
        o AS (SELECT term, NOT coalesce(list_has_any(string_split(term, ' '), theme), false) AS off FROM kc LEFT JOIN th USING (doc_id) WHERE source <> 'posts_composed')"""
    seeded = keywords + """, an AS (SELECT doc_id, term AS phrase, string_split(term, ' ')[1] AS token FROM k WHERE rank = 1),
        mk AS (SELECT doc_id, rank + 100 AS rank, CASE WHEN rank % 2 = 0 THEN phrase ELSE token END || ' ' || term AS term, score * 2.5::DOUBLE + rank AS score FROM k JOIN an USING (doc_id) WHERE rank > 1 AND length(term) % 2 = 1),
        sd AS (SELECT mk.*, CASE WHEN starts_with(term, phrase || ' ') THEN substring(term, length(phrase) + 2) WHEN starts_with(term, token || ' ') THEN substring(term, length(token) + 2) END AS seed FROM mk JOIN an USING (doc_id)),
        se AS MATERIALIZED (SELECT sd.doc_id, sd.rank, sd.term, seed, k.score AS seed_score, CASE WHEN k.score > 0 THEN sd.score / k.score END AS ratio FROM sd LEFT JOIN k ON k.doc_id = sd.doc_id AND k.term = seed)"""
    rate = lambda test: f"avg(CASE WHEN {test} THEN 1.0::DOUBLE ELSE 0 END)"
    bad = f"({_repeats('term')} OR {_mechanical('term')})"
    holds = lambda c, ws: "(" + " OR ".join(f"contains({c}, '{w}')" for w in ws) + ")"
    found = [f"CASE WHEN contains(lower(term), '{w}') THEN {{'category': '{c}', 'leak': '{w}'}} END" for c, ws in LOW_VALUE.items() for w in ws]
    found += [f"CASE WHEN contains(term, ' ') AND contains(lower(term), '{p}') THEN {{'category': 'phrase_stoplist', 'leak': '{p}'}} END" for p in ("on the", "and the")]
    found += ["CASE WHEN list_has_any(string_split(lower(term), ' '), ['in', 'ing', 'de']) THEN {'category': 'extra_stopwords', 'leak': ''} END"]
    leaked = mixed + f", lk AS (SELECT score, l.category AS category FROM (SELECT score, unnest(list_filter([{', '.join(found)}], lambda x: x IS NOT NULL)) AS l FROM kc))"
    words = "list_distinct(string_split(lower(term), ' '))"
    return {
        "off_theme_rate": off + f" SELECT count(*) AS n, sum(off::BIGINT)::BIGINT AS off, round({rate('off')}, 6) AS rate FROM o",
        "off_theme_terms": off + """, c AS (SELECT term, count(*) AS n, len(string_split(term, ' ')) AS w FROM o WHERE off GROUP BY 1),
            e AS (SELECT 'all' AS kind, term, n FROM c UNION ALL SELECT CASE w WHEN 1 THEN 'unigram' WHEN 2 THEN 'bigram' ELSE 'trigram' END, term, n FROM c),
            p AS (SELECT kind, CAST(row_number() OVER (PARTITION BY kind ORDER BY n DESC, term) AS INTEGER) AS place, term, n FROM e)
            SELECT * FROM p WHERE place <= CASE kind WHEN 'all' THEN 40 ELSE 30 END""",
        "composed_seeds": seeded + " SELECT doc_id, rank, term, seed, seed_score, round(ratio, 6) AS ratio FROM se",
        "composed_statistics": seeded + " SELECT count(*) AS n, round(avg(rank), 6) AS mean_rank, min(rank) AS best_rank, max(rank) AS last_rank, count(ratio) AS ratios, round(avg(ratio), 6) AS mean_ratio, round(median(round(ratio, 6)), 6) AS median_ratio, round(min(ratio), 6) AS least_ratio, round(max(ratio), 6) AS most_ratio FROM se",
        "composition_rates": mixed + f", p AS (SELECT doc_id, {rate('''contains(source, 'composed')''')} AS rate FROM kc WHERE rank <= 10 GROUP BY 1) SELECT count(*) AS documents, round(avg(rate), 6) AS mean, round(median(rate), 6) AS median, sum((rate > 0.5)::BIGINT)::BIGINT AS over_half, sum((rate > 0.8)::BIGINT)::BIGINT AS over_four_fifths FROM p",
        "new_composed": mixed + " SELECT doc_id, term, score FROM kc WHERE source = 'posts_composed' AND rank % 4 = 0",
        "term_variants": keywords + """, s AS (SELECT doc_id, unnest([term, CASE WHEN length(term) % 3 = 0 THEN translate(term, 'aei', 'AEI') END, CASE WHEN length(term) % 4 = 0 THEN replace(term, ' ', '-') END, CASE WHEN length(term) % 5 = 0 THEN term || '!' END]) AS term FROM k WHERE rank <= 8),
            v AS (SELECT doc_id, 'spacing' AS kind, regexp_replace(lower(term), '\\s+', '', 'g') AS form, term FROM s WHERE term IS NOT NULL
              UNION ALL SELECT doc_id, 'punctuation', trim(regexp_replace(regexp_replace(lower(term), '[^\\p{L}\\p{N}_\\s]', '', 'g'), '\\s+', ' ', 'g')), term FROM s WHERE term IS NOT NULL)
            SELECT doc_id, kind, form, array_to_string(list_sort(list(term)), '|') AS terms FROM v GROUP BY ALL HAVING count(*) > 1""",
        "dominant_sources": mixed + """, x AS (SELECT doc_id, rank, CASE WHEN doc_id % 4 = 0 THEN 'posts' ELSE source END AS source FROM kc),
            n AS (SELECT doc_id, source, count(*) AS n FROM x WHERE rank <= 20 GROUP BY ALL),
            bs AS (SELECT doc_id, max({'n': n, 'source': source}) AS b, sum(n) AS every FROM n WHERE doc_id IN (SELECT doc_id FROM x GROUP BY 1 HAVING count(*) >= 10) GROUP BY 1)
            SELECT doc_id, b.source AS source, round(b.n / every, 6) AS share FROM bs WHERE b.n / every > 0.8""",
        "score_anomalies": keywords + ", p AS (SELECT doc_id, max(score) AS most, avg(score) AS mean, arg_min(term, rank) AS term FROM k GROUP BY 1 HAVING count(*) > 1) SELECT doc_id, most, round(mean, 6) AS mean, term, round(most / (mean + 1e-6::DOUBLE), 6) AS ratio FROM p WHERE most / (mean + 1e-6::DOUBLE) > 2",
        "topk_scenarios": keywords + """, s AS (SELECT unnest([8, 10, 15, 20]) AS k), n AS (SELECT doc_id, count(*) AS n FROM k GROUP BY 1),
            c AS (SELECT s.k, count(*) AS documents, sum((n >= 10)::BIGINT) - sum((n > s.k)::BIGINT) AS helped FROM n CROSS JOIN s GROUP BY 1),
            m AS (SELECT s.k, count(*) AS more, avg(score) AS mean FROM k JOIN s ON rank > s.k AND rank <= s.k + 5 GROUP BY 1)
            SELECT c.k AS k, documents, helped::BIGINT AS helped, coalesce(more, 0) AS more, round(coalesce(mean, 0), 6) AS mean, CASE WHEN mean > 3 THEN 'recommended' WHEN mean > 2 THEN 'marginal' ELSE 'not recommended' END AS advice FROM c LEFT JOIN m USING (k)""",
        "tail_ranks": keywords + f" SELECT CASE WHEN rank <= 10 THEN 5 ELSE 6 + 5 * ((rank - 6) // 5) END::INTEGER AS from_rank, count(*) AS n, round(avg(score), 6) AS mean, round(median(score), 6) AS median, round({rate(f'NOT ({holds('lower(term)', TAIL_ADVERTS)} OR len(list_distinct(string_split(term, chr(32)))) < len(string_split(term, chr(32))))')}, 6) AS fine FROM k WHERE rank BETWEEN 5 AND 24 GROUP BY 1",
        "source_issues": mixed + f" SELECT source, count(*) AS n, round(avg(score), 6) AS mean, round({rate(bad)}, 6) AS issues FROM kc WHERE rank <= 20 GROUP BY 1",
        "good_examples": mixed + f", ge AS (SELECT *, string_split(lower(term), ' ') AS w FROM kc WHERE rank <= 10 AND score > 5 AND len(string_split(term, ' ')) BETWEEN 2 AND 4) SELECT doc_id, term, score, source FROM ge WHERE NOT {_issue('term')} AND (list_has_any(w, {_list(CONNECTORS)}) OR {_coherence()} >= 0.5)",
        "first_issues": keywords + f", t AS (SELECT DISTINCT term FROM k) SELECT CASE WHEN {_repeats('term')} THEN 'repeat' WHEN {holds('lower(term)', ['the of', 'thing'])} THEN 'mechanical' WHEN {holds('lower(term)', ['season 3', 'shop'])} THEN 'advert' WHEN regexp_matches(lower(term), 'https?://|\\.com|[0-9a-f]{{8}}') THEN 'technical' ELSE 'none' END AS kind, count(*) AS n FROM t GROUP BY 1",
        "leak_rates": leaked + " SELECT category, count(*) AS n, round(count(*) / (SELECT count(*) FROM kc), 6) AS rate, max(score) AS best FROM lk GROUP BY 1",
        "leak_grade": leaked + ", lg AS (SELECT (SELECT count(*) FROM lk WHERE category <> 'phrase_stoplist') AS leaks, (SELECT count(*) FROM kc) AS n) SELECT leaks, n, round(leaks / n, 6) AS rate, CASE WHEN leaks / n < 0.001 THEN 'A+' WHEN leaks / n < 0.005 THEN 'A' WHEN leaks / n < 0.01 THEN 'B+' WHEN leaks / n < 0.02 THEN 'B' ELSE 'C' END AS grade FROM lg",
        "keywords_with_pages": keywords + " SELECT doc_id, rank, term, url FROM k LEFT JOIN pages ON doc_id = page_id * 2",
        "communities_with_posts": "WITH d AS (SELECT 'c' || doc_id AS key FROM documents), f AS (SELECT DISTINCT 'c' || conv_id AS key FROM conversations) SELECT key, false AS cached FROM d WHERE key IN (SELECT key FROM f) UNION ALL SELECT DISTINCT key, true FROM d WHERE key NOT IN (SELECT key FROM f)",
        "available_targets": "WITH t AS (SELECT lower(s_name) AS name, min(coalesce(CASE WHEN s_suppkey % 7 <> 0 THEN s_nationkey END, 1000000000000)) AS rank FROM supplier GROUP BY 1) SELECT name, rank FROM t WHERE name IN (SELECT lower(s_name) FROM supplier WHERE s_suppkey % 7 = 0)",
        "top_posts": "WITH p AS (SELECT user_id % 500 AS doc_id, event_id AS post, floor(value)::BIGINT AS score, event_id % 7 AS comments FROM events), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, comments DESC, post) AS INTEGER) AS place FROM p) SELECT * FROM r WHERE place <= 5",
        "source_posts": posts_top + f", ph AS (SELECT doc_id, term FROM rk WHERE rank <= 12 AND n >= 2), pj AS (SELECT ph.doc_id, term, turn AS post, len(list_filter({words}, lambda x: contains(lower(coalesce(text, '')), x))) / len({words}) AS overlap FROM ph JOIN conversations ON conv_id = doc_id), pr AS (SELECT *, row_number() OVER (PARTITION BY doc_id, term ORDER BY overlap DESC, post) AS r FROM pj WHERE overlap >= 0.6) SELECT doc_id, term, post, round(overlap, 6) AS overlap FROM pr WHERE r <= 2",
        "comment_tree": "WITH c AS (SELECT l_orderkey AS post, l_linenumber AS comment, CASE WHEN l_linenumber > 1 THEN l_linenumber // 2 + CASE WHEN l_partkey % 11 = 0 THEN 50 ELSE 0 END END AS parent FROM lineitem), a AS (SELECT post, parent AS comment, count(*) AS answers FROM c WHERE parent IS NOT NULL GROUP BY ALL) SELECT c.post, c.comment, c.parent, coalesce(answers, 0) AS answers, EXISTS (SELECT 1 FROM c x WHERE x.post = c.post AND x.comment = c.parent) AS parent_known FROM c LEFT JOIN a ON a.post = c.post AND a.comment = c.comment",
        "best_dataset": "SELECT s_name AS name, s_suppkey % 9 AS max_page, s_suppkey % 5 = 0 AS complete FROM supplier ORDER BY 2 DESC, 3 DESC, 1 LIMIT 1",
        "failed_targets": "WITH o AS (SELECT unnest(CASE WHEN o_orderkey % 10 = 0 THEN [o_orderpriority, o_orderstatus] ELSE [] END) AS name FROM orders) SELECT DISTINCT name FROM o WHERE name <> ''",
        "category_improvement": "WITH r AS (SELECT l_returnflag AS category, count(*) AS n, avg(CASE WHEN l_partkey % 9 > l_suppkey % 7 THEN 1.0::DOUBLE ELSE 0 END) AS rate FROM lineitem GROUP BY 1) SELECT category, n, round(rate, 6) AS rate, CASE WHEN rate > 0.6 THEN 'high' WHEN rate >= 0.3 THEN 'medium' ELSE 'low' END AS tier FROM r",
        "ingest_log_rows": "SELECT (SELECT max(o_orderkey) FROM orders) + row_number() OVER (ORDER BY s_name) AS id, s_name AS input_file, md5(s_name) AS file_hash, '2024-01-01' AS processed_at, CASE WHEN s_suppkey % 4 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN s_suppkey % 4 = 0 THEN 'broken line' END AS error FROM supplier",
        "warehouse_integrity": "WITH c AS (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0), k AS (SELECT p_partkey FROM part WHERE p_size > 10) SELECT (SELECT count(*) FROM c) AS communities, (SELECT count(*) FROM k) AS keywords, (SELECT count(*) FROM lineitem) AS links, (SELECT count(*) FROM lineitem WHERE l_suppkey NOT IN (SELECT * FROM c)) AS no_community, (SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT * FROM k)) AS no_keyword",
        "sampled_files": "SELECT name FROM (SELECT s_name AS name FROM supplier ORDER BY md5('13:' || s_name), s_name LIMIT 20)",
        "stratified_files": "WITH t AS (SELECT s_name AS name, CAST(ntile(3) OVER (ORDER BY s_name) AS INTEGER) AS third FROM supplier), r AS (SELECT *, row_number() OVER (PARTITION BY third ORDER BY md5('13:' || name), name) AS r FROM t) SELECT name, third FROM r WHERE r <= 5",
        "text_camel_split": "SELECT c_custkey, CASE WHEN upper(c_name) = c_name AND lower(c_name) <> c_name AND length(c_name) <= 5 THEN c_name ELSE array_to_string(list_filter(string_split(" + _marked("c_name") + ", '|'), lambda x: x <> ''), '|') END AS parts FROM customer",
    }
