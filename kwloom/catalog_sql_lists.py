"""DuckDB SQL with the same rows as the catalogue's queries over names, word lists, redundancy and loads."""

from __future__ import annotations

from .catalog_sql import _collapse, _key, _list, _mechanical, _pairs, _repeats, _tokens, common_tables
from .config import EXPANSIONS, SHORT_WORDS, KeywordConfig
from .operators import reports, segment, wordlists
from .operators.quality import PROMOTION

#: Glued names and the corpus's word counts.
GLUED = f"""WITH RECURSIVE tk AS (SELECT conv_id * 1000 + turn AS doc_id, list_filter({_tokens('text')}, lambda t: regexp_full_match(t, '[a-z]+')) AS w FROM conversations),
    gl AS (SELECT doc_id, min(array_to_string(w[1:3], '')) AS name FROM tk WHERE length(array_to_string(w[1:3], '')) >= 9 GROUP BY 1),
    ct AS (SELECT word, count(*) AS n FROM (SELECT unnest({_tokens('text')}) AS word FROM documents) WHERE regexp_full_match(word, '[a-z]+') GROUP BY 1),
    al AS (SELECT sum(n)::DOUBLE AS every FROM ct),
    co AS MATERIALIZED (SELECT word, CAST(round({segment.UNIT} * (ln(every) - ln(n::DOUBLE))) AS BIGINT) AS cost FROM ct, al),
    wd AS MATERIALIZED (SELECT DISTINCT name AS word FROM gl WHERE length(name) <= {segment.LONGEST}),
    sp AS (SELECT word, s, unnest(range(1, least({segment.PIECE}, length(word) - s + 1) + 1)) AS n FROM (SELECT word, unnest(range(1, length(word) + 1)) AS s FROM wd)),
    pc AS MATERIALIZED (SELECT sp.word, s + n - 1 AS e, list({{'s': s, 'cost': coalesce(co.cost, CAST(round({segment.UNIT} * (ln(every) + (n - 1) * ln(10::DOUBLE))) AS BIGINT))}}) AS ways
      FROM sp CROSS JOIN al LEFT JOIN co ON co.word = substring(sp.word, s, n) GROUP BY ALL),
    dp AS (SELECT word, 0::BIGINT AS e, [{{'cost': 0::BIGINT, 'n': 0::BIGINT, 's': 0::BIGINT}}] AS best FROM wd
      UNION ALL SELECT dp.word, dp.e + 1, list_append(best, list_min(list_transform(ways, lambda x: {{'cost': best[x.s].cost + x.cost, 'n': best[x.s].n + 1, 's': x.s}}))) FROM dp JOIN pc ON pc.word = dp.word AND pc.e = dp.e + 1),
    bt AS (SELECT word, best, length(word)::BIGINT AS e, []::VARCHAR[] AS parts FROM dp WHERE e = length(word)
      UNION ALL SELECT word, best, best[e + 1].s - 1, list_prepend(substring(word, best[e + 1].s, e - best[e + 1].s + 1), parts) FROM bt WHERE e > 0),
    sg AS (SELECT word, parts FROM bt WHERE e = 0)"""


def _names(source: str, stop: str) -> str:
    """Scores of names from source(doc_id, parts): terms without stopwords, and the whole name, stopwords and all, once more."""
    by_words = "CASE len(string_split(term, ' ')) WHEN 1 THEN 1.0 WHEN 2 THEN 1.5 ELSE 2.5 END"
    return f"""nk AS (SELECT doc_id, parts, list_filter(parts, lambda t: NOT {stop}) AS w FROM {source}),
        ex AS (SELECT unnest({_list(EXPANSIONS)}) AS short, unnest({_list(EXPANSIONS.values())}) AS long),
        tm AS (SELECT DISTINCT doc_id, unnest(list_concat([array_to_string(w, ' ')], w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS term FROM nk
          UNION SELECT doc_id, long FROM nk, ex WHERE list_contains(parts, short)),
        bo AS (SELECT doc_id, term FROM tm WHERE term <> '' UNION ALL SELECT doc_id, array_to_string(parts, ' ') FROM nk)
        SELECT doc_id, term, sum({by_words})::DOUBLE AS score FROM bo GROUP BY 1, 2"""


def _alike(kind: str, a: str, b: str) -> str:
    """Whether two terms (structs rank, term, words, low, bare, dkey) are alike."""
    shared = f"len(list_intersect({a}.low, {b}.low))"
    share = lambda least: f"coalesce({shared} / (len({a}.low) + len({b}.low) - {shared}) >= {least}::DOUBLE, false)"
    prefixed = f"(len({a}.words) > 1 AND len({b}.words) > 1 AND ({a}.words[2:] = {b}.words OR {a}.words = {b}.words[2:]))"
    return {"spacing": f"{a}.bare = {b}.bare", "overlap": share(0.7), "prefix": prefixed, "variant": f"({a}.dkey = {b}.dkey OR {share(0.8)} OR {prefixed})"}[kind]


def _grouped(kind: str, source: str, top: int, tag: str) -> str:
    """CTEs ending in m<tag>(doc_id, ts, j, lead): the place of each term's leader."""
    words = "list_filter(regexp_split_to_array({}, '\\s+'), lambda w: w <> '')"
    return f"""l{tag} AS MATERIALIZED (SELECT doc_id, list({{'rank': rank, 'term': term, 'words': {words.format('term')}, 'low': list_distinct({words.format('lower(term)')}), 'bare': regexp_replace(lower(term), '\\s+', '', 'g'), 'dkey': {_key('term')}}} ORDER BY rank, term) AS ts
          FROM {source} WHERE rank <= {top} GROUP BY 1),
        r{tag} AS (SELECT doc_id, ts, 0::BIGINT AS i, []::BIGINT[] AS leads FROM l{tag}
          UNION ALL SELECT doc_id, ts, i + 1, CASE WHEN len(list_filter(leads, lambda x: {_alike(kind, 'ts[x]', 'ts[i + 1]')})) > 0 THEN leads ELSE list_append(leads, i + 1) END FROM r{tag} WHERE i < len(ts)),
        u{tag} AS (SELECT doc_id, ts, leads, unnest(range(1, len(ts) + 1)) AS j FROM r{tag} WHERE i = len(ts)),
        m{tag} AS (SELECT doc_id, ts, j, list_filter(leads, lambda x: x = j OR (x < j AND {_alike(kind, 'ts[x]', 'ts[j]')}))[1] AS lead FROM u{tag})"""


def _fragment() -> str:
    """Mean likeness of neighbouring words of the list w: 0.3 by length, 0.4 by shared letters over the longer word, 0.3 if one begins or ends as the other."""
    a, b = "w[i]", "w[i + 1]"
    longer = f"greatest(length({a}), length({b}), 1)"
    same = f"len(list_intersect(list_distinct(string_split({a}, '')), list_distinct(string_split({b}, ''))))"
    ends = f"(starts_with({a}, left({b}, 2)) OR starts_with({b}, left({a}, 2)) OR ends_with({a}, right({b}, 2)) OR ends_with({b}, right({a}, 2)))"
    return _pairs(f"(1 - abs(length({a}) - length({b})) / {longer}) * 0.3::DOUBLE + {same} / {longer} * 0.4::DOUBLE + CASE WHEN {ends} AND length({a}) > 2 THEN 0.3::DOUBLE ELSE 0 END")


def _pages() -> dict[str, str]:
    """What extractors must find in pages that are made of the tables' values: these values."""
    thousands = lambda c: f"CAST(floor({c} / 10.0::DOUBLE * 1000) AS BIGINT)"
    whole = "CAST(floor(abs({})) AS BIGINT)"
    place = lambda key, order: f"CAST(row_number() OVER (PARTITION BY {key} ORDER BY {order}) - 1 AS INTEGER)"
    return {
        "html_communities": f"SELECT c_nationkey + 1 AS page, CAST(c_nationkey * 50 + {place('c_nationkey', 'c_custkey')} + 1 AS INTEGER) AS rank, c_custkey::VARCHAR AS community_id, 'r/' || c_name AS name, '/r/' || c_name || '/' AS url, {whole.format('c_acctbal')} || ' members' AS displayed_count, c_mktsegment AS description, 'https://i.example/' || c_custkey AS icon_url, CASE WHEN c_custkey % 5 <> 0 THEN {whole.format('c_acctbal')} ELSE 0 END::BIGINT AS subscribers_count FROM customer",
        "html_posts": f"""WITH o AS (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS price, 'Order ' || o_orderkey || ' ' || o_orderpriority AS t FROM orders)
            SELECT o_custkey AS page, {place('o_custkey', 'o_orderkey')} AS pos, t AS title, 'https://h.example/r/x/comments/' || o_orderkey || '/t/' AS permalink, 't3_' || o_orderkey AS post_id, o_orderstatus AS post_type, 'Clerk ' || o_custkey AS author, CASE WHEN o_orderkey % 3 = 0 THEN t || ' was placed by Clerk ' || o_custkey ELSE '' END AS content_preview, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority ELSE '' END AS flair,
            'https://i.example/' || o_orderkey || '.png' AS thumbnail_url, o_orderkey % 7 = 0 AS is_promoted, {thousands('(price % 1000)')} AS score, price AS comments FROM o""",
        "html_comments": f"""WITH l AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_suppkey DESC, floor(l_quantity) DESC, l_returnflag DESC, l_shipdate DESC) = 1),
            c AS (SELECT *, {place('l_orderkey', 'l_linenumber')} AS pos, CAST(floor(l_quantity) AS BIGINT) AS n, 't1_' || l_orderkey || '_' AS own FROM l)
            SELECT l_orderkey AS page, pos, own || l_linenumber AS id, CASE WHEN l_linenumber > 1 THEN own || (l_linenumber - 1) END AS parent_id, CAST(l_linenumber - 1 AS INTEGER) AS depth, 'ship ' || l_suppkey AS author, n AS score, CAST(n % 3 AS INTEGER) AS award_count, l_returnflag AS content_type, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS created_ts, 'Shipped by ship ' || l_suppkey AS body, 'a1:2:Gold' AS awards FROM c WHERE l_linenumber <= 5""",
        "html_metadata": f"""SELECT s_suppkey, s_name AS title, CASE WHEN s_suppkey % 2 = 0 THEN s_name ELSE 'all about ' || s_name END AS description, CASE WHEN s_suppkey % 2 = 0 THEN {thousands(whole.format('s_acctbal'))} ELSE 0 END::BIGINT AS subscribers, CASE WHEN s_suppkey % 2 = 0 THEN {whole.format('s_acctbal')} ELSE 0 END::BIGINT AS online_users, 'Be kind:about ' || s_suppkey || '|Stay on topic:' AS rules, 'No ' || s_suppkey AS title_old FROM supplier""",
        "html_embedded_communities": f"SELECT c_nationkey AS page, {place('c_nationkey', 'c_custkey')} AS pos, c_custkey::VARCHAR AS community_id, 'r/' || c_name AS name, {whole.format('c_acctbal')} AS subscribers_count, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS description FROM customer",
        "html_post_details": "SELECT o_orderkey, 'Order ' || o_orderkey AS post_title, 'by Clerk ' || o_custkey AS text_body, o_orderpriority AS post_type, 2 AS attrs, 'https://i.example/' || o_custkey || '.png' AS images, 'v' || o_orderkey || '.mp4' AS videos, CASE WHEN o_orderkey % 2 = 0 THEN 'https://e.example' ELSE '' END AS embeds FROM orders",
    }


def build(cfg: KeywordConfig) -> dict[str, str]:
    """SQL by query name."""
    core = common_tables(cfg)
    keywords, stop = core["keywords"].replace("WITH ", "WITH RECURSIVE ", 1), core["stop"]
    varied = keywords + """, e AS (SELECT doc_id, rank, score, source, term, unnest(range(0, 4)) AS v FROM k WHERE rank <= 8),
        v0 AS (SELECT doc_id, rank * 4 + v AS pl, score + v / 8.0::DOUBLE AS score, source, CASE v WHEN 0 THEN term WHEN 1 THEN CASE WHEN rank % 3 = 0 THEN replace(term, ' ', '') END WHEN 2 THEN CASE WHEN rank % 2 = 0 THEN 'x ' || term END ELSE CASE WHEN rank % 4 = 1 THEN term || ' ' || string_split(term, ' ')[1] END END AS term FROM e),
        vk AS (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY pl) AS INTEGER) AS rank, term, round(score, 6) AS score, CASE WHEN pl % 2 = 0 THEN 'posts_composed' ELSE source END AS source FROM (SELECT DISTINCT ON (doc_id, term) * FROM v0 WHERE term IS NOT NULL ORDER BY doc_id, term, pl))"""
    placed = keywords + """, cx AS (SELECT doc_id, rank, CASE WHEN rank % 5 = 0 THEN term || ' Steam deck' WHEN rank % 7 = 0 THEN 'breaking news ' || term WHEN rank % 4 = 0 THEN term || ' game city time' WHEN rank % 6 = 1 THEN 'youtube ' || term || ' tonight' ELSE term END AS term, CASE WHEN rank % 2 = 0 THEN 'posts_composed' ELSE 'posts' END AS source FROM k),
        nm AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'r/Gaming' WHEN 1 THEN 'r/worldnews' WHEN 2 THEN 'r/Steam_' ELSE 'r/x' END || doc_id AS name FROM documents WHERE doc_id % 9 <> 0)"""
    holds = lambda c, ws: "(" + " OR ".join(f"contains(lower({c}), '{w}')" for w in ws) + ")"
    mismatch = " UNION ALL ".join(f"SELECT doc_id, rank, term, '{c}' AS context FROM cx LEFT JOIN nm USING (doc_id) WHERE rank <= 15 AND {holds('term', ws)} AND NOT coalesce({holds('name', own)}, false)" for c, (ws, own) in wordlists.CONTEXTS.items())
    words = "list_filter(regexp_split_to_array(term, '\\s+'), lambda w: w <> '')"
    misuse = " UNION ALL ".join(f"SELECT doc_id, rank, term, '{b}' AS brand FROM cx LEFT JOIN nm USING (doc_id) WHERE rank <= 20 AND contains(source, 'composed') AND len({words}) >= 3 AND {holds('term', ws)} AND NOT coalesce(contains(lower(name), '{b}'), false)" for b, ws in wordlists.BRANDS.items() if b not in wordlists.ANYWHERE)
    fields = ", ".join(f"CASE WHEN {holds('term', ws)} THEN '{f}' END" for f, ws in sorted(wordlists.FIELDS.items()))
    union = " UNION ALL ".join(f"SELECT doc_id, '{k}' AS kind, ts[lead].term AS lead, ts[j].rank AS rank, ts[j].term AS term FROM m{k[0]} QUALIFY count(*) OVER (PARTITION BY doc_id, lead) > 1" for k in ("spacing", "overlap", "prefix"))
    variant = f"""SELECT doc_id, vk.rank AS rank, vk.term AS term, score, source, lead,
          score * CASE WHEN len(list_distinct(w)) < len(w) THEN 0.5::DOUBLE ELSE 1.0 END * CASE WHEN {_key('vk.term')} = own THEN 1.2::DOUBLE ELSE 1.0 END * CASE WHEN contains(source, 'composed') THEN 1.1::DOUBLE ELSE 1.0 END * CASE WHEN len(w) > 6 THEN 0.9::DOUBLE ELSE 1.0 END AS v
          FROM (SELECT doc_id, ts[j].rank AS rank, ts[j].term AS term, lead FROM mv) x JOIN (SELECT *, list_filter(regexp_split_to_array(lower(term), '\\s+'), lambda w: w <> '') AS w FROM vk) vk USING (doc_id, rank, term) LEFT JOIN ow USING (doc_id)"""
    mixed = core["keywords"] + ", kc AS (SELECT doc_id, rank, term, score, CASE WHEN length(term) % 2 = 0 THEN 'posts_composed' WHEN rank % 3 = 0 THEN 'posts' ELSE 'description+posts' END AS source FROM k)"
    counts = f"""ct AS (SELECT word, count(*) AS n FROM (SELECT unnest({_tokens('text')}) AS word FROM documents) WHERE regexp_full_match(word, '[a-z]+') GROUP BY 1),
        zf AS (SELECT word, log10(1e9::DOUBLE * n / (SELECT sum(n) FROM ct)) AS zipf FROM ct)"""
    frequent = core["desc"].replace("WITH src", f"WITH {counts}, fw AS (SELECT word FROM zf WHERE zipf >= 6.5 AND NOT list_contains({_list(SHORT_WORDS)}, word)), src", 1).replace("OR regexp_full_match(t0,", "OR t0 IN (SELECT word FROM fw) OR regexp_full_match(t0,", 1)
    subject = core["posts"] + f""", sj AS (SELECT DISTINCT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS subject FROM (SELECT {_tokens('text')} AS w FROM documents)),
        fo AS (SELECT doc_id, term, tf::DOUBLE AS score FROM tf WHERE n >= 2 AND term IN (SELECT subject FROM sj))"""
    held = "CASE category WHEN 'all' THEN true WHEN 'posts_composed' THEN source = 'posts_composed' WHEN 'posts' THEN list_contains(string_split(source, '+'), 'posts') ELSE list_contains(string_split(source, '+'), category) END"
    grown = "CASE WHEN rank % 5 = 0 THEN term || ' ' || term WHEN rank % 7 = 0 THEN '4 ' || term || ' 2' WHEN rank % 6 = 1 THEN term || ' medicare.com ' || term WHEN rank % 4 = 2 THEN term || ' x elephantine y' ELSE term END"
    reissued = core["keywords"] + f""", ra AS MATERIALIZED (SELECT doc_id, rank, {grown} AS term FROM k),
        rb AS MATERIALIZED (SELECT doc_id, CASE WHEN rank % 2 = 0 THEN rank + 4 ELSE rank - 1 END AS rank, term FROM ra WHERE rank % 3 <> 0)"""
    plain = "string_split(term, ' ')"
    kind = f"CASE WHEN len(list_distinct({plain})) < len({plain}) THEN 'repeat' WHEN len({plain}) >= 4 AND NOT list_has_any(string_split(lower(term), ' '), {_list(reports.HOLDS)}) THEN 'mechanical' END"
    # a first word that is repeated is said without a back reference
    made_up = "(" + " OR ".join(f"regexp_matches(lower(term), '{p}')" for p in reports.MECHANICAL[:3]) + " OR w[1] = w[2])"
    return _pages() | {
        "generic_unigrams": core["keywords"] + f", {counts} SELECT doc_id, rank, term FROM k LEFT JOIN zf ON zf.word = lower(trim(term)) WHERE NOT contains(trim(term), ' ') AND (list_contains({_list(cfg.stopwords)}, lower(trim(term))) OR coalesce(zipf >= 5.5, false))",
        "frequent_word_terms": frequent + " SELECT term, df FROM df",
        "subject_seeds": subject + " SELECT doc_id, term FROM fo",
        "subject_compositions": subject + f""", sd AS (SELECT doc_id, term, score, {_collapse('term')} AS seed, p_name AS phrase, string_split(p_name, ' ')[-1] AS token FROM fo JOIN part ON p_partkey = doc_id),
            mk AS (SELECT doc_id, term, score, unnest([phrase || ' ' || seed, token || ' ' || seed]) AS made FROM sd WHERE contains(seed, ' ') AND NOT contains(' ' || seed || ' ', ' ' || token || ' ') AND NOT starts_with(' ' || seed || ' ', ' ' || phrase || ' '))
            SELECT doc_id, made AS term, round(arg_min(score, term) * 0.9::DOUBLE * 1.1::DOUBLE, 6) AS score FROM mk GROUP BY ALL""",
        "community_inspection": mixed + """, ag AS (SELECT doc_id, string_agg(term, '|' ORDER BY rank) AS terms, avg(CASE WHEN list_contains(string_split(source, '+'), 'description') THEN 1.0::DOUBLE ELSE 0 END) AS description, avg(CASE WHEN list_contains(string_split(source, '+'), 'posts') THEN 1.0::DOUBLE ELSE 0 END) AS posts, avg(CASE WHEN source = 'posts_composed' THEN 1.0::DOUBLE ELSE 0 END) AS posts_composed FROM kc WHERE rank <= 10 GROUP BY 1),
            fd AS (SELECT doc_id, list(term) AS t FROM (SELECT doc_id, term FROM kc WHERE contains(source, 'description') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY rank) <= 4) GROUP BY 1),
            tp AS (SELECT conv_id AS doc_id, string_agg(text, '|' ORDER BY turn DESC) AS titles FROM (SELECT * FROM conversations QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) <= 3) GROUP BY 1)
            SELECT doc_id, terms, round(description, 6) AS description, round(posts, 6) AS posts, round(posts_composed, 6) AS posts_composed, array_to_string(list_sort(list_distinct(list_concat(['c', p_partkey::VARCHAR, 'x'], coalesce(flatten(list_transform(t, lambda x: string_split(x, ' '))), []::VARCHAR[])))), ' ') AS theme, md5(titles) AS titles
            FROM ag JOIN part ON p_partkey = doc_id LEFT JOIN fd USING (doc_id) LEFT JOIN tp USING (doc_id)""",
        "warehouse_loads": """WITH r AS (SELECT l_suppkey, l_partkey, min(l_orderkey) AS f, sum(l_quantity)::DOUBLE AS score FROM lineitem GROUP BY 1, 2),
            x AS (SELECT r.*, p_name, p_brand FROM r JOIN part ON p_partkey = l_partkey),
            e AS (SELECT l_suppkey, p_name AS term, score, 'one' AS source, 1 AS o, 1 AS version, row_number() OVER (PARTITION BY l_suppkey ORDER BY f, l_partkey) AS rank FROM x WHERE l_partkey % 3 < 2
              UNION ALL SELECT l_suppkey, p_brand, score, 'two', 2, 2, row_number() OVER (PARTITION BY l_suppkey ORDER BY f, l_partkey) FROM x WHERE l_partkey % 3 > 0
              UNION ALL SELECT l_suppkey, p_name, score, 'two', 3, 2, row_number() OVER (PARTITION BY l_suppkey ORDER BY f, l_partkey) FROM x WHERE l_partkey % 6 = 1)
            SELECT l_suppkey::VARCHAR AS community_id, term, CAST(rank AS INTEGER) AS rank, score, source, version::BIGINT AS version FROM e QUALIFY row_number() OVER (PARTITION BY l_suppkey, term ORDER BY o DESC, rank DESC) = 1""",
        "communities_frontpages": """WITH c AS (SELECT c_custkey AS doc_id, CASE WHEN c_custkey % 3 = 0 THEN 'c' || c_custkey WHEN c_custkey % 2 = 0 THEN 'other' || c_custkey ELSE 'c' || c_custkey END AS a, 'c' || c_custkey AS b FROM customer),
            f AS (SELECT DISTINCT unnest(['c' || (s_suppkey * 2), 'other' || (s_suppkey * 4)]) AS key FROM supplier)
            SELECT doc_id, CASE WHEN a IN (SELECT key FROM f) THEN a ELSE b END AS front_key FROM c WHERE a IN (SELECT key FROM f) OR b IN (SELECT key FROM f)""",
        "retention_by_source": mixed + f""", ca AS (SELECT unnest(['all', 'posts_composed', 'posts', 'description']) AS category UNION ALL SELECT 'name'), th AS (SELECT unnest([3.0, 6.0, 10.0])::DOUBLE AS threshold), dk AS (SELECT DISTINCT doc_id FROM kc),
            pr AS (SELECT doc_id, category, threshold, count(*) FILTER (WHERE {held}) AS n, count(*) FILTER (WHERE ({held}) AND score >= threshold) AS kept FROM kc, ca, th GROUP BY ALL)
            SELECT category, threshold, sum(kept)::BIGINT AS kept, round(sum(kept) / greatest(sum(n), 1), 6) AS share, round(avg(kept), 6) AS mean_kept, round(quantile_cont(kept, 0.5), 6) AS median_kept FROM pr GROUP BY 1, 2""",
        "source_effect": mixed + " SELECT source, count(*) AS n, round(avg(score), 6) AS mean, round(quantile_cont(score, 0.5), 6) AS median, round(stddev_pop(score), 6) AS stdev FROM kc GROUP BY 1 HAVING count(*) >= 100",
        "source_by_rank": mixed + ", c AS (SELECT rank, source, count(*) AS n FROM kc GROUP BY ALL) SELECT rank, source, round(n / every, 6) AS share FROM (SELECT *, sum(n) OVER (PARTITION BY rank) AS every FROM c) QUALIFY row_number() OVER (PARTITION BY rank ORDER BY n DESC, source) = 1",
        "issue_deltas": reissued + f""", xa AS (SELECT doc_id, rank, term, {kind} AS kind FROM ra WHERE rank <= 15), xb AS (SELECT doc_id, rank, term, {kind} AS kind FROM rb WHERE rank <= 15),
            ca AS (SELECT doc_id, count(*) AS n, count(kind) AS issues FROM xa GROUP BY 1), cb AS (SELECT doc_id, count(kind) AS issues FROM xb GROUP BY 1),
            go AS (SELECT doc_id, string_agg(kind || ': ' || term, '|' ORDER BY rank, term) AS filtered FROM xa WHERE kind IS NOT NULL AND NOT EXISTS (SELECT 1 FROM xb WHERE xb.doc_id = xa.doc_id AND xb.term = xa.term) GROUP BY 1),
            gg AS (SELECT doc_id, ca.issues AS issues_a, cb.issues AS issues_b, (ca.issues - cb.issues) / greatest(n, 1) AS gain, coalesce(filtered, '') AS filtered FROM ca JOIN cb USING (doc_id) LEFT JOIN go USING (doc_id))
            SELECT doc_id, issues_a, issues_b, round(gain, 6) AS gain, CASE WHEN gain > 0.1::DOUBLE THEN 'improvement' WHEN gain < -0.1::DOUBLE THEN 'degradation' ELSE 'no change' END AS verdict, filtered FROM gg""",
        "mechanical_demotions": reissued + f""", bt AS (SELECT ra.rank AS a, rb.rank AS b, term, string_split(lower(term), ' ') AS w FROM ra JOIN rb USING (doc_id, term)),
            md AS (SELECT * FROM bt WHERE {made_up} OR (len(w) >= 4 AND least(1, {_fragment()}) < 0.3))
            SELECT count(*) AS mechanical, count(*) FILTER (WHERE b > a) AS demoted, round(coalesce(count(*) FILTER (WHERE b > a) / nullif(count(*), 0), 0), 6) AS rate FROM md""",
        "keyword_flags": reissued + f""", fl AS (SELECT doc_id, rank, term, string_split(lower(term), ' ') AS w FROM ra WHERE rank <= 15),
            fg AS (SELECT doc_id, rank, term, list_filter([CASE WHEN regexp_matches(term, '{reports.FLAG_ADDRESS}') THEN 'address' END, CASE WHEN regexp_matches(term, '[^\x00-\x7F]') THEN 'foreign' END, CASE WHEN {holds('term', reports.FLAG_ADVERTS)} THEN 'advert' END,
              CASE WHEN len(w) >= 4 AND NOT {holds('term', reports.FLAG_CONNECTORS)} AND len(list_filter(range(1, len(w)), lambda i: contains(w[i], w[i + 1]) OR contains(w[i + 1], w[i]) OR abs(length(w[i]) - length(w[i + 1])) <= 2)) < len(w) * 0.3::DOUBLE THEN 'fragmented' END], lambda x: x IS NOT NULL) AS f FROM fl)
            SELECT doc_id, rank, term, array_to_string(f, '|') AS flags FROM fg WHERE len(f) > 0""",
        "tuning_advice": core["keywords"] + f""", tk AS MATERIALIZED (SELECT doc_id, rank, score, {grown} AS term FROM k), ts AS MATERIALIZED (SELECT *, length(term) % 2 = 0 AS made, string_split(lower(term), ' ') AS w FROM tk),
            mr AS (SELECT rank, count(*) AS n, avg(score) AS mean FROM ts GROUP BY 1), dr AS (SELECT rank, CASE WHEN n >= 10 THEN (lag(mean, 1) OVER o - mean) / lag(mean, 1) OVER o * 100 END AS fall FROM mr WINDOW o AS (ORDER BY rank)),
            mt AS (SELECT (SELECT avg(CASE WHEN n >= 20 THEN 1.0::DOUBLE ELSE 0 END) FROM (SELECT count(*) AS n FROM ts GROUP BY doc_id)) AS full_, (SELECT min(rank) FROM dr WHERE fall > 30) AS cliff,
              count(*) FILTER (WHERE {_repeats('term')}) AS repeating, count(*) FILTER (WHERE regexp_matches(term, '{reports.ADDRESS}')) AS addresses, count(*) FILTER (WHERE list_has_any(w, {_list(PROMOTION)})) AS promotional,
              count(*) FILTER (WHERE made AND NOT {holds('term', reports.ADVERTS)} AND (len(list_distinct(w)) < len(w) OR (len(w) > 3 AND len(list_filter(w, lambda x: length(x) > 2)) < len(w) * 0.6::DOUBLE))) AS low, count(*) FILTER (WHERE made AND {_mechanical('term')}) AS mechanical,
              quantile_cont(score, 0.5) AS p50, quantile_cont(score, 0.75) AS p75, quantile_cont(score, 0.95) AS p95 FROM ts)
            SELECT r.parameter AS parameter, r.advice AS advice, r.priority AS priority FROM (SELECT unnest(list_filter([
              CASE WHEN full_ > 0.8 THEN {{'parameter': 'topk', 'advice': 'increase to 30-40', 'priority': 'high'}} END, CASE WHEN full_ < 0.3 AND cliff IS NOT NULL THEN {{'parameter': 'topk', 'advice': 'reduce to ' || (cliff + 5), 'priority': 'medium'}} END,
              CASE WHEN p95 / p50 > 10 THEN {{'parameter': 'score_threshold', 'advice': 'filter below ' || printf('%.1f', p75), 'priority': 'medium'}} END, {{'parameter': 'source_weights', 'advice': 'increase name and description weights', 'priority': 'low'}},
              CASE WHEN repeating > 10 THEN {{'parameter': 'stopwords', 'advice': 'filter repeated words', 'priority': 'medium'}} END, CASE WHEN low > 5 THEN {{'parameter': 'composition', 'advice': 'raise the threshold or check coherence', 'priority': 'high'}} END,
              CASE WHEN addresses > 5 THEN {{'parameter': 'artefacts', 'advice': 'filter addresses', 'priority': 'medium'}} END, CASE WHEN promotional > 5 THEN {{'parameter': 'promotion', 'advice': 'filter adverts', 'priority': 'medium'}} END,
              CASE WHEN mechanical > 0 THEN {{'parameter': 'composition', 'advice': 'score coherence and filter fragments', 'priority': 'low'}} END], lambda x: x IS NOT NULL)) AS r FROM mt)""",
        "keyword_files": core["keywords"] + " SELECT doc_id::VARCHAR AS community_id, CAST(rank AS INTEGER) AS topk_rank, term, round(score / CASE WHEN sum(score) OVER o = 0 THEN 1 ELSE sum(score) OVER o END, 6) AS weight, score, source FROM k WHERE rank <= 10 WINDOW o AS (PARTITION BY doc_id)",
        "page_files": "SELECT CAST(c_nationkey + 1 AS INTEGER) AS page, CAST(c_custkey AS INTEGER) AS rank, c_custkey::VARCHAR AS community_id, 'r/' || c_name AS name, CASE WHEN c_custkey % 2 = 0 THEN '/r/' || c_custkey || '/' ELSE '' END AS url, CAST(floor(abs(c_acctbal)) AS BIGINT) AS subscribers_count, CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment ELSE '' END AS description, lower(c_name) AS key FROM customer",
        "frontpage_files": "SELECT 'sub=c' || conv_id AS key, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS INTEGER) AS post, md5(text) AS digest, turn * 3::BIGINT AS score, CASE WHEN turn % 2 = 0 THEN round(turn * 0.5::DOUBLE, 6) END AS age_days, role = 'system' AS is_promoted, role AS preview FROM conversations",
        "phrase_files": "WITH l AS (SELECT lower(p_name) AS a, replace(lower(p_brand), '#', '-') AS b FROM part) SELECT DISTINCT unnest(list_concat(string_split(a, ' '), [b])) AS word, 'word' AS kind FROM l UNION ALL SELECT DISTINCT unnest([a, b]), 'phrase' FROM l",
        "page_run_counters": "WITH p AS (SELECT CAST(o_custkey AS INTEGER) AS page, max(CASE WHEN o_orderkey % 50 = 0 THEN 1 ELSE 0 END) AS bad, count(*) AS n FROM orders GROUP BY 1) SELECT count(*) AS pages, count(*) FILTER (WHERE bad = 1) AS failed, sum(n)::BIGINT AS communities, min(page) AS first_page, max(page) AS last_page, count(*) FILTER (WHERE bad = 0 AND n = 0) AS empty FROM p",
        "output_states": """SELECT s_suppkey AS n, CASE WHEN s_suppkey % 3 = 0 THEN 10 ELSE strlen('{"name": "' || s_name || '"}') + 1 END::BIGINT AS length, CASE WHEN s_suppkey % 3 = 0 THEN 'broken' ELSE 'valid' END AS state FROM supplier""",
        "cached_frequencies": core["desc"] + " SELECT term, df FROM df",
        "segmented_words": GLUED + " SELECT word, array_to_string(parts, ' ') AS parts FROM sg",
        "glued_name_keywords": GLUED + ", nn AS (SELECT doc_id, parts FROM gl JOIN sg ON sg.word = gl.name), " + _names("nn", stop),
        "name_keywords": "WITH nn AS (SELECT p_partkey AS doc_id, string_split(p_name, ' ') AS parts FROM part), " + _names("nn", stop),
        "context_mismatches": placed + " " + mismatch,
        "brand_misuse": placed + " " + misuse,
        "fragmented_compositions": placed + f""", fr AS (SELECT doc_id, rank, term, list_filter([{fields}], lambda x: x IS NOT NULL) AS f FROM cx WHERE rank <= 20 AND contains(source, 'composed') AND len({words}) >= 4 AND NOT list_has_any(list_filter(regexp_split_to_array(lower(term), '\\s+'), lambda w: w <> ''), {_list(wordlists.HOLDING)}))
            SELECT doc_id, rank, term, array_to_string(f, ' ') AS fields FROM fr WHERE len(f) > 2""",
        "redundancy_groups": varied + ", " + _grouped("spacing", "vk", 15, "s") + ", " + _grouped("overlap", "vk", 15, "o") + ", " + _grouped("prefix", "vk", 15, "p") + " " + union,
        "best_variants": varied + ", " + _grouped("variant", "vk", 30, "v") + f""", ow AS (SELECT p_partkey AS doc_id, regexp_replace(lower(p_name), '[^0-9a-z]+', '', 'g') AS own FROM part),
            vs AS ({variant}), bs AS (SELECT *, count(*) OVER (PARTITION BY doc_id, lead) AS variants, row_number() OVER (PARTITION BY doc_id, lead ORDER BY v DESC, rank, term) AS r FROM vs)
            SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, rank, term) AS INTEGER) AS rank, term, score, source, variants FROM bs WHERE r = 1""",
        "repeated_compositions": varied + """, cp AS (SELECT doc_id, list(term ORDER BY rank, term) AS t FROM vk WHERE rank <= 10 AND contains(source, 'composed') GROUP BY 1 HAVING count(*) >= 3),
            fo AS (SELECT doc_id, t, 0::BIGINT AS i, []::VARCHAR[] AS seen, 0::BIGINT AS place FROM cp
              UNION ALL SELECT doc_id, t, i + 1, list_distinct(list_concat(seen, string_split(lower(t[i + 1]), ' '))), CASE WHEN place = 0 AND len(list_intersect(seen, list_distinct(string_split(lower(t[i + 1]), ' ')))) >= 2 THEN i + 1 ELSE place END FROM fo WHERE i < len(t))
            SELECT doc_id, array_to_string(t[1:3], '|') AS terms, CAST(place AS INTEGER) AS place FROM fo WHERE i = len(t) AND place > 0""",
    }
