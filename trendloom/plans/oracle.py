"""SQL over the same input tables that gives the result of each query, for an independent engine.

The common table expressions below restate the sample adapters; every query names those it needs.
"""

from __future__ import annotations

import re

from trendloom.functions import lexicon_rules as rules
from trendloom.functions.text import ENGLISH_STOP_WORDS


def _words(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


AS_OF = "TIMESTAMP '2024-03-01 00:00:00'"
STAMP = "'%Y-%m-%d %H:%M:%S'"


def _two(value: str, digits: int = 2) -> str:
    """Round half up on the shortest decimal form of a double, as Spark does."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), {digits}) AS DOUBLE)"


CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "articles": ((), """
        SELECT doc_id AS title_id, source AS source_id, split_part(text, chr(10), 1) AS title,
               'doc/' || doc_id AS link, text AS summary,
               TIMESTAMP '2024-01-01 00:00:00' + to_hours(doc_id) AS date_captured
        FROM documents"""),
    "topics": (("articles",), "SELECT *, title_id % 50 AS cluster_id FROM articles"),
    "members": (("topics",), """
        SELECT title_id, min(title_id) OVER (PARTITION BY cluster_id) AS anchor_id FROM topics"""),
    "clusters": (("topics",), f"""
        SELECT cluster_id, arg_min(title, title_id) AS main_title, min(title_id) AS title_id,
               CAST(count(*) AS DOUBLE) AS volume,
               CASE WHEN cluster_id % 2 = 0 THEN (cluster_id * 37 % 200 - 100) / 100.0 END AS score,
               CASE WHEN cluster_id % 10 = 4 THEN 'unknown' WHEN cluster_id % 10 <> 8
                    THEN strftime(TIMESTAMP '2024-02-01 00:00:00' + to_hours(cluster_id), {STAMP}) END AS last_updated
        FROM topics GROUP BY cluster_id"""),
    "history": (("clusters",), f"""
        SELECT cluster_id, CAST(score AS DOUBLE) AS score,
               coalesce(try_strptime(last_updated, {STAMP}), {AS_OF}) AS last_evaluated_at
        FROM clusters WHERE score IS NOT NULL AND last_updated IS NOT NULL"""),
    "stored_clusters": (("clusters",), f"""
        SELECT * REPLACE (coalesce(try_strptime(last_updated, {STAMP}), {AS_OF}) AS last_updated) FROM clusters"""),
    "records": (("articles",), """
        SELECT source_id AS site, title_id AS ingest_seq, CASE WHEN title_id % 17 <> 0 THEN title END AS headline,
               CASE WHEN title_id % 13 <> 0 THEN link END AS link, summary, 'Captured' AS date
        FROM articles"""),
    "norms": (("records",), r"""
        SELECT *, regexp_replace(regexp_replace(lower(coalesce(headline, 'None')), '[^\p{L}\p{N}_\s\p{Z}]', '', 'g'),
                                 '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS norm
        FROM records"""),
    "firsts": (("norms",), """
        SELECT * FROM norms QUALIFY row_number() OVER (PARTITION BY site, norm ORDER BY ingest_seq) = 1"""),
    "sources": ((), """
        SELECT *, number % 2 = 0 AS is_json FROM (
            SELECT source AS site_name, count(*) AS n, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INT) AS number,
                   'https://news.example/' || source || '/page-{}' AS url_template,
                   CAST(count(*) % 13 AS INT) AS pages
            FROM documents GROUP BY source)"""),
    "landed": ((), r"""
        SELECT regexp_extract(url, '^https?://([^/]+)', 1) AS site, CAST(page_id AS INT) AS page_num, html, url
        FROM pages"""),
    "script_pages": (("landed",), """
        SELECT site, page_num, '<script type="application/ld+json">' || '{"@type":"'
               || CASE WHEN page_num % 7 = 0 THEN 'Thing' ELSE 'ItemList' END
               || '","itemListElement":[{"name":"Lead story ' || page_num || '","url":"' || url
               || '","description":"first of page ' || page_num || '"},{"name":null,"url":"' || url || '"},'
               || CASE WHEN page_num % 4 = 0 THEN '7,' ELSE '' END
               || '{"name":"Late story ' || page_num || '","description":"last"}]'
               || CASE WHEN page_num % 11 = 0 THEN '' ELSE '}' END || '</script>' || html AS html
        FROM landed"""),
    "json_records": (("script_pages",), r"""
        SELECT site, page_num, CAST(p - 1 AS INT) AS pos, json_extract_string(e, '$.name') AS headline,
               json_extract_string(e, '$.url') AS link, json_extract_string(e, '$.description') AS summary,
               'Captured' AS date
        FROM (SELECT site, page_num, unnest(elements) AS e, generate_subscripts(elements, 1) AS p,
                     list_position(list_transform(elements, lambda x: json_type(x) = 'OBJECT'), false) AS broken
              FROM (SELECT site, page_num, CAST(json_extract(body, '$.itemListElement') AS JSON[]) AS elements
                    FROM (SELECT site, page_num, unnest(regexp_extract_all(html,
                              '(?s)<script type="application/ld\+json">(.*?)</script>', 1)) AS body
                          FROM script_pages)
                    WHERE json_valid(body) AND json_extract_string(body, '$."@type"') = 'ItemList'))
        WHERE broken IS NULL OR broken = 0 OR p < broken"""),
    "dom_records": (("landed",), """
        SELECT site, page_num, CAST(p - 1 AS INT) AS pos, regexp_extract(block, '>([^<]*)</a>', 1) AS headline,
               regexp_extract(block, 'href="([^"]*)"', 1) AS link, CAST(NULL AS VARCHAR) AS summary,
               'Captured' AS date
        FROM (SELECT site, page_num, unnest(blocks) AS block, generate_subscripts(blocks, 1) AS p
              FROM (SELECT site, page_num,
                           regexp_extract_all(html, '<li><a href="[^"]*">[^<]*</a></li>') AS blocks FROM landed))"""),
    "attempts": (("landed",), """
        SELECT site, page_num, tier, CASE WHEN tier = 1 AND page_num % 3 = 0 THEN NULL
                    WHEN tier = 1 AND page_num % 5 = 0 THEN '' WHEN tier = 2 AND page_num % 6 = 0 THEN ''
                    WHEN tier = 3 AND page_num % 12 = 0 THEN '<h1>Access Denied</h1>' || html
                    ELSE html || '<!-- tier ' || tier || ' -->' END AS html
        FROM landed, (VALUES (1), (2), (3)) AS t(tier)"""),
    "ticks": ((), """
        SELECT event_id, event_type AS symbol, value AS current,
               value * (64 + event_id % 64) / 64.0 AS prev_close
        FROM events"""),
    "prices": ((), """
        SELECT event_id, event_type || '_' || (user_id % 7) AS coin, value * 1000 AS usd,
               CASE WHEN event_id % 9 <> 0 THEN (event_id % 2001 - 1000) / 64.0 END AS usd_24h_change
        FROM events"""),
    "stored_articles": (("articles",), """
        SELECT *, CAST(NULL AS BIGINT) AS cluster_id FROM articles WHERE title_id % 3 = 0
        QUALIFY row_number() OVER (PARTITION BY title ORDER BY title_id) = 1"""),
    # ------------------------------------------------------------ vectors
    "terms": (("articles",), rf"""
        SELECT title_id, term, count(*) AS n
        FROM (SELECT title_id, unnest(regexp_extract_all(lower(title || ' ' || summary), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term
              FROM articles)
        WHERE term NOT IN ({_words(ENGLISH_STOP_WORDS)})
        GROUP BY ALL"""),
    "frequencies": (("terms",), "SELECT term, count(*) AS df FROM terms GROUP BY term"),
    "raws": (("terms", "frequencies"), """
        SELECT title_id, term, n,
               n * (ln((1.0 + (SELECT count(*) FROM documents)) / (1.0 + df)) + 1.0) AS raw
        FROM terms JOIN frequencies USING (term)"""),
    "weights": (("raws",), """
        SELECT title_id, term, raw / sqrt(sum(raw * raw) OVER (PARTITION BY title_id)) AS weight FROM raws"""),
    "signatures": (("terms",), """
        SELECT title_id, md5(string_agg(term || ':' || share, ',' ORDER BY term)) AS sig
        FROM (SELECT title_id, term, n // gcd AS share
              FROM terms JOIN (SELECT title_id, list_reduce(list(n), lambda a, b: gcd(a, b)) AS gcd FROM terms GROUP BY title_id)
                   USING (title_id))
        GROUP BY title_id"""),
    "cosines": (("weights", "signatures"), """
        SELECT i, j, CASE WHEN si.sig = sj.sig THEN 1.0 ELSE least(dot, 0.999999) END AS cosine
        FROM (SELECT a.title_id AS i, b.title_id AS j, round(sum(a.weight * b.weight), 6) AS dot
              FROM weights a JOIN weights b
                   ON a.term = b.term AND b.title_id < a.title_id AND a.title_id - b.title_id <= 144
              GROUP BY a.title_id, b.title_id)
        JOIN signatures si ON si.title_id = i JOIN signatures sj ON sj.title_id = j
        WHERE (CASE WHEN si.sig = sj.sig THEN 1.0 ELSE least(dot, 0.999999) END) > 0.15"""),
    "anchored": (("articles", "members"), """
        SELECT a.title_id, a.title, a.date_captured AS published_at, m.anchor_id, h.title AS main_title,
               h.date_captured AS anchor_time
        FROM articles a JOIN members m USING (title_id) JOIN articles h ON h.title_id = m.anchor_id"""),
    "folded": (("anchored",), r"""
        SELECT * REPLACE (regexp_replace(title, '[^\x00-\x7F]', '?', 'g') AS title,
                          regexp_replace(main_title, '[^\x00-\x7F]', '?', 'g') AS main_title) FROM anchored"""),
    "word_sets": (("folded",), r"""
        SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(title), '[\s\p{Z}]+'), lambda x: x <> '')) AS a,
               list_distinct(list_filter(regexp_split_to_array(lower(main_title), '[\s\p{Z}]+'), lambda x: x <> '')) AS b
        FROM folded"""),
    "measured": (("word_sets",), f"""
        SELECT anchor_id, main_title, title_id, title AS headline_text, published_at,
               {_two('''CASE WHEN greatest(length(title), length(main_title)) = 0 THEN 1.0
                        ELSE (greatest(length(title), length(main_title)) - levenshtein(lower(title), lower(main_title)))
                             / greatest(length(title), length(main_title)) END''')} AS levenshtein_similarity,
               {_two('''CASE WHEN len(list_distinct(a || b)) = 0 THEN 0.0
                        ELSE len(list_intersect(a, b)) / len(list_distinct(a || b)) END''')} AS jaccard_similarity
        FROM word_sets"""),
    "averages": (("measured",), f"""
        SELECT anchor_id, any_value(main_title) AS main_title,
               {_two('sum(CAST(round(levenshtein_similarity * 100) AS BIGINT)) / (count(*) * 100)')} AS avg_levenshtein,
               {_two('sum(CAST(round(jaccard_similarity * 100) AS BIGINT)) / (count(*) * 100)')} AS avg_jaccard,
               CAST(count(*) AS DOUBLE) AS volume, max(published_at) AS latest_update_time
        FROM measured GROUP BY anchor_id"""),
    # ------------------------------------------------------------ sentiment
    "lexicon": ((), r"""
        SELECT token, rule % 41 / 10.0 - 2.0 AS valence
        FROM (SELECT DISTINCT token, length(token) * 7 + ascii(substring(token, 1, 1)) AS rule
              FROM (SELECT unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')) AS token FROM benchmark))
        WHERE rule % 3 = 0 AND length(token) > 2"""),
    "word_lists": (("articles",), rf"""
        SELECT title_id, summary AS text, list_transform(
                   list_filter(regexp_split_to_array(summary, '[\s\p{{Z}}]+'), lambda x: length(x) > 1),
                   lambda x: regexp_replace(x,
                       '^(?:\!\?\?\!|\!\?\!|\?\!\?\!|\!\?\!\?|\?\!\?|\!\!\!|\?\?\?|\!\!|\?\?|[.!?,;:"''-])([^!-/:-@\[-`{{-~]{{2,}})$|^([^!-/:-@\[-`{{-~]{{2,}})(?:\!\?\!\?|\?\!\?\!|\!\?\!|\?\!\?|\!\!\!|\?\?\?|\!\!|\?\?|[.!?,;:"''-])$',
                       '\1\2')) AS w
        FROM articles"""),
    "text_facts": (("word_lists",), """
        SELECT title_id, coalesce(list_position(list_transform(w, lambda x: lower(x)), 'but'), 0) AS but_at,
               len(list_filter(w, lambda x: upper(x) = x AND lower(x) <> x)) AS uppers, len(w) AS size
        FROM word_lists"""),
    "word_rows": (("text_places",), """
        SELECT o.title_id, o.i, o.word, f.p1, f.p2, f.p3, o.but_at, o.cap_diff
        FROM (SELECT *, min(i) OVER (PARTITION BY title_id, word) AS first_i FROM text_places) o
        JOIN text_places f ON f.title_id = o.title_id AND f.i = o.first_i"""),
    "text_places": (("text_facts",), """
        SELECT title_id, i, word, lag(word, 1) OVER place AS p1, lag(word, 2) OVER place AS p2,
               lag(word, 3) OVER place AS p3, but_at, uppers > 0 AND uppers < size AS cap_diff
        FROM (SELECT title_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM word_lists)
        JOIN text_facts USING (title_id)
        WINDOW place AS (PARTITION BY title_id ORDER BY i)"""),
    "hits": (("word_rows", "lexicon"), f"""
        SELECT r.*, l.valence + CASE WHEN cap_diff AND upper(word) = word AND lower(word) <> word
                                     THEN 0.733 * sign(l.valence - 1e-12) ELSE 0 END AS v0
        FROM word_rows r JOIN lexicon l ON l.token = lower(r.word)
        WHERE lower(word) NOT IN ({_words(rules.INTENSIFIERS + rules.DAMPENERS)})"""),
}


def _step(distance: int, weight: float) -> str:
    """Effect of the word ``distance`` before a sentiment word: degree, then negation."""
    v, p = f"v{distance - 1}", f"p{distance}"
    up = f"lower({p}) IN ({_words(rules.INTENSIFIERS)})"
    down = f"lower({p}) IN ({_words(rules.DAMPENERS)})"
    capital = f"CASE WHEN cap_diff AND upper({p}) = {p} AND lower({p}) <> {p} THEN CASE WHEN {v} > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END"
    boost = f"""CASE WHEN {up} THEN {weight} * (CASE WHEN {v} < 0 THEN -0.293 ELSE 0.293 END + {capital})
                     WHEN {down} THEN {weight} * (CASE WHEN {v} < 0 THEN 0.293 ELSE -0.293 END + {capital}) ELSE 0 END"""
    never = ""
    if distance == 2:
        never = "WHEN p2 = 'never' AND p1 IN ('so', 'this') THEN 1.5"
    if distance == 3:
        never = "WHEN p3 = 'never' AND p2 IN ('so', 'this') OR p1 IN ('so', 'this') THEN 1.25"
    negated = f"lower({p}) IN ({_words(rules.NEGATIONS)}) OR contains(lower({p}), 'n''t')"
    return f"""SELECT *, CASE WHEN {p} IS NULL OR lower({p}) IN (SELECT token FROM lexicon) THEN {v}
                     ELSE ({v} + {boost}) * CASE {never} WHEN {negated} THEN -0.74 ELSE 1 END END AS v{distance}
               FROM {'hits' if distance == 1 else f'step{distance - 1}'}"""


CTES["step1"] = (("hits",), _step(1, 1.0))
CTES["step2"] = (("step1",), _step(2, 0.95))
CTES["step3"] = (("step2",), _step(3, 0.9))
CTES["sums"] = (("step3", "word_lists"), """
        SELECT title_id, coalesce(any_value(s), 0) AS s, any_value(emphasis) AS emphasis
        FROM (SELECT title_id, least(length(text) - length(replace(text, '!', '')), 4) * 0.292
                     + CASE WHEN length(text) - length(replace(text, '?', '')) > 3 THEN 0.96
                            WHEN length(text) - length(replace(text, '?', '')) > 1
                            THEN (length(text) - length(replace(text, '?', ''))) * 0.18 ELSE 0 END AS emphasis
              FROM word_lists)
        LEFT JOIN (SELECT title_id, sum(
                              CASE WHEN lower(p1) = 'least' AND lower(p1) NOT IN (SELECT token FROM lexicon)
                                        AND coalesce(lower(p2) NOT IN ('at', 'very'), true) THEN v3 * -0.74 ELSE v3 END
                              * CASE WHEN but_at = 0 OR i = but_at THEN 1 WHEN i < but_at THEN 0.5 ELSE 1.5 END) AS s
                   FROM step3 GROUP BY title_id) USING (title_id)
        GROUP BY title_id""")
CTES["compounds"] = (("sums",), f"""
        SELECT title_id, {_two('greatest(-1.0, least(1.0, t / sqrt(t * t + 15.0)))', 4)} AS compound
        FROM (SELECT title_id, s + CASE WHEN s > 0 THEN emphasis WHEN s < 0 THEN -emphasis ELSE 0 END AS t FROM sums)""")
CTES["measures"] = (("topics", "compounds"), """
        SELECT cluster_id, count(*) AS volume, 1.0::DOUBLE AS avg_jaccard,
               sum(CAST(round(compound * 10000) AS BIGINT)) / (count(*) * 10000) AS avg_sentiment
        FROM topics JOIN compounds USING (title_id) GROUP BY cluster_id""")
CTES["actions"] = (("measures", "history"), f"""
        SELECT cluster_id, CASE WHEN abs(final) < 0.001 THEN 0.0 ELSE {_two('final', 4)} END AS calculated_score,
               {_two('avg_sentiment', 4)} AS avg_sentiment, avg_jaccard, {AS_OF} AS evaluated_at,
               CASE WHEN abs(final) < 0.001 THEN 'DELETE' ELSE 'UPSERT' END AS action
        FROM (SELECT m.*, greatest(-1.0, least(1.0, coalesce(score * pow(0.666667,
                         epoch({AS_OF} - last_evaluated_at) / 86400.0), 0.0)
                         + avg_sentiment * (volume / (volume + 2.0)) * avg_jaccard)) AS final
              FROM measures m LEFT JOIN history USING (cluster_id))""")
CTES["set_actions"] = (("topics",), f"""
        SELECT DISTINCT cluster_id * 2 % 70 AS cluster_id,
               CASE WHEN cluster_id * 2 % 70 % 6 = 0 THEN 0.0 ELSE cluster_id * 2 % 70 / 100.0 END AS calculated_score,
               cluster_id * 2 % 70 / 200.0 AS avg_sentiment, 1.0::DOUBLE AS avg_jaccard, {AS_OF} AS evaluated_at,
               CASE WHEN cluster_id * 2 % 70 % 6 = 0 THEN 'DELETE' ELSE 'UPSERT' END AS action
        FROM topics""")
CTES["appended"] = (("anchored", "clusters"), r"""
        SELECT (SELECT max(cluster_id) FROM clusters) + row_number() OVER (ORDER BY anchor_id) AS cluster_id, anchor_id
        FROM (SELECT DISTINCT anchor_id FROM anchored)""")


def _with(names: tuple[str, ...], body: str) -> str:
    """Put the named expressions and all they need before ``body``."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name not in ordered:
            for needed in CTES[name][0]:
                visit(needed)
            ordered.append(name)

    for name in names:
        visit(name)
    if not ordered:
        return body
    return "WITH RECURSIVE " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n" + body


ORACLE_SQL: dict[str, str] = {}


def _add(name: str, body: str, *needs: str) -> None:
    ORACLE_SQL[name] = _with(needs, body)


_add("s1_source_configs", """
    SELECT site_name, url_template, pages, CASE WHEN is_json THEN 'json_script' ELSE 'html_dom' END AS strategy,
           CASE WHEN NOT is_json AND number % 5 <> 0 THEN 'parent' END AS anchor_position,
           CASE WHEN is_json THEN 'name' END AS headline_key, CASE WHEN is_json THEN 'url' END AS link_key,
           CAST(CASE WHEN is_json THEN 7 ELSE 6 + CAST(number % 3 = 0 AS INT) + CAST(number % 5 <> 0 AS INT) END AS INT)
               AS set_fields,
           CAST(NULL AS VARCHAR) AS reject_reason
    FROM sources""", "sources")
_add("s2_url_frontier", """
    SELECT site_name AS site, CAST(p AS INT) AS page_num, replace(url_template, '{}', CAST(p AS VARCHAR)) AS url
    FROM (SELECT site_name, url_template, unnest(range(1, pages + 1)) AS p FROM sources)""", "sources")
_add("s3_captured_pages", """
    SELECT site, page_num, CAST(length(html) AS INT) AS chars, md5(html) AS digest FROM landed""", "landed")
_add("s4_attempt_resolution", """
    SELECT site, page_num, tier, md5(html) AS digest FROM attempts
    WHERE coalesce(html, '') <> '' AND NOT (tier = 3 AND contains(html, 'Access Denied'))
    QUALIFY row_number() OVER (PARTITION BY site, page_num ORDER BY tier) = 1""", "attempts")
_add("s5_articles_full", f"""
    SELECT title_id, title, coalesce(summary, '') AS summary, strftime(date_captured, {STAMP}) AS published_at
    FROM articles""", "articles")
_add("s6_articles_unassigned", f"""
    SELECT title_id, title, coalesce(summary, '') AS summary, strftime(date_captured, {STAMP}) AS published_at
    FROM articles WHERE title_id % 4 = 0""", "articles")
_add("s7_history", f"""
    SELECT cluster_id, score, strftime(last_evaluated_at, {STAMP}) AS last_evaluated_at FROM history""", "history")
_add("s8_price_scan", "SELECT event_id, coin, usd, usd_24h_change FROM prices", "prices")
_add("s9_ticker_scan", "SELECT event_id AS seq, symbol, current, prev_close FROM ticks", "ticks")
_add("x1_json_script", "SELECT * FROM json_records", "json_records")
_add("x2_html_dom", "SELECT * FROM dom_records", "dom_records")
_add("x3_anchor_position", """
    SELECT site, page_num, 0 AS pos, 'Bigstory' || page_num || 'more' AS headline,
           CASE mode WHEN 'parent' THEN '/around/' ELSE '/inside/' END || page_num AS link,
           'Sumof' || page_num AS summary, 'Captured' AS date, mode
    FROM landed, (VALUES ('child'), ('parent'), ('default')) AS t(mode)""", "landed")
_add("x4_strategy_routing", """
    SELECT * FROM json_records WHERE length(site) % 3 = 0
    UNION ALL SELECT * FROM dom_records WHERE length(site) % 3 = 1""", "json_records", "dom_records")
ORACLE_SQL["x5_zero_yield_fallback"] = ORACLE_SQL["x4_strategy_routing"]
_add("c1_normalised_headline", "SELECT ingest_seq, norm FROM norms", "norms")
_add("c2_first_headlines", "SELECT site, norm, ingest_seq, link FROM firsts", "firsts")
_add("c2_first_headlines_all_sites", """
    SELECT site, norm, ingest_seq, link FROM norms
    QUALIFY row_number() OVER (PARTITION BY norm ORDER BY ingest_seq) = 1""", "norms")
_add("c3_dedup_counts", """
    SELECT site, count(*) AS before, count(DISTINCT norm) AS after, count(*) - count(DISTINCT norm) AS removed
    FROM norms GROUP BY site""", "norms")
_add("c4_drop_incomplete", """
    SELECT site, ingest_seq, headline, link, summary, date FROM firsts
    WHERE headline IS NOT NULL AND link IS NOT NULL""", "firsts")
_add("c5_keyword_search", "SELECT source_id, title FROM articles WHERE title ILIKE '%then%'", "articles")
_add("c6_keyword_preview", """
    SELECT source_id, title FROM articles WHERE title ILIKE '%then%'
    ORDER BY date_captured DESC, title_id LIMIT 5""", "articles")
_add("c7_headline_noise", r"""
    SELECT title_id, regexp_replace(CASE WHEN title_id % 5 = 3 THEN '' ELSE title END,
                                    '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g') AS stripped
    FROM articles""", "articles")
_add("k1_config_upsert", """
    SELECT site_name, url_template, CASE WHEN is_json THEN pages + 2 ELSE pages END AS pages,
           CASE WHEN is_json THEN 'json_script' ELSE 'html_dom' END AS strategy,
           CASE WHEN is_json THEN '{"headline":"title2"}' END AS mapping,
           CAST(NULL AS VARCHAR) AS script_type, CASE WHEN NOT is_json THEN 'li' END AS container_tag,
           CASE WHEN is_json THEN 'en' END AS edition
    FROM sources""", "sources")
_add("k2_insert_articles", f"""
    SELECT title_id, source_id, title, link, strftime(date_captured, {STAMP}) AS date_captured, cluster_id
    FROM stored_articles
    UNION ALL
    SELECT (SELECT max(title_id) FROM stored_articles) + row_number() OVER (ORDER BY site, ingest_seq),
           site, headline, link, strftime({AS_OF}, {STAMP}), NULL
    FROM (SELECT * FROM records WHERE headline IS NOT NULL AND site IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY headline ORDER BY site, ingest_seq) = 1)
    WHERE headline NOT IN (SELECT title FROM stored_articles)""", "stored_articles", "records")
_add("l1_combined_text", """
    SELECT title_id, title || ' ' || CASE WHEN title_id % 5 <> 0 THEN summary ELSE '' END AS text
    FROM articles""", "articles")
_add("l2_tfidf", "SELECT title_id, term, round(weight, 6) AS weight FROM weights", "weights")
_add("l3_pair_cosine", """
    SELECT i AS title_id, count(*) AS matches, max(cosine) AS best_cosine,
           arg_min(j, struct_pack(c := -cosine, j := j)) AS best_id
    FROM cosines WHERE i - j <= 72 GROUP BY i""", "cosines")
_add("l4_time_gate", """
    SELECT title_id, anchor_id, epoch(published_at - anchor_time) / 3600.0 AS hours,
           published_at - anchor_time <= INTERVAL 72 HOUR AS inside
    FROM anchored""", "anchored")
_add("l5_best_match", """
    SELECT i AS title_id, max(cosine) AS cosine, arg_min(anchor_id, struct_pack(c := -cosine, a := anchor_id)) AS anchor_id
    FROM cosines JOIN members ON members.title_id = j WHERE i - anchor_id <= 72 GROUP BY i""", "cosines", "members")
# One step per article: the label of the best earlier article in reach, if the titles share anything.
CTES["all_cosines"] = (("cosines",), "SELECT * FROM cosines")
_LABELLED = """, labelled(i, label) USING KEY (i) AS (
        SELECT min(title_id), min(title_id) FROM articles
        UNION
        SELECT next.i, CASE WHEN levenshtein(lower(a.title), lower(h.title))
                                 < greatest(strlen(lower(a.title)), strlen(lower(h.title)))
                                 OR (a.title = '' AND h.title = '') THEN next.label ELSE next.i END
        FROM (SELECT n.i, arg_min(l.label, struct_pack(c := -c.cosine, l := l.label))
                              FILTER (l.label IS NOT NULL) AS label
              FROM (SELECT i + 1 AS i FROM labelled WHERE i < (SELECT max(doc_id) FROM documents)) n
              LEFT JOIN all_cosines c ON c.i = n.i
              LEFT JOIN recurring.labelled l ON l.i = c.j AND n.i - l.label <= 72
              GROUP BY n.i) next
        JOIN articles a ON a.title_id = next.i LEFT JOIN articles h ON h.title_id = next.label)
    """


def _with_labels(body: str, *needs: str) -> str:
    before = _with(("articles", "all_cosines", *needs), "").rstrip()
    return before.replace("all_cosines AS (", "all_cosines AS MATERIALIZED (") + _LABELLED + body


ORACLE_SQL["l6_greedy_clusters"] = _with_labels("SELECT i AS title_id, label AS anchor_id FROM labelled")


def _half_topics(late: bool) -> str:
    """Topics of the lower or upper half of the documents, with their energy."""
    body = _with_labels(f"""
        SELECT title_id, title AS main_title, 1.0::DOUBLE AS avg_jaccard, CAST(volume AS DOUBLE) AS volume, energy,
               {_two('avg_sentiment', 4)} AS avg_sentiment
        FROM (SELECT label, volume, avg_sentiment, avg_sentiment * (volume / (volume + 2.0)) AS energy
              FROM (SELECT label, count(*) AS volume,
                           sum(CAST(round(compound * 10000) AS BIGINT)) / (count(*) * 10000) AS avg_sentiment
                    FROM labelled JOIN compounds ON compounds.title_id = i GROUP BY label))
        JOIN articles ON articles.title_id = label""", "compounds")
    half = f"(SELECT * FROM documents WHERE (doc_id > (SELECT max(doc_id) // 2 FROM documents)) = {late})"
    return re.sub(r"\bFROM documents\b", f"FROM {half}", body)


ORACLE_SQL["t3_topic_stream"] = f"""
    SELECT title_id, main_title, avg_jaccard, volume, avg_sentiment, {_two('final', 4)} AS score,
           strftime({AS_OF}, {STAMP}) AS last_updated
    FROM (SELECT * EXCLUDE (energy), greatest(-1.0, least(1.0, {_two('energy', 4)} + energy)) AS final
          FROM ({_half_topics(False)}) WHERE abs(energy) >= 0.001
          UNION ALL
          SELECT * EXCLUDE (energy), energy AS final FROM ({_half_topics(True)}))
    WHERE abs(final) >= 0.001"""
_add("l7_levenshtein", f"""
    SELECT title_id, anchor_id, {_two('''CASE WHEN greatest(length(title), length(main_title)) = 0 THEN 1.0
        ELSE (greatest(length(title), length(main_title)) - levenshtein(lower(title), lower(main_title)))
             / greatest(length(title), length(main_title)) END''', 4)} AS similarity
    FROM folded""", "folded")
_add("l8_jaccard", rf"""
    SELECT title_id, anchor_id, {_two('''CASE WHEN len(list_distinct(a || b)) = 0 THEN 0.0
        ELSE len(list_intersect(a, b)) / len(list_distinct(a || b)) END''', 4)} AS similarity
    FROM (SELECT *, list_distinct(list_filter(regexp_split_to_array(lower(title), '[\s\p{{Z}}]+'), lambda x: x <> '')) AS a,
                 list_distinct(list_filter(regexp_split_to_array(lower(main_title), '[\s\p{{Z}}]+'), lambda x: x <> '')) AS b
          FROM anchored)""", "anchored")
_add("l9_anchor_lookup", "SELECT title_id, title, anchor_id, main_title FROM anchored", "anchored")
_add("l10_history_lookup", f"""
    SELECT cluster_id, volume, score, strftime(last_evaluated_at, {STAMP}) AS last_evaluated_at,
           CASE WHEN score IS NULL THEN 'fresh' ELSE 'compound' END AS mode
    FROM (SELECT cluster_id, count(*) AS volume FROM topics GROUP BY cluster_id)
    LEFT JOIN history USING (cluster_id)""", "topics", "history")
_add("l11_missing_pages", """
    SELECT DISTINCT site, page_num + 1 AS page_num FROM landed l
    WHERE NOT EXISTS (SELECT 1 FROM landed c WHERE c.site = l.site AND c.page_num = l.page_num + 1)""", "landed")
_add("a1_cluster_report", f"""
    SELECT anchor_id AS cluster_anchor_db_id, main_title AS cluster_master,
           count(*) OVER (PARTITION BY anchor_id) AS volume_count,
           strftime(max(published_at) OVER (PARTITION BY anchor_id), {STAMP}) AS latest_update_time,
           title_id // 1024 AS part,
           CAST(row_number() OVER (PARTITION BY anchor_id, title_id // 1024 ORDER BY title_id) - 1 AS INT) AS position,
           title_id AS db_serial_number, headline_text, strftime(published_at, {STAMP}) AS published_time,
           levenshtein_similarity, jaccard_similarity
    FROM measured""", "measured")
_add("a2_cluster_averages", f"""
    SELECT * REPLACE (strftime(latest_update_time, {STAMP}) AS latest_update_time) FROM averages""", "averages")
_add("a3_payload_grouping", """
    SELECT cluster_id, count(*) OVER (PARTITION BY cluster_id) AS volume_count, title_id // 1024 AS part,
           CAST(row_number() OVER (PARTITION BY cluster_id, title_id // 1024 ORDER BY title_id) - 1 AS INT) AS position,
           title_id AS db_serial_number, title AS headline_text, md5(summary) AS summary_digest,
           1.0::DOUBLE AS jaccard_similarity
    FROM topics""", "topics")
_add("a4_mean_jaccard", f"""
    SELECT anchor_id % 50 AS cluster_id,
           {_two('sum(CAST(round(jaccard_similarity * 1000000) AS BIGINT)) / (count(*) * 1000000)', 4)} AS avg_jaccard
    FROM measured GROUP BY anchor_id % 50""", "measured")
_add("a5_mean_sentiment", f"""
    SELECT cluster_id, {_two('avg_sentiment', 4)} AS avg_sentiment FROM measures""", "measures")
_add("k3_cluster_append", rf"""
    SELECT (SELECT max(cluster_id) FROM clusters) + row_number() OVER (ORDER BY anchor_id) AS cluster_id,
           main_title, anchor_id AS title_id, avg_levenshtein, avg_jaccard, volume, CAST(NULL AS DOUBLE) AS score,
           strftime(latest_update_time, {STAMP}) AS last_updated
    FROM averages""", "averages", "clusters")
_add("k4_article_links", """
    SELECT title_id, CASE WHEN title_id % 3 <> 0 THEN appended.cluster_id ELSE topics.cluster_id END AS cluster_id
    FROM topics JOIN members USING (title_id) JOIN appended USING (anchor_id)""", "members", "appended")
_add("k5_schema_evolution", """
    SELECT cluster_id, main_title, volume, 0.0::DOUBLE AS score, 0.0::DOUBLE AS avg_sentiment, 0.0::DOUBLE AS avg_jaccard,
           (SELECT count(*) FROM articles) AS article_rows, CAST(0 AS BIGINT) AS article_links
    FROM clusters""", "clusters")
_UPDATED = f"""
    SELECT c.cluster_id, main_title, volume, coalesce(calculated_score, score) AS score,
           coalesce(a.avg_sentiment, 0.0::DOUBLE) AS avg_sentiment, coalesce(a.avg_jaccard, 0.0::DOUBLE) AS avg_jaccard,
           strftime(coalesce(evaluated_at, last_updated), {STAMP}) AS last_updated
    FROM stored_clusters c
    LEFT JOIN (SELECT * FROM set_actions WHERE action = 'UPSERT') a USING (cluster_id)"""
_add("k6_score_update", _UPDATED, "stored_clusters", "set_actions")
_add("k7_purge_clusters", _UPDATED + """
    WHERE c.cluster_id NOT IN (SELECT cluster_id FROM set_actions WHERE action = 'DELETE')""",
     "stored_clusters", "set_actions")
_add("k8_ticker_upsert", f"""
    SELECT symbol AS ticker_symbol,
           CASE WHEN symbol = 'error' THEN current ELSE current + 1.0 END AS current_price,
           prev_close AS prev_close_price,
           CASE WHEN symbol = 'error' THEN '2024-02-01 00:00:00' ELSE strftime({AS_OF}, {STAMP}) END AS updated_at
    FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_id DESC) = 1""", "ticks")
_add("k9_atomic_commit", "SELECT title_id, source_id, title, CAST(7 AS INT) AS last_batch FROM articles", "articles")
_add("r1_text_choice", """
    SELECT title_id, CASE WHEN title_id % 3 = 2 AND summary <> '' THEN summary
                          WHEN title_id % 2 = 1 THEN title ELSE '' END AS text FROM articles""", "articles")
_add("r2_lexicon_sentiment", "SELECT title_id, compound FROM compounds", "compounds")
_add("r3_volume_saturation", """
    SELECT cluster_id, round(count(*) / (count(*) + 2.0), 6) AS saturation FROM topics GROUP BY cluster_id""", "topics")
_add("r4_surge", """
    SELECT cluster_id, round(avg_sentiment * (volume / (volume + 2.0)) * avg_jaccard, 6) AS surge
    FROM measures""", "measures")
_add("r5_time_decay", f"""
    SELECT cluster_id, round(score * pow(0.666667, epoch({AS_OF} - last_evaluated_at) / 86400.0), 8) AS decayed
    FROM history""", "history")
_add("r6_compound_clamp", """
    SELECT cluster_id, round(greatest(-1.0, least(1.0, coalesce(score
                 * pow(0.666667, epoch(TIMESTAMP '2024-03-01 00:00:00' - last_evaluated_at) / 86400.0), 0.0)
                 + avg_sentiment * (volume / (volume + 2.0)) * 4.0)), 6) AS score
    FROM measures LEFT JOIN history USING (cluster_id)""", "measures", "history")
_add("r7_liveness", """
    SELECT title_id, CASE WHEN abs(title_id % 41 - 20) < 10 THEN 0.0 ELSE (title_id % 41 - 20) / 10000.0 END AS score,
           CASE WHEN abs(title_id % 41 - 20) < 10 THEN 'DELETE' ELSE 'UPSERT' END AS action
    FROM articles""", "articles")
_add("r8_scoring_job", f"""
    SELECT * REPLACE (strftime(evaluated_at, {STAMP}) AS evaluated_at) FROM actions""", "actions")
_add("r9_ranked_topics", f"""
    SELECT row_number() OVER (ORDER BY abs(calculated_score) DESC, c.cluster_id) AS rank, c.cluster_id, main_title,
           md5(summary) AS summary_digest, calculated_score AS score, volume, avg_jaccard, avg_sentiment,
           CASE WHEN avg_sentiment > 0 THEN 'Positive' WHEN avg_sentiment < 0 THEN 'Negative' ELSE 'Neutral' END
               AS sentiment_label,
           strftime(evaluated_at, {STAMP}) AS last_updated
    FROM stored_clusters c JOIN actions a ON a.cluster_id = c.cluster_id AND action = 'UPSERT'
    JOIN articles ON articles.title_id = c.title_id""", "stored_clusters", "actions", "articles")
_add("m1_percent_change", f"""
    SELECT event_id, symbol AS ticker_symbol, {_two('(current - p) / nullif(p, 0) * 100')} AS change_pct
    FROM (SELECT *, CASE WHEN event_id % 50 = 0 THEN 0.0 ELSE prev_close END AS p FROM ticks)""", "ticks")
_add("m2_price_cards", """
    SELECT upper(coin) || '#' || event_id AS name,
           CASE WHEN usd_24h_change > 0 THEN 'up' WHEN usd_24h_change IS NOT NULL THEN 'down' END AS trend,
           '$' || regexp_replace(format('{:,}', CAST(trunc(usd) AS BIGINT))
               || CASE WHEN usd = trunc(usd) THEN ''
                       ELSE '.' || split_part(CAST(usd AS VARCHAR), '.', 2) END, '\\.0$', '') AS price,
           printf('%.2f', usd_24h_change) || '%' AS change
    FROM prices""", "prices")
ORACLE_SQL["m3_growth_schedule"] = """
    WITH RECURSIVE growth AS (
        SELECT c_custkey AS plan_id, 0 AS year, c_custkey % 1000 AS monthly, c_nationkey / 100.0 + 1.0 AS factor,
               0.0::DOUBLE AS before, 0.0::DOUBLE AS total FROM customer
        UNION ALL
        SELECT plan_id, year + 1, monthly, factor, total + monthly * 12, (total + monthly * 12) * factor
        FROM growth WHERE year < 10)
    """ + f"""SELECT plan_id, year, CAST(monthly * 12 * year AS BIGINT) AS invested,
              {_two('total - before')} AS interest, {_two('total')} AS total FROM growth WHERE year > 0"""
_add("t1_ticker_stream", f"""
    SELECT symbol AS ticker_symbol, current AS current_price, prev_close AS prev_close_price,
           strftime({AS_OF}, {STAMP}) AS updated_at
    FROM ticks QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY event_id DESC) = 1""", "ticks")
_add("t2_article_stream", rf"""
    SELECT row_number() OVER (ORDER BY late, site, seq) AS title_id, site AS source_id, headline AS title, link, summary,
           strftime({AS_OF}, {STAMP}) AS date_captured
    FROM (SELECT * FROM (
              SELECT *, page_num * 2147483648 + pos AS seq, page_num > (SELECT max(page_id) // 2 FROM pages) AS late
              FROM dom_records
              QUALIFY row_number() OVER (PARTITION BY late, site, regexp_replace(regexp_replace(lower(headline),
                  '[^\p{{L}}\p{{N}}_\s\p{{Z}}]', '', 'g'), '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')
                  ORDER BY page_num, pos) = 1)
          WHERE headline <> '' AND link IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY headline ORDER BY late, site, seq) = 1)""", "dom_records")
