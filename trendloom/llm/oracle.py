"""SQL for the queries whose results SQL can express."""

from __future__ import annotations

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5(concat_ws('|', 'mix', CAST(doc_id AS VARCHAR))), 1, 8) AS BIGINT) AS h
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, 3 * source_size AS cap, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM s
), o AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS weights,
         CAST(coalesce(sum(cap) OVER e, 0) AS BIGINT) AS caps_before,
         CAST(coalesce(sum(weight) OVER e, 0) AS BIGINT) AS weights_before
  FROM w
  WINDOW e AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), c AS (
  SELECT *, CAST(total - caps_before AS DOUBLE) * weight > CAST(cap AS DOUBLE) * (weights - weights_before) AS capped
  FROM o
), t AS (
  SELECT source, source_size,
         CASE WHEN capped THEN CAST(cap AS DOUBLE)
              ELSE CAST(weight * (total - CAST(sum(CASE WHEN capped THEN cap ELSE 0 END) OVER () AS BIGINT)) AS DOUBLE)
                   / CAST(sum(CASE WHEN capped THEN 0 ELSE weight END) OVER () AS BIGINT) END AS target
  FROM c
), p AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t
), x AS (
  SELECT d.doc_id, d.source, d.size, p.source_size, p.target, p.whole, p.target - p.whole * p.source_size AS budget,
         CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS through,
         CAST(sum(d.size) OVER (PARTITION BY d.source, d.h) AS BIGINT) AS same
  FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, source, size, source_size, target,
       size * (whole + CASE WHEN budget > 0 AND (through < budget OR (through - same < budget
               AND through - budget < budget - (through - same))) THEN 1 ELSE 0 END) AS taken
FROM x
"""

OP8 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, keep_id, group_size,
       doc_id IS NOT DISTINCT FROM keep_id
         AND row_number() OVER (PARTITION BY text, doc_id) = 1 AS kept, text_sha256
FROM (
  SELECT doc_id, text, max(doc_id) OVER (PARTITION BY text) AS keep_id,
         count(*) OVER (PARTITION BY text) AS group_size, sha256(text) AS text_sha256
  FROM d
)
"""

OP2 = r"""
WITH parts AS (
  SELECT page_id, url,
         coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), tokens AS (
  SELECT url, list_distinct(list_filter(list_concat(
           list_transform(list_reverse(string_split(host, '.')), lambda x, i: 'h' || (i - 1) || ':' || x),
           list_transform(regexp_split_to_array(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[/.]'), lambda x: 'p:' || x),
           list_transform(regexp_extract_all(regexp_extract(url, '(?s)\?([^#]*)', 1), '(?:^|&)([^=&]+)', 1), lambda x: 'q:' || x)),
         lambda t: NOT regexp_matches(t, '^\w+:$'))) AS tokens, page_id
  FROM parts WHERE url IS NOT NULL
), bad AS (
  SELECT doc_id, max(CASE WHEN coalesce(quality = 0 OR toxic = 1, false) THEN 1 ELSE 0 END) AS bad FROM labels GROUP BY doc_id
), labelled AS (
  SELECT row_number() OVER () AS k, tokens, bad FROM tokens JOIN bad ON page_id = doc_id
), n AS (
  SELECT ceil(greatest(CAST(0.005 AS DOUBLE), CAST(5 AS DOUBLE) / count(*)) * count(*)) AS least FROM labelled
), one AS (
  SELECT k, bad, unnest(tokens) AS t FROM labelled
), combos AS (
  SELECT k, bad, [t] AS c FROM one
  UNION ALL SELECT a.k, a.bad, [a.t, b.t] FROM one a JOIN one b ON a.k = b.k AND a.t < b.t
  UNION ALL SELECT a.k, a.bad, [a.t, b.t, x.t] FROM one a JOIN one b ON a.k = b.k AND a.t < b.t JOIN one x ON a.k = x.k AND b.t < x.t
), rules AS (
  SELECT c, CAST(sum(bad) AS DOUBLE) / count(*) AS confidence FROM combos GROUP BY c
  HAVING sum(bad) >= (SELECT least FROM n) AND CAST(sum(bad) AS DOUBLE) / count(*) >= 0.8
), kept AS (
  SELECT c FROM rules r WHERE NOT EXISTS (
    SELECT 1 FROM rules p WHERE len(p.c) < len(r.c) AND p.confidence >= r.confidence AND list_has_all(r.c, p.c))
), hits AS (
  SELECT DISTINCT url FROM tokens JOIN kept ON list_has_all(tokens, c)
), judged AS (
  SELECT p.page_id, host, path, h.url IS NOT NULL AS matched,
         CASE WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
              WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
              WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
  FROM parts p LEFT JOIN hits h ON p.url = h.url
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
            WHEN matched THEN 'block' ELSE 'allow' END AS verdict, matched
FROM judged
"""

OP3 = r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), windows AS (
  SELECT k, i, [words[i], words[i + 1], words[i + 2]] AS w FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM d)
), again AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, w) AS n FROM windows) WHERE n > 1
), inside AS (
  SELECT k, count(DISTINCT i + j) AS n FROM again, (VALUES (0), (1), (2)) AS o(j) GROUP BY k
), f AS (
  SELECT d.k, doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN inside ON d.k = inside.k
), g AS (
  SELECT * EXCLUDE (lines), CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         word_chars / CAST(greatest(n_words, 1) AS DOUBLE) AS a, n_symbols / CAST(greatest(word_chars, 1) AS DOUBLE) AS b,
         (len(lines) - len(list_distinct(lines))) / CAST(greatest(len(lines), 1) AS DOUBLE) AS c,
         n_repeat_words / CAST(greatest(n_words, 1) AS DOUBLE) AS e
  FROM f
), q AS (
  SELECT lang, source, grouping(lang, source) AS level, count(*) AS n,
         quantile_disc(a, 0.25) AS a1, quantile_disc(a, 0.75) AS a3, quantile_disc(b, 0.25) AS b1, quantile_disc(b, 0.75) AS b3,
         quantile_disc(c, 0.25) AS c1, quantile_disc(c, 0.75) AS c3, quantile_disc(e, 0.25) AS e1, quantile_disc(e, 0.75) AS e3
  FROM g WHERE NOT base_failed GROUP BY GROUPING SETS ((lang, source), (lang), ())
), used AS (
  SELECT g.*, q.* EXCLUDE (lang, source, n, level),
         row_number() OVER (PARTITION BY g.k ORDER BY q.level) AS choice
  FROM g LEFT JOIN q ON (q.n >= 50 OR q.level = 3)
   AND (q.level = 3 OR g.lang IS NOT DISTINCT FROM q.lang) AND (q.level >= 1 OR g.source IS NOT DISTINCT FROM q.source)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed
       AND NOT coalesce(a > a3 + greatest(6 * (a3 - a1), 1.5) OR a < a1 - greatest(6 * (a3 - a1), 1.5), false)
       AND NOT coalesce(b > b3 + greatest(6 * (b3 - b1), 0.05), false)
       AND NOT coalesce(c > c3 + greatest(6 * (c3 - c1), 0.50), false)
       AND NOT coalesce(e > e3 + greatest(6 * (e3 - e1), 0.40), false) AS kept
FROM used WHERE choice = 1
"""

OP13 = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), p AS (
  SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d
), w AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p
), g AS (
  SELECT lang, k, ws, unnest(range(1, len(ws) - k + 2)) AS i
  FROM w, (VALUES (1), (2), (3)) AS ks(k)
), c AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL
), n AS (
  SELECT lang, sum(f) AS n FROM c WHERE k = 1 GROUP BY lang
), cand AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS ws FROM c WHERE k >= 2 AND f >= 10
), cuts AS (
  SELECT cand.lang, cand.phrase, cand.a, cut, cl.f AS l, cr.f AS r,
         CAST(cand.a AS HUGEINT) * cand.a * 1000000 // (CAST(cl.f AS HUGEINT) * cr.f) AS score
  FROM cand, range(1, cand.k) AS cs(cut)
  JOIN c cl ON cl.lang = cand.lang AND cl.phrase = array_to_string(cand.ws[1:cut], ' ')
  JOIN c cr ON cr.lang = cand.lang AND cr.phrase = array_to_string(cand.ws[cut + 1:], ' ')
), best AS (
  SELECT lang, phrase, a, l, r, score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS o FROM cuts
  ) WHERE o = 1
), covering AS (
  SELECT lang, sub AS phrase, max(a) AS longer FROM (
    SELECT lang, a, array_to_string(ws[1:2], ' ') AS sub FROM cand WHERE k = 3
    UNION ALL
    SELECT lang, a, array_to_string(ws[2:3], ' ') AS sub FROM cand WHERE k = 3
  ) GROUP BY lang, sub
), kept AS (
  SELECT best.* FROM best LEFT JOIN covering USING (lang, phrase)
  WHERE covering.longer IS NULL OR covering.longer * 100 < best.a * 50
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase ASC) AS rank FROM kept
)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
       CAST(r AS BIGINT) AS r, CAST(n.n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": OP2, "op3_quality_rules": OP3, "op5_mix_sources": OP5, "op8_exact_dedup": OP8,
    "op13_collocations": OP13,
}
