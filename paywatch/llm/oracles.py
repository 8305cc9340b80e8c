"""SQL (DuckDB) for the queries that SQL can express on whole tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
ORACLES = {
    "op10_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS body
  FROM documents
), g AS (
  SELECT body, count(*) AS group_size, arg_min(doc_id, (-n, doc_id)) AS keep_id FROM d GROUP BY body
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM d JOIN g USING (body)
""",
    "op4_decontamination": rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), pattern AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, list_slice(w, i, i + least(len(w), 10) - 1) AS g
  FROM b, unnest(generate_series(1, len(w) - least(len(w), 10) + 1)) t(i) WHERE len(w) > 0
), place AS (
  SELECT doc_id, size, i, list_slice(w, i, i + size - 1) AS g
  FROM d, (SELECT DISTINCT size FROM pattern), unnest(generate_series(1, len(w) - size + 1)) t(i)
), hit AS (SELECT doc_id, size, i, item_id FROM place JOIN pattern USING (size, g)),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT doc_id, size, i FROM hit), unnest(generate_series(0, size - 1)) t(k) GROUP BY doc_id
), named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS name FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
""",
    "op5_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 19) AS g FROM d, unnest(generate_series(1, len(w) - 19)) t(i)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS place FROM later, unnest(generate_series(0, 19)) t(k)),
word AS (SELECT doc_id, w[i] AS word, i AS place FROM d, unnest(generate_series(1, len(w))) t(i)),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS body
  FROM word ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op6_line_dedup": r"""
WITH p AS (
  SELECT page_id, lower(regexp_extract(coalesce(url, ''), '^(?i:[a-z][a-z0-9+.-]*:)?//([^/?#]*)', 1)) AS host,
  regexp_replace(regexp_replace(regexp_replace(coalesce(html, ''),
    '(?is)<(script|style|head|noscript|template)\b[^>]*>.*?</(script|style|head|noscript|template)\s*>|<!--.*?-->', ' ', 'g'),
    '(?i)</?(p|div|br|li|ul|ol|h[1-6]|tr|td|th|table|nav|article|section|header|footer|aside|main|form|blockquote|pre|body|html|dt|dd|dl)\b[^>]*>', chr(10), 'g'),
    '<[^>]*>', '', 'g') AS body FROM pages
), q AS (
  SELECT page_id, host, replace(replace(replace(replace(replace(replace(replace(replace(body, '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'),
    '&quot;', '"'), '&#39;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&amp;', '&') AS body FROM p
), lined AS (
  SELECT page_id, host, list_filter(list_transform(string_split(regexp_replace(body, '[ \t\x0B\f\r]+', ' ', 'g'), chr(10)), lambda x: trim(x)), lambda x: x <> '') AS lines FROM q
), having_line AS (
  SELECT host, line, count(*) AS n FROM (SELECT host, unnest(list_distinct(lines)) AS line FROM lined) GROUP BY ALL
), common AS (
  SELECT host, list(line) AS common FROM having_line JOIN (SELECT host, count(*) AS pages FROM lined GROUP BY host) USING (host)
  WHERE pages >= 5 AND n / pages > 0.3 GROUP BY host
), kept AS (
  SELECT page_id, host, lines, CASE WHEN common IS NULL THEN lines ELSE list_filter(lines, lambda x: NOT list_contains(common, x)) END AS kept
  FROM lined LEFT JOIN common USING (host)
)
SELECT page_id, host, array_to_string(kept, chr(10)) AS text, CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(kept) AS BIGINT) AS n_dropped FROM kept
""",
    "op8_source_mixing": r"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS tokens FROM documents
), totals AS (
  SELECT source, sum(tokens)::BIGINT AS total, count(*) AS n FROM sized GROUP BY source HAVING sum(tokens) > 0
), shares AS (SELECT *, total / (SELECT sum(total)::DOUBLE FROM totals) AS share FROM totals),
search AS (
  SELECT 0 AS step, 0.0::DOUBLE AS low, 1.0::DOUBLE AS high, 0.0::DOUBLE AS asked UNION ALL
  SELECT step + 1, CASE WHEN often THEN asked ELSE low END, CASE WHEN often THEN high ELSE asked END,
    CASE WHEN often THEN (asked + high) / 2 ELSE (low + asked) / 2 END
  FROM (SELECT step, low, high, asked,
    (SELECT max(pow(share, asked) / total) / min(pow(share, asked) / total) FROM shares) > 4.0 * (1 + 1e-12) AS often FROM search)
  WHERE step < 41 AND NOT (step = 0 AND NOT often)
), chosen AS (SELECT CASE WHEN max(step) = 0 THEN 0.0 ELSE arg_max(high, step) END AS t FROM search),
power AS (SELECT *, pow(share, (SELECT t FROM chosen)) AS p FROM shares),
plan AS (
  SELECT source, total, n, round(p / total / (SELECT min(p / total) FROM power), 9) AS repeats,
    round(p / (SELECT sum(p) FROM power), 9) AS weight FROM power
), goal AS (
  SELECT *, floor(repeats)::BIGINT AS whole, floor((repeats - floor(repeats)) * total)::BIGINT AS rest FROM plan
), goals AS (SELECT *, whole * total + rest AS target FROM goal),
shown AS (
  SELECT s.doc_id, s.source, s.tokens, g.* EXCLUDE (source), e AS epoch,
    CAST('0x' || substr(md5(coalesce(CAST(s.doc_id AS VARCHAR), '') || '|' || CAST(e AS VARCHAR)), 1, 15) AS BIGINT) AS h
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source,
  unnest(generate_series(1, g.whole + CASE WHEN g.rest > 0 THEN 1 ELSE 0 END)) t(e)
), placed AS (
  SELECT *, sum(tokens) OVER (PARTITION BY source, epoch ORDER BY h, doc_id, tokens ROWS UNBOUNDED PRECEDING) AS upto FROM shown
), blocks AS (SELECT greatest(1, ceil(sum(target) / 200000.0))::BIGINT AS blocks FROM goals),
cut AS (
  SELECT *, least(floor(((epoch - 1) * total + upto - tokens)::DOUBLE / target::DOUBLE * blocks), blocks - 1)::BIGINT AS block
  FROM placed, blocks WHERE epoch <= whole OR upto <= rest
)
SELECT doc_id, source, epoch, block, row_number() OVER (PARTITION BY block ORDER BY h, doc_id, epoch, tokens) AS place, tokens AS n_tokens, weight FROM cut
""",
}
