"""SQL that must agree with queries of this package, for the operators that SQL can express."""

from __future__ import annotations

from captide.llm import hard_negatives, quality, substring_dedup

_MEASURES = ", ".join(f"({m!r}, {m}, {slack}::BIGINT)" for m, slack in quality.SLACK.items())

QUALITY_SQL = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT r, doc_id, lang, source, t,
    list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM texts
), starts AS (
  SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM split WHERE len(w) >= 3
), repeated AS (
  SELECT r, i FROM starts
  QUALIFY count(*) OVER (PARTITION BY r, w[i], w[i + 1], w[i + 2]) > 1
), covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r
), counts AS (
  SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols, len(l)::BIGINT AS n_lines,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)
), base AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEATED_PERCENT} * n_words AS base_failed
  FROM counts
), measures AS (
  SELECT b.*, m.measure, m.v, m.slack FROM (
    SELECT *, 1000 * n_symbols // nullif(n_words, 0) AS symbol_rate, 1000 * n_repeat_words // nullif(n_words, 0) AS repeat_rate,
      1000 * n_dup_lines // nullif(n_lines, 0) AS dup_line_rate, 1000 * word_chars // nullif(n_words, 0) AS word_length
    FROM base
  ) b, LATERAL (SELECT * FROM (VALUES {_MEASURES}) AS x(measure, v, slack)) m
), bucketed AS (
  SELECT lang, source, measure, slack,
    CASE WHEN v < 64 THEN v ELSE (length(bin(v)) - 6) * 32 + (v >> (length(bin(v)) - 6)) END AS b, count(*) AS n
  FROM measures WHERE NOT base_failed AND v IS NOT NULL GROUP BY ALL
), grouped AS (
  SELECT 'own' AS level, lang, source, measure, slack, b, n FROM bucketed
  UNION ALL SELECT 'lang', lang, NULL, measure, slack, b, sum(n) FROM bucketed GROUP BY ALL
  UNION ALL SELECT 'all', NULL, NULL, measure, slack, b, sum(n) FROM bucketed GROUP BY ALL
), running AS (
  SELECT *, sum(n) OVER g AS rows, sum(n) OVER (g ORDER BY b ROWS UNBOUNDED PRECEDING) AS upto
  FROM grouped WINDOW g AS (PARTITION BY level, lang, source, measure)
), quartiles AS (
  SELECT level, lang, source, measure, slack, max(rows) AS rows,
    min(b) FILTER (4 * upto >= rows) AS b1, min(b) FILTER (4 * upto >= 3 * rows) AS b3
  FROM running GROUP BY ALL
), fences AS (
  SELECT level, lang, source, measure, rows, q1, q3, 3 * (q3 - q1) + slack AS reach FROM (
    SELECT *, CASE WHEN b1 < 64 THEN b1 ELSE (b1 - (b1 // 32 - 1) * 32) << (b1 // 32 - 1) END AS q1,
      CASE WHEN b3 < 64 THEN b3 ELSE (b3 - (b3 // 32 - 1) * 32) << (b3 // 32 - 1) END AS q3
    FROM quartiles)
), bounds AS (
  SELECT o.lang, o.source, o.measure,
    CASE WHEN o.rows >= {quality.GROUP_ROWS} THEN least(o.q3 + o.reach, 2 * (p.q3 + p.reach)) ELSE p.q3 + p.reach END AS high,
    CASE WHEN o.rows >= {quality.GROUP_ROWS} THEN greatest(o.q1 - o.reach, floor((p.q1 - p.reach) / 2)) ELSE p.q1 - p.reach END AS low
  FROM fences o JOIN fences l ON o.level = 'own' AND l.level = 'lang' AND l.lang IS NOT DISTINCT FROM o.lang AND l.measure = o.measure
  JOIN fences p ON p.measure = o.measure AND p.level = CASE WHEN l.rows >= {quality.GROUP_ROWS} THEN 'lang' ELSE 'all' END
    AND (p.level = 'all' OR p.lang IS NOT DISTINCT FROM o.lang)
), failed AS (
  SELECT DISTINCT m.r FROM measures m JOIN bounds b
    ON b.lang IS NOT DISTINCT FROM m.lang AND b.source IS NOT DISTINCT FROM m.source AND b.measure = m.measure
  WHERE m.v > b.high OR (m.measure = 'word_length' AND m.v < b.low)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND failed.r IS NULL AS kept
FROM base LEFT JOIN failed USING (r)
"""

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"


def url_sql(site_rules, pattern_rules) -> str:
    """The verdict on every page, by a plain comparison with every rule."""
    sites = ", ".join(f"('{verdict}', '{site}', '{site.partition('/')[0]}', '/{site.partition('/')[2]}')" for verdict, site in site_rules)
    patterns = ", ".join(f"('{verdict}', '{pattern}')" for verdict, pattern, _ in pattern_rules)
    return rf"""
WITH parts AS (
  SELECT row_number() OVER () AS r, page_id, coalesce(regexp_extract(url, '(?s)^.*?://(.*)$', 1), '') AS tail FROM pages
), located AS (
  SELECT r, page_id, translate(regexp_extract(tail, '^[^/?#]*'), {_LOWER}) AS host, regexp_extract(tail, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), sites(verdict, rule, h, p) AS (VALUES {sites}
), patterns(verdict, pattern) AS (VALUES {patterns}
), named AS (
  SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM located, sites WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY r
), matched AS (
  SELECT r, max(verdict) AS verdict FROM located, patterns WHERE regexp_matches(host || path, pattern) GROUP BY r
)
SELECT page_id, host, path, named.rule, coalesce(named.verdict, matched.verdict, 'allow') AS verdict
FROM located LEFT JOIN named USING (r) LEFT JOIN matched USING (r)
"""

# Hard negatives by brute force: every anchor scored against every row.
NEGATIVES_SQL = rf"""
WITH clean AS (
  SELECT vec_id,
    CASE WHEN vec_id % {hard_negatives.RELABEL_EVERY} = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))::BIGINT) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, v.vec_id, v.label,
    coalesce(list_sum(list_transform(list_zip(a.q, v.q), lambda z: coalesce(z[1], 0) * coalesce(z[2], 0))), 0)::BIGINT AS score
  FROM clean a JOIN clean v ON a.vec_id % {hard_negatives.ANCHOR_EVERY} = 0 AND v.vec_id <> a.vec_id
), positives AS (
  SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM scored WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {hard_negatives.POSITIVES}
), negatives AS (
  SELECT p.anchor_id, p.positive_id, n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
  FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND n.label <> p.anchor_label
  WHERE {hard_negatives.LOW_PERCENT} * p.positive_score <= 100 * n.score AND 100 * n.score <= {hard_negatives.HIGH_PERCENT} * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY negative_score DESC, negative_id) AS INTEGER) AS rank
  FROM negatives
) WHERE rank <= {hard_negatives.NEGATIVES}
"""

# Substring dedup by brute force: every window looked up among the windows of smaller documents.
SUBSTRING_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), windows AS (
  SELECT r, doc_id, i, w[i:i + {substring_dedup.WINDOW - 1}] AS seq
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - {substring_dedup.WINDOW - 2})) AS i FROM docs WHERE len(w) >= {substring_dedup.WINDOW})
), firsts AS (
  SELECT seq, min(doc_id) AS first FROM windows GROUP BY seq
), hit AS (
  SELECT DISTINCT w.r, unnest(range(w.i, w.i + {substring_dedup.WINDOW})) AS p
  FROM windows w JOIN firsts f ON f.seq = w.seq WHERE f.first < w.doc_id
), flagged AS (
  SELECT d.r, d.doc_id, len(d.w)::BIGINT AS n_words,
    count(h.p)::BIGINT AS n_removed
  FROM docs d LEFT JOIN hit h ON h.r = d.r GROUP BY ALL
), kept AS (
  SELECT d.r, string_agg(word, ' ' ORDER BY p) AS kept
  FROM (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM docs) d
  WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.r = d.r AND h.p = d.p) GROUP BY d.r
)
SELECT f.doc_id, f.n_words, f.n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM flagged f LEFT JOIN kept k USING (r)
"""
