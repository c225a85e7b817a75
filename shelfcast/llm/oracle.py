"""DuckDB SQL for the queries of this subpackage that SQL can state."""

from __future__ import annotations

_OP1 = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), phrases AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, w[i : i + least(len(w), 10) - 1] AS pattern
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i
        FROM phrases WHERE len(w) > 0)
), sizes AS (
  SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, size, i, w[i : i + size - 1] AS pattern
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, sizes WHERE len(w) >= size)
), hits AS (
  SELECT doc_id, item_id, i, size FROM places JOIN windows USING (size, pattern)
), covered AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM hits) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_OP2 = r"""
WITH parts AS (
  SELECT page_id, html,
    translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), fitting AS (
  SELECT page_id, rule_host || rule_path AS rule, rule_verdict, row_number() OVER (
    PARTITION BY page_id ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
  FROM parts JOIN rules
  ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
), origins AS (
  SELECT page_id, host || path AS key,
    html IS NOT NULL AND page_id > min(page_id) OVER (PARTITION BY html) AS copied
  FROM parts
), mirrors AS (
  SELECT key FROM origins GROUP BY key HAVING bool_and(copied)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict,
  CASE WHEN host || path IN (SELECT key FROM mirrors) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN (SELECT * FROM fitting WHERE place = 1) USING (page_id)
"""

_OP6 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i
        FROM words WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c.n >= 75 * (x.n + y.n - c.n)
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_reached AS (
  SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached USING (doc_id)
"""

# a turn costs 24 characters besides role and text, and one for each escaped string
_OP10 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT unnest([-1, -1]), unnest([0, 1]), unnest(['user', 'assistant']), '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 24 + length(role) + length(text) + len(regexp_extract_all(role || text,
    '\\|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>')) AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars,
  CASE WHEN string_agg(role, ',' ORDER BY turn, role, text) = 'user,assistant'
      AND (conv_id % 8 + 8) % 8 > 3
    THEN ['instruction', 'completion', 'response', 'question'][(conv_id % 8 + 8) % 8 - 3]
    WHEN bool_or(role IN ('human', 'gpt', 'bot', 'model')) THEN 'turns'
    ELSE ['turns', 'messages', 'parts', 'shared'][(conv_id % 4 + 4) % 4 + 1] END AS layout
FROM sized GROUP BY conv_id
"""

# masks: A 1, B 2, C 4, D 8, E 16
_OP11 = r"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), masks AS (
  SELECT doc_id, part,
    CASE WHEN len(w) < 100 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
    + CASE WHEN 100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM texts
), told AS (
  SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic
  FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM masks LEFT JOIN told USING (doc_id) GROUP BY part, mask
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 4, 8, 16]) AS bit
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order,
    [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0)::INTEGER AS before
  FROM (SELECT *, unnest(range(1, 6))::INTEGER AS step FROM orders)
), counted AS (
  SELECT part, filter_order, step, bit,
    coalesce(sum(n) FILTER ((mask & (before | bit)) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER ((mask & before) = 0 AND (mask & bit) > 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER ((mask & before) > 0 AND (mask & bit) > 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER ((mask & before) = 0 AND (mask & bit) > 0), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER ((mask & before) = 0 AND (mask & bit) > 0), 0)::BIGINT AS toxic_lost
  FROM cells, steps GROUP BY part, filter_order, step, bit
)
SELECT * EXCLUDE (bit), (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM counted
"""

ORACLES = {
    "op1_decontaminate": _OP1,
    "op2_url_filter": _OP2,
    "op6_near_duplicates": _OP6,
    "op10_chat_format": _OP10,
    "op11_filter_audit": _OP11,
}
