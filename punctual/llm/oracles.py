"""DuckDB SQL for the corpus queries that SQL can express. The other ones are held against brute force in tests."""

from __future__ import annotations

from .quality import EVERY_TEXT_RULES, STOP_WORDS


def _texts(words: list[str]) -> str:
    return "[" + ", ".join(f"'{word}'" for word in words) + "]"


def _rules() -> str:
    parts = []
    for rule in EVERY_TEXT_RULES:
        if rule.low is not None:
            parts.append(f"coalesce({rule.measure} >= {rule.low}, true)")
        if rule.high is not None:
            parts.append(f"coalesce({rule.measure} <= {rule.high}, true)")
    return " AND ".join(parts)


_STOPS = " ".join(f"WHEN lang = '{code}' THEN {_texts(words)}" for code, words in STOP_WORDS.items())
_ANY_STOP = _texts(sorted({word for words in STOP_WORDS.values() for word in words}))

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines,
    CASE {_STOPS} ELSE {_ANY_STOP} END AS stops
  FROM d
), win AS (
  SELECT rid, i, array_to_string(words[i:i + 7], ' ') AS g
  FROM w, unnest(range(1, len(words) - 6)) AS t(i) WHERE len(words) >= 8
), rep AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM win) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM rep, range(0, 8) AS r(k) GROUP BY rid
), m AS (
  SELECT w.doc_id, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(range(2, len(words) + 1), lambda i: words[i] = words[i - 1])) AS stutters,
    len(regexp_extract_all(text, '[A-Z0-9]')) AS capitals,
    len(list_filter(lines, lambda line: regexp_matches(line, '^\s*[-*•]'))) AS bullets,
    len(list_intersect(list_distinct(words), stops)) AS own_stop_word_hits
  FROM w LEFT JOIN covered ON w.rid = covered.rid
), r AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
    word_chars / nullif(n_words, 0) AS mean_word_chars,
    n_symbols / nullif(n_words, 0) AS symbol_word_ratio,
    n_dup_lines / nullif(n_lines, 0) AS dup_line_ratio,
    stutters / nullif(n_words, 0) AS stutter_word_ratio,
    capitals / nullif(word_chars, 0) AS capital_digit_ratio,
    bullets / nullif(n_lines, 0) AS bullet_line_ratio
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {_rules()} AS kept
FROM r
"""

URL_LISTS = r"""
WITH c AS (
  SELECT page_id, url, 1704067200 + (page_id * 7919) % 15552000 AS fetched_s,
    regexp_replace(lower(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)', 1)), '\.$', '') AS host,
    regexp_replace(regexp_extract(url, '^\s*[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)', 1), '/+$', '') AS path
  FROM pages
), listed AS (
  SELECT DISTINCT regexp_replace(host, '^(www|m|blog)\.', '') AS domain FROM c
  WHERE host <> '' AND (regexp_matches(regexp_replace(host, '^(www|m|blog)\.', ''), 'casino|bets|pills|ads-')
    OR length(regexp_replace(host, '^(www|m|blog)\.', '')) % 4 = 0)
), entries AS (
  SELECT domain AS key, 'block' AS action, 1704067200 + length(domain) * 5 % 60 * 86400 AS since FROM listed
  UNION ALL SELECT domain, 'allow', 1704067200 + (length(domain) + 60) * 86400 FROM listed WHERE length(domain) % 2 = 0
  UNION ALL SELECT domain, 'block', 1704067200 + (length(domain) + 120) * 86400 FROM listed WHERE length(domain) % 3 = 0
  UNION ALL SELECT domain || '/en', 'allow', 1704067200 + (length(domain) % 30 + 30) * 86400 FROM listed WHERE length(domain) % 5 < 2
), valid AS (
  SELECT key, action, since AS valid_from, lead(since) OVER (PARTITION BY key ORDER BY since) AS valid_to
  FROM (SELECT key, since, max(action) AS action FROM entries GROUP BY key, since)
), asked AS (
  SELECT page_id, fetched_s, unnest(list_concat(
    list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.')),
    CASE WHEN path = '' THEN []::VARCHAR[] ELSE
      list_transform(range(1, len(string_split(path, '/')) + 1), lambda i: host || '/' || array_to_string(string_split(path, '/')[1:i], '/')) END
  )) AS key FROM c WHERE host <> ''
), hits AS (
  SELECT page_id, a.key, valid_from, action, row_number() OVER (
    PARTITION BY page_id ORDER BY contains(a.key, '/') DESC, length(a.key) DESC) AS place
  FROM asked a JOIN valid v ON a.key = v.key AND v.valid_from <= fetched_s AND (v.valid_to IS NULL OR fetched_s < v.valid_to)
)
SELECT c.page_id, url, c.fetched_s::BIGINT AS fetched_s, h.key AS matched_key, h.valid_from::BIGINT AS matched_from_s,
  coalesce(h.action <> 'block', true) AS kept
FROM c LEFT JOIN (SELECT * FROM hits WHERE place = 1) h ON c.page_id = h.page_id
"""

ORACLES = {
    "op4_quality_rules": QUALITY,
    "op5_temporal_url_lists": URL_LISTS,
}
