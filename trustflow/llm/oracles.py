"""DuckDB texts of the operators that SQL can express."""

from __future__ import annotations

_ASCII_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all({_ASCII_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS m,
    array_to_string(w[p : p + least(13, len(w)) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS p FROM i WHERE len(w) > 0)
), spot AS (
  SELECT doc_id, p, m, array_to_string(w[p : p + m - 1], ' ') AS s
  FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS p
        FROM d, (SELECT DISTINCT m FROM win) WHERE len(w) >= m)
), hit AS (SELECT doc_id, p, m, item_id FROM spot JOIN win USING (m, s)
), words AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + m)) AS q FROM hit) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, sha1(coalesce(html, '')) AS sha, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY sha, payload_bytes) AS first FROM p)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
"""


def _spans(kind: str, pattern: str, holds: str = "true") -> str:
    """Rows (doc_id, kind, start, end, m) of one pattern: the lengths of the pieces between the
    matches and of the matches give the places."""
    return rf"""
  SELECT doc_id, '{kind}' AS kind, s AS "start", s + length(m) AS "end", m FROM (
    SELECT doc_id, unnest(range(1, len(ms) + 1)) AS i, ms[i] AS m,
      list_sum(list_transform(ps[1:i], lambda x: length(x)))::BIGINT
        + coalesce(list_sum(list_transform(ms[1:i-1], lambda x: length(x))), 0)::BIGINT AS s
    FROM (SELECT doc_id, regexp_extract_all(t, '{pattern}') AS ms, string_split_regex(t, '{pattern}') AS ps
          FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))
  ) WHERE {holds}"""


_ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""

SECRETS = rf"""
WITH base AS ({_spans("assign", _ASSIGN, f"length(regexp_extract(m, '{_ASSIGN}', 2)) >= 6")}
  UNION ALL {_spans("access", "AKIA[A-Z0-9]+", "length(m) >= 20")}
  UNION ALL {_spans("hex", "[0-9a-f]+", "length(m) >= 24")}
), more AS ({_spans("pem", "-----BEGIN (?:[A-Z]{1,20} ){0,3}PRIVATE KEY-----")}
  UNION ALL {_spans("jwt", r"\beyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}")}
  UNION ALL {_spans("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}")}
), spans AS (
  SELECT doc_id, kind, list_position(['assign', 'access', 'hex', 'pem', 'jwt', 'github'], kind) AS k, "start",
    concat_ws(':', kind, "start", "end") AS s
  FROM (SELECT * FROM base UNION ALL SELECT * FROM more)
), agg AS (
  SELECT doc_id, count(*) FILTER (k = 1) AS n_assign, count(*) FILTER (k = 2) AS n_access, count(*) FILTER (k = 3) AS n_hex,
    string_agg(s, ',' ORDER BY "start", k) FILTER (k <= 3) AS b, string_agg(s, ',' ORDER BY "start", k) AS spans
  FROM spans GROUP BY doc_id
)
SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
  coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(b, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN agg USING (doc_id)
"""


_SPACE = r"[\x20\x09-\x0D]"
_WORDS = r"[^\x20\x09-\x0D]+"

QUALITY = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORDS}') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_WORDS}')) AS l
  FROM documents
), win AS (
  SELECT doc_id, p, array_to_string(w[p : p + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS p FROM d WHERE len(w) > 2)
), again AS (
  SELECT doc_id, p FROM win JOIN (SELECT doc_id, s FROM win GROUP BY ALL HAVING count(*) > 1) USING (doc_id, s)
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM again) GROUP BY doc_id
), m AS (
  SELECT doc_id, t, w, l, len(w)::BIGINT AS n_words,
    length(regexp_replace(t, '{_SPACE}', '', 'g'))::BIGINT AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
    len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter_words,
    len(list_filter(w, lambda x: regexp_matches(x, '^\p{{Lu}}{{2,}}($|[^\p{{Lu}}\p{{Ll}}])'))) AS n_capital_words,
    len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\t\r]*$'))) AS n_ellipsis_lines
  FROM d LEFT JOIN rep USING (doc_id)
), v AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR n_symbols > 0.2 * n_words OR word_chars < 2 * n_words OR word_chars > 12 * n_words
    OR n_dup_lines > 0.5 * len(l) OR n_letter_words < 0.6 * n_words OR n_capital_words > 0.5 * n_words
    OR n_ellipsis_lines > 0.3 * len(l)) AS kept
FROM v
"""

COLLOCATIONS = rf"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS p, unnest(regexp_split_to_array({_ASCII_LOWER}, '[.,;:!?\x0A-\x0D]')) AS t FROM documents
), w AS (SELECT lang, regexp_extract_all(t, '[^\x20\x09]+') AS w FROM piece),
total AS (SELECT lang, sum(len(w)) AS n FROM w GROUP BY lang),
part AS (
  SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS s, any_value(w[i : i + m - 1]) AS ws, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, range(1, 6) t(m) WHERE len(w) >= m)
  GROUP BY ALL HAVING count(*) >= 100
), cut AS (
  SELECT c.lang, c.s, c.m, c.f AS a, k, x.f AS l, y.f AS r, n,
    (1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM part WHERE m > 1) c
  JOIN total USING (lang)
  JOIN part x ON x.lang = c.lang AND x.s = array_to_string(c.ws[1 : k], ' ')
  JOIN part y ON y.lang = c.lang AND y.s = array_to_string(c.ws[k + 1 :], ' ')
), least AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, k) = 1),
inner_ AS (
  SELECT DISTINCT lang, array_to_string(ws[i : i + j - 1], ' ') AS s, f
  FROM (SELECT *, unnest(range(1, m - j + 2)) AS i FROM part, range(2, 5) t(j) WHERE j < m)
), kept AS (
  SELECT * FROM least c WHERE NOT EXISTS (SELECT 1 FROM inner_ i WHERE i.lang = c.lang AND i.s = c.s AND 100 * i.f >= 100 * c.a)
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(s)) AS rank, s AS phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM kept QUALIFY rank <= 2000
"""
