"""SQL for the operators that it can express; the others are tested by brute force.

The engine has no XXH64, byte-pair encoding, model fitting or file writing, so
operators 2, 3, 4, 7, 8, 9, 10 and the pipeline have none, nor has packing
(12), which has many right results.
"""

from __future__ import annotations

_QUALITY = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls
  FROM d
),
windows AS (
  SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
  FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)
),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, k) > 1),
covered AS (
  SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS j FROM twice) GROUP BY r
),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words,
    coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
    (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(ls)::BIGINT AS n_lines, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered USING (r)
),
f AS (
  SELECT *, (n_words < 50) AS f0, (100 * n_repeat_words > 50 * n_words) AS f1,
    (5 * n_symbols > n_words) AS f2, (10 * n_dup_lines > 3 * n_lines) AS f3,
    (word_chars < 2 * n_words) AS f4, (word_chars > 25 * n_words) AS f5
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words,
  (f0::INT + 2 * f1::INT + 4 * f2::INT + 8 * f3::INT + 16 * f4::INT + 32 * f5::INT)::BIGINT AS failures,
  (f0 OR f1) AS base_failed, NOT (f0 OR f1 OR f2 OR f3 OR f4 OR f5) AS kept
FROM f
"""

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_KINDS = [
    ("assign", _ASSIGN, 2, 12),
    ("access", "AKIA[A-Z0-9]+", 0, 18),
    ("hex", "[0-9a-f]+", 0, 16),
    ("pem", "-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0),
    ("hub", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("chat", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("cloud", "AIza[A-Za-z0-9_-]{35,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
]


def _matches(number: int, kind: str, pattern: str, group: int, least: int) -> str:
    return f"""
  SELECT r, {number} AS number, '{kind}' AS kind, ended - size AS start, ended AS stop
  FROM (
    SELECT r, size, held, sum(gap + size) OVER (PARTITION BY r ORDER BY i) AS ended
    FROM (
      SELECT r, unnest(range(1, len(whole) + 1)) AS i, unnest(list_transform(whole, lambda x: length(x))) AS size,
        unnest(list_transform(held, lambda x: length(x))) AS held,
        unnest(list_transform(gaps[: len(whole)], lambda x: length(x))) AS gap
      FROM (
        SELECT r, regexp_extract_all(t, '{pattern}', 0) AS whole, regexp_extract_all(t, '{pattern}', {group}) AS held,
          string_split_regex(t, '{pattern}') AS gaps
        FROM d
      ) WHERE len(whole) > 0
    )
  ) WHERE held >= {least}"""


_SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_matches(i, *kind) for i, kind in enumerate(_KINDS))}),
g AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number)
      FILTER (number < 3) AS base,
    string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, number) AS spans
  FROM s GROUP BY r
)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
  coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (r)
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_CONTAMINATION = rf"""
WITH items AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS ws FROM benchmark),
sized AS (SELECT item, ws, least(13, len(ws)) AS size FROM items WHERE len(ws) > 0),
windows AS (
  SELECT DISTINCT item, size, array_to_string(ws[i : i + size - 1], ' ') AS k
  FROM (SELECT item, ws, size, unnest(range(1, len(ws) - size + 2)) AS i FROM sized)
),
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
found AS (
  SELECT r, i, size, item
  FROM (
    SELECT r, i, p.size, array_to_string(ws[i : i + p.size - 1], ' ') AS k
    FROM (
      SELECT r, ws, s.size, unnest(range(1, len(ws) - s.size + 2)) AS i
      FROM d, (SELECT DISTINCT size FROM windows) s WHERE len(ws) >= s.size
    ) p
  ) JOIN windows USING (size, k)
),
hits AS (
  SELECT r, count(DISTINCT j) AS n
  FROM (SELECT r, unnest(range(i, i + size)) AS j FROM (SELECT DISTINCT r, i, size FROM found)) GROUP BY r
),
owners AS (
  SELECT r, count(item) AS n, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit,
  coalesce(owners.n, 0)::BIGINT AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN owners USING (r)
"""

# The checksum's table: CTE crc, one row, one list of 256.
_CRC_TABLE = """
crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab
  FROM (SELECT unnest(range(256))::BIGINT AS i)
)"""


def _crc32(text: str) -> str:
    """crc32 of an ASCII text, where ``tab`` is in scope."""
    return f"""xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)),
      lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])))"""


_RUNS = rf"""
WITH {_CRC_TABLE},
d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
    CASE WHEN doc_id IS NULL THEN 1 ELSE {_crc32("doc_id::VARCHAR")} END AS h
  FROM documents, crc
),
e AS (SELECT *, len(ws) AS n, h // 10 AS g FROM d),
f AS (SELECT *, CASE WHEN n > 0 THEN g % n ELSE 0 END AS a FROM e),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM f),
x AS (
  SELECT r, doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws
  FROM p
),
w AS (SELECT r, unnest(range(n)) AS i, unnest(ws) AS word FROM x),
same AS (
  SELECT a.r, b.i - a.i AS q, a.i, a.i - row_number() OVER (PARTITION BY a.r, b.i - a.i ORDER BY a.i) AS island
  FROM w AS a JOIN w AS b ON a.r = b.r AND a.word = b.word AND a.i < b.i
),
stretches AS (
  SELECT r, q, min(i) AS s, max(i) + 1 + q AS e FROM same GROUP BY r, q, island
  HAVING count(*) + q >= greatest(12, 2 * q)
),
runs AS (SELECT r, s, e, min(q) AS q FROM stretches GROUP BY r, s, e),
kept AS (
  SELECT w.r, w.i, w.word FROM w
  WHERE NOT EXISTS (SELECT 1 FROM runs WHERE runs.r = w.r AND w.i >= runs.s + runs.q AND w.i < runs.e)
),
t AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS body FROM kept GROUP BY r),
u AS (
  SELECT r, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
    arg_max((s, e - s, q), (e - s, -s, -q)) AS best
  FROM runs GROUP BY r
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best[1]::BIGINT AS start, best[2]::BIGINT AS length,
  best[3]::BIGINT AS period, (1000 * best[2] // best[3])::BIGINT AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
FROM x LEFT JOIN u USING (r) LEFT JOIN t USING (r)
"""

# What came last: 0 nothing, 1 system, 2 user, 3 assistant.
_REPAIR = rf"""
WITH RECURSIVE {_CRC_TABLE},
c AS (SELECT row_number() OVER () AS r, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
d AS (
  SELECT r, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(t.conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS fault
  FROM conversations AS t JOIN c ON t.conv_id IS NOT DISTINCT FROM c.conv_id, crc
),
e AS (
  SELECT r, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
    CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fault = 0 THEN [] WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS again
  FROM d
),
f AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY turn NULLS FIRST, role, text, again) AS i,
    row_number() OVER (PARTITION BY r, role, text ORDER BY turn NULLS FIRST, again) AS copy,
    left(role, 1) AS initial, right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS ending
  FROM e
),
g AS (
  SELECT *, ending = '' AS blank, ending <> '' AND copy > 1 AS duplicate,
    ending <> '' AND copy = 1 AND ending NOT IN ('.', '!', '?') AS truncated,
    i > 1 AND lag(initial) OVER (PARTITION BY r ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM f
),
ins(p, q, cost, audit, body) AS (
  VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
    (0, 2, 5, 'I', chr(10) || 'user:'), (1, 2, 5, 'I', chr(10) || 'user:'), (3, 2, 5, 'I', chr(10) || 'user:'),
    (2, 3, 5, 'I', chr(10) || 'assistant:'),
    (0, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'),
    (1, 3, 10, 'II', chr(10) || 'user:' || chr(10) || 'assistant:')
),
steps(initial, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
edits AS (
  SELECT r, i, unnest([0, 1, 2, 3]) AS p, unnest([0, 1, 2, 3]) AS q, 2 AS cost, 'D' AS audit, '' AS body FROM g
  UNION ALL
  SELECT r, i, p, q, 1 + 5 * truncated::INT, 'R', chr(10) || CASE q WHEN 2 THEN 'user:' ELSE 'assistant:' END || text
  FROM g, steps WHERE steps.initial <> 's' AND NOT blank AND NOT duplicate
  UNION ALL
  SELECT r, i, p, q, 5 * truncated::INT, 'K', chr(10) || role || ':' || text
  FROM g JOIN steps USING (initial) WHERE NOT blank AND NOT duplicate
),
path AS (
  SELECT r, 0::BIGINT AS i, 0 AS q, (0, '', '') AS best FROM c
  UNION ALL
  SELECT path.r, edits.i, edits.q,
    min((best[1] + ins.cost + edits.cost, best[2] || ins.audit || edits.audit, best[3] || ins.body || edits.body))
  FROM path JOIN ins ON ins.p = path.q JOIN edits ON edits.r = path.r AND edits.i = path.i + 1 AND edits.p = ins.q
  GROUP BY path.r, edits.i, edits.q
),
n AS (
  SELECT r, count(*) AS n,
    least(coalesce(max(turn)::HUGEINT - min(turn) + 1 - count(DISTINCT turn), 0), 9223372036854775807) AS gaps,
    count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
    count(*) FILTER (truncated) AS truncated, count(*) FILTER (illegal) AS illegal
  FROM g GROUP BY r
),
done AS (
  SELECT path.r, min((best[1] + cost, best[2] || audit, best[3] || body)) AS best
  FROM path LEFT JOIN n USING (r) JOIN ins ON ins.p = path.q
  WHERE path.i = coalesce(n.n, 0) AND (ins.q = 0 OR ins.q = 3) GROUP BY path.r
)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
  coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, best[1]::BIGINT AS cost, best[2] AS audit,
  sha256(substr(best[3], 2)) AS repaired_sha256
FROM c LEFT JOIN n USING (r) JOIN done USING (r)
"""

SQL: dict[str, str] = {
    "op1_quality_rules": _QUALITY,
    "op5_secret_scan": _SECRETS,
    "op6_decontaminate": _CONTAMINATION,
    "op11_periodic_runs": _RUNS,
    "op13_conversation_repair": _REPAIR,
}
