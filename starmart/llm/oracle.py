"""DuckDB SQL for the queries that SQL can express; the tables are views."""

from __future__ import annotations

SQL: dict[str, str] = {}

SQL["op7_url_filters"] = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
split AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM parts),
rules(verdict, rhost, rpath) AS (VALUES
  ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, host, path, rhost || rpath AS rule, verdict FROM split LEFT JOIN rules
  ON ends_with('.' || host, '.' || rhost) AND starts_with(path, rpath)),
best AS (
  SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM fits GROUP BY ALL)
SELECT page_id, host, path, rule, coalesce(verdict, CASE
  WHEN regexp_matches(host, '^(ads?[.-]|adult-|(free-bets|adserver|track|tracker|tracking|doubleclick)\.)') THEN 'block'
  WHEN regexp_matches('.' || host, '\.(casino|porn)\.|\.xxx$') THEN 'block'
  WHEN regexp_matches(path, '/(ads|adserver|banner.|banners|tracking|casino|wp-admin|cgi-bin)/|\.(exe|apk|zip|torrent)$') THEN 'block'
  ELSE 'allow' END) AS verdict
FROM best
"""

SQL["op10_decontamination"] = r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
grams AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda i: array_to_string(w[i : i + least(10, len(w)) - 1], ' '))) AS gram
  FROM items WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM grams),
starts AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, sizes WHERE len(w) >= n),
found AS (SELECT s.doc_id, s.i, s.n, g.item_id FROM starts s JOIN grams g ON g.n = s.n AND g.gram = array_to_string(s.w[s.i : s.i + s.n - 1], ' ')),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS names FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(names), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(names, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

SQL["op1_secret_scans"] = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
raw AS (SELECT doc_id, t, rank, kind FROM docs, (VALUES (1, 'assign'), (2, 'access'), (3, 'hex'), (4, 'run')) AS k(rank, kind)),
lists AS (
  SELECT doc_id, rank, kind,
    CASE kind WHEN 'assign' THEN regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 0)
      WHEN 'access' THEN regexp_extract_all(t, 'AKIA[A-Z0-9]+', 0) WHEN 'hex' THEN regexp_extract_all(t, '[0-9a-f]+', 0)
      ELSE regexp_extract_all(t, '[A-Za-z0-9+/_=-]+', 0) END AS m,
    CASE kind WHEN 'assign' THEN regexp_extract_all(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 1) END AS v,
    CASE kind WHEN 'assign' THEN string_split_regex(t, '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?[A-Za-z0-9+/_.=-]+')
      WHEN 'access' THEN string_split_regex(t, 'AKIA[A-Z0-9]+') WHEN 'hex' THEN string_split_regex(t, '[0-9a-f]+')
      ELSE string_split_regex(t, '[A-Za-z0-9+/_=-]+') END AS g
  FROM raw),
flat AS (
  SELECT doc_id, rank, kind, unnest(range(1, len(m) + 1)) AS i, unnest(m) AS m, unnest(coalesce(v, m)) AS v, unnest(g[1 : len(m)]) AS g FROM lists WHERE len(m) > 0),
placed AS (
  SELECT doc_id, rank, kind, m, v, CAST(sum(length(g) + length(m)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS BIGINT) AS e FROM flat),
base AS (
  SELECT doc_id, rank, kind, e - length(m) AS s, e FROM placed
  WHERE length(v) >= CASE kind WHEN 'assign' THEN 12 WHEN 'access' THEN 18 WHEN 'hex' THEN 16 ELSE 2147483647 END),
runs AS (
  SELECT doc_id, m, e - length(m) AS pos, regexp_full_match(m, '[0-9a-fA-F]+') AS ishex FROM placed
  WHERE kind = 'run' AND length(m) >= 20 AND regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Za-z]')
    AND NOT regexp_matches(m, '^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$') AND NOT regexp_matches(m, '^[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9-]*)?$')
    AND NOT regexp_matches(m, '(?i)example|placeholder|changeme|dummy|sample|your[-_]') AND NOT regexp_matches(m, '^(sha1|sha224|sha256|sha384|sha512)-')
    AND NOT regexp_matches(m, '^/?([A-Za-z]+/)+[A-Za-z0-9_-]{1,19}$')),
moved AS (SELECT doc_id, pos, m, ishex, unnest(range(0, length(m) - 19)) AS k FROM runs),
hot AS (
  SELECT doc_id, CASE WHEN ishex THEN 4 ELSE 5 END AS rank, CASE WHEN ishex THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind, min(pos + k) AS s, max(pos + k + 20) AS e
  FROM moved WHERE list_aggregate(string_split(substr(m, k + 1, 20), ''), 'entropy') >= CASE WHEN ishex THEN 2.95 ELSE 3.85 END GROUP BY doc_id, pos, ishex),
added AS (SELECT * FROM hot h WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.doc_id = h.doc_id AND b.s <= h.s AND b.e >= h.e)),
spans AS (SELECT *, true AS isbase FROM base UNION ALL SELECT *, false FROM added),
told AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    count(*) FILTER (NOT isbase) AS n_entropy,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (isbase) AS b, string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS a
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(n_entropy, 0) AS n_entropy,
  sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans
FROM docs LEFT JOIN told USING (doc_id)
"""

SQL["op3_warc"] = r"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
named AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS winner,
    array_to_string(list_transform(range(0, 32), lambda i:
      substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((CAST('0x' || substr(hex, (i // 4) * 5 + 1, 5) AS BIGINT) >> (5 * (3 - i % 4))) & 31 AS INTEGER) + 1, 1)), '') AS payload_digest
  FROM p)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id IS NOT DISTINCT FROM winner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM winner THEN NULL ELSE winner END AS refers_to
FROM named
"""

SQL["op2_substring_dedup"] = r"""
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words WHERE len(w) >= 50),
hashed AS (SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS h FROM starts),
gone AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS least FROM hashed) WHERE least < doc_id),
covered AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM gone),
lists AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM covered GROUP BY doc_id),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words SEMI JOIN lists USING (doc_id)),
left_over AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept FROM flat ANTI JOIN covered USING (doc_id, p) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(l.n, 0) AS BIGINT) AS n_removed,
       sha256(CASE WHEN l.n IS NULL THEN array_to_string(w.w, ' ') ELSE coalesce(k.kept, '') END) AS kept_sha256
FROM words w LEFT JOIN lists l USING (doc_id) LEFT JOIN left_over k USING (doc_id)
"""

SQL["op9_jaccard_join"] = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
grams AS (SELECT doc_id, unnest(s) AS g FROM sets),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 5 * c >= 4 * (a.n + b.n - c)),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT s.doc_id, least(s.doc_id, coalesce(r.m, s.doc_id)) AS class_id, CAST(coalesce(k.n, 0) AS BIGINT) AS n_links, CAST(s.n AS BIGINT) AS n_shingles
FROM sizes s LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) r ON r.x = s.doc_id LEFT JOIN (SELECT x, count(*) AS n FROM links GROUP BY x) k ON k.x = s.doc_id
"""

SQL["op13_line_dedup"] = r"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
flat AS (SELECT doc_id, unnest(l) AS line, unnest(range(len(l))) AS i FROM split),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM flat),
shared AS (SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
judged AS (SELECT f.doc_id, f.i, f.line, coalesce(f.doc_id < s.last, false) AS gone FROM keyed f LEFT JOIN shared s USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

#: CRC-32 of a list of bytes {bytes} as a BIGINT; needs the one-row table `crc_table`.
_CRC = "xor(4294967295, list_reduce(list_prepend(4294967295, {bytes}), lambda a, b: xor(a >> 8, crcs[CAST(xor(a, b) & 255 AS INTEGER) + 1])))"
_CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce(list_prepend(CAST(i AS BIGINT), [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(3988292384, a >> 1) ELSE a >> 1 END) ORDER BY i) AS crcs
  FROM range(256) AS r(i))"""
_ID_CRC = _CRC.format(bytes="list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))")
_WORD_CRC = _CRC.format(bytes="list_transform(range(0, length(hex(word)) // 2), lambda i: CAST('0x' || substr(hex(word), 2 * i + 1, 2) AS BIGINT))")

SQL["op11_resampling"] = rf"""
WITH {_CRC_TABLE},
lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+') AS w FROM documents),
flat AS (SELECT doc_id, unnest(w) AS word FROM lists),
goal AS (
  SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')) AS word FROM benchmark),
counted AS (SELECT word, sum(c) AS c, sum(g) AS g FROM (SELECT word, 1 AS c, 0 AS g FROM flat UNION ALL SELECT word, 0, 1 FROM goal) GROUP BY word),
bucketed AS (SELECT word, c, g, {_WORD_CRC} % 10000 AS bucket FROM counted, crc_table),
totals AS (SELECT sum(c) AS all_c, sum(g) AS all_g FROM bucketed),
gain AS (
  SELECT bucket, floor(1000 * ln(CAST(sum(g) + 1 AS DOUBLE) * CAST(any_value(all_c) + 10000 AS DOUBLE) / (CAST(sum(c) + 1 AS DOUBLE) * CAST(any_value(all_g) + 10000 AS DOUBLE)))) AS gain
  FROM bucketed, totals GROUP BY bucket),
weights AS (SELECT doc_id, count(*) AS n, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight FROM flat JOIN bucketed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scores AS (
  SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(CAST('0x' || substr(sha256('2024:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) AS DOUBLE) + 0.5) / 4294967296))) AS BIGINT) AS score
  FROM lists LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS many FROM scores WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= 10 * many // 100 THEN r END AS rank FROM scores LEFT JOIN ranked USING (doc_id)
"""

SQL["op12_periodic_runs"] = rf"""
WITH {_CRC_TABLE},
split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_ID_CRC} AS h FROM documents, crc_table),
sized AS (SELECT doc_id, w, h, CAST(len(w) AS BIGINT) AS n, (h // 10) % nullif(len(w), 0) AS a FROM split),
shaped AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM sized),
texts AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0 THEN list_transform(range(0, n), lambda i: w[CASE WHEN i < a THEN i ELSE a + (i - a) % p END + 1]) ELSE w END AS w FROM shaped),
ends AS (SELECT doc_id, w, unnest(range(6, n + 1)) AS i FROM texts),
grams AS (SELECT doc_id, i, md5(array_to_string(w[i - 5 : i], ' ')) AS g FROM ends),
pairs AS (SELECT x.doc_id, x.i, x.i - y.i AS q FROM grams x JOIN grams y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i < x.i),
dealt AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM pairs),
diagonals AS (SELECT doc_id, q, min(i) - 6 - q AS start, max(i) - min(i) + 6 + q AS length FROM dealt GROUP BY doc_id, q, part),
runs AS (SELECT doc_id, start, length, min(q) AS period FROM diagonals WHERE length >= greatest(12, 2 * q) GROUP BY doc_id, start, length),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS listed,
    first({{'start': start, 'length': length, 'period': period}} ORDER BY length DESC, start, period) AS best FROM runs GROUP BY doc_id),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS k FROM runs),
flat AS (SELECT doc_id, unnest(w) AS word, unnest(range(0, n)) AS k FROM texts SEMI JOIN told USING (doc_id)),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS kept FROM flat ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, best.start AS start, best.length AS length, best.period AS period, CAST(floor(1000 * best.length / best.period) AS BIGINT) AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(CASE WHEN n_runs IS NULL THEN array_to_string(w, ' ') ELSE coalesce(kept, '') END) AS collapsed_sha256
FROM texts t LEFT JOIN told USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
