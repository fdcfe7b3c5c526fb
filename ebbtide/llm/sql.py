"""DuckDB SQL for the registered queries that SQL can express, over whole tables."""

SQL: dict[str, str] = {}

_WORDS = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op1_decontaminate"] = rf"""
WITH docs AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
items AS (SELECT item_id, {_WORDS.format("text")} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, len(w) AS size, w AS g FROM items WHERE len(w) BETWEEN 1 AND 9
  UNION SELECT DISTINCT item_id, 10, w[i:i + 9] FROM (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS i FROM items WHERE len(w) >= 10)
),
sizes AS (SELECT DISTINCT size FROM windows),
grams AS (SELECT doc_id, size, i, w[i:i + size - 1] AS g FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
found AS (SELECT DISTINCT doc_id, i, x.size, item_id FROM grams x JOIN windows y ON x.size = y.size AND x.g = y.g),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
owners AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

_BASE32 = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
# Five hexadecimal digits are twenty bits, which are four letters of base 32.
_LETTERS = "||".join(f"substr({_BASE32}, CAST((CAST('0x' || substr(h, {5 * k + 1}, 5) AS BIGINT) >> {15 - 5 * j}) & 31 AS INT) + 1, 1)" for k in range(8) for j in range(4))

SQL["op7_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS top FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, {_LETTERS} AS payload_digest,
       CASE WHEN top IS NULL OR page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top IS NULL OR page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM t
"""

SQL["op5_chat_formatting"] = """
WITH t AS (
  SELECT conv_id, turn, role, text, conv_id || ':' || turn AS id, coalesce(role IN ('assistant', 'tool'), false) AS is_result,
         CASE role WHEN 'system' THEN 'configure' WHEN 'user' THEN 'reply' END AS name,
         CASE WHEN coalesce(role IN ('assistant', 'tool'), false) THEN conv_id || ':' || (turn - 1) END AS call_id
  FROM conversations),
turns AS (SELECT DISTINCT conv_id, turn FROM t WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
islands AS (SELECT conv_id, turn, turn - row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS island FROM turns),
depths AS (SELECT conv_id, turn, turn - min(turn) OVER (PARTITION BY conv_id, island) AS depth, turn > 0 AND turn = min(turn) OVER (PARTITION BY conv_id, island) AS dangling FROM islands),
calls AS (SELECT id, arg_min(name, (name, role, text)) AS name FROM t WHERE NOT is_result AND id IS NOT NULL GROUP BY id),
answers AS (SELECT r.call_id, count(*) AS n FROM t r JOIN calls c ON r.call_id = c.id GROUP BY 1)
SELECT t.conv_id, t.turn, CASE WHEN is_result THEN 'result' ELSE 'call' END AS kind, coalesce(depth, 0) AS depth, t.call_id, coalesce(n, 0) AS n_results,
  CASE WHEN dangling THEN 'dangling' WHEN NOT is_result AND n IS NULL THEN 'open' WHEN is_result AND c.id IS NULL THEN 'unanswerable' ELSE 'linked' END AS status,
  CASE WHEN is_result THEN '' WHEN t.name IS NULL THEN 'unknown tool ' WHEN text IS NULL THEN 'missing ' || CASE t.name WHEN 'reply' THEN 'prompt' ELSE 'instructions' END ELSE '' END AS errors,
  CASE WHEN is_result THEN '{"call_id":' || coalesce(to_json(t.call_id)::VARCHAR, 'null') || ',"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"id":' || coalesce(to_json(t.id)::VARCHAR, 'null') || ',"name":' || coalesce(to_json(c.name)::VARCHAR, 'null') || ',"type":"result"}'
       ELSE '{"arguments":{' || CASE WHEN text IS NULL THEN '' ELSE CASE WHEN t.role = 'system' THEN '"instructions":' ELSE '"prompt":' END || to_json(text)::VARCHAR || ',' END || '"turn":' || t.turn || '},"id":' || coalesce(to_json(t.id)::VARCHAR, 'null') || ',"name":' || coalesce(to_json(t.name)::VARCHAR, 'null') || ',"type":"call"}' END AS json
FROM t LEFT JOIN depths d ON d.conv_id = t.conv_id AND d.turn = t.turn LEFT JOIN calls c ON c.id = t.call_id LEFT JOIN answers a ON a.call_id = t.id AND NOT is_result
"""

SQL["op13_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
langs AS (SELECT lang, count(*) AS v, sum(total) AS whole FROM kept GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, sum(n) AS n_all FROM own GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(o.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(o.n, 0) + 2)) // (coalesce(s.n_all, 0) + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.total + 2)) // (l.whole + 2 * l.v) AS q
  FROM groups g JOIN langs l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN own o ON o.lang = g.lang AND o.source = g.source AND o.term = k.term
  LEFT JOIN sizes s ON s.lang = g.lang AND s.source = g.source),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
         FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
          FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // (p + q) AS value FROM dense WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS k
  FROM (SELECT 'pair' AS part, * FROM pairs UNION ALL SELECT 'term', * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(k AS INT) AS rank FROM ranked WHERE part = 'pair' OR k <= 10
"""
