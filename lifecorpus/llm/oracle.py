"""SQL for the queries that SQL can express over whole tables."""
from __future__ import annotations

SQL = {
    "op2_mix_sources": """
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents),
h AS (SELECT doc_id, source, size,
             ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || t), 1, 15))::BIGINT AS h FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM h GROUP BY source),
w AS (SELECT source, source_size, 2 * source_size AS most,
             CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM s),
l AS (SELECT *, most::DOUBLE / weight AS full_at, row_number() OVER (ORDER BY most::DOUBLE / weight, source IS NULL, source) AS k FROM w),
v AS (SELECT a.*, ((SELECT sum(source_size) FROM w)::DOUBLE * 1.5::DOUBLE
                   - coalesce((SELECT sum(b.most) FROM l b WHERE b.k < a.k), 0)::DOUBLE)
                  / (SELECT sum(b.weight) FROM l b WHERE b.k >= a.k)::DOUBLE AS level FROM l a),
e AS (SELECT level FROM v WHERE full_at > level ORDER BY k LIMIT 1),
t AS (SELECT source, source_size,
             least(coalesce(weight * (SELECT level FROM e), most::DOUBLE), most::DOUBLE) AS target FROM v),
c AS (SELECT *, CASE WHEN source_size = 0 THEN 1 ELSE floor(target / source_size) END AS whole FROM t),
r AS (SELECT h.doc_id, h.size, c.source_size, c.target, c.whole, target - whole * source_size AS rest,
             sum(h.size) OVER (PARTITION BY h.source ORDER BY h.h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(h.size) OVER (PARTITION BY h.source, h.h) AS here
      FROM h JOIN c ON h.source IS NOT DISTINCT FROM c.source)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       (size * (whole + CASE WHEN rest > 0 AND (upto <= rest OR (upto - here <= rest AND 2 * (rest - (upto - here)) > here))
                             THEN 1 ELSE 0 END))::BIGINT AS taken
FROM r""",
    "op3_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS s
           FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, s AS text_sha256
FROM d WINDOW g AS (PARTITION BY s)""",
    "op4_revisits": r"""
WITH u AS (
  SELECT page_id, regexp_replace(regexp_replace(trim(url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare,
         sha256(coalesce(html, '')) AS digest FROM pages),
p AS (
  SELECT page_id, digest, '"' || substr(digest, 1, 16) || '"' AS tag, page_id * 100 + 1700000000 AS time,
         regexp_replace(regexp_replace(lower(regexp_extract(bare, '^([^/?]*)', 1)), '^(?:www|m)[.]', ''), ':(?:80|443)$', '')
         || regexp_replace(regexp_extract(regexp_replace(bare, '^[^/?]*', ''), '^([^?]*)', 1), '/+$', '') AS path,
         array_to_string(list_sort(list_filter(string_split(regexp_extract(regexp_replace(bare, '^[^/?]*', ''), '[?](.*)$', 1), '&'),
           lambda x: x <> '' AND NOT regexp_matches(x, '^(?:utm_[a-z]+|ref|fbclid|gclid)='))), '&') AS q FROM u),
c AS (SELECT page_id, digest, tag, time, path || CASE WHEN q <> '' THEN '?' || q ELSE '' END AS url FROM p),
v AS (SELECT page_id, url, time + CASE WHEN page_id % 11 = 0 THEN -40 ELSE 40 END AS time,
             CASE WHEN page_id % 7 = 0 THEN '"other"' ELSE tag END AS tag,
             CASE WHEN page_id % 7 = 0 THEN '"other"' ELSE 'W/' || tag END AS shown FROM c),
j AS (SELECT v.*, f.page_id AS old, f.tag AS old_tag
      FROM v ASOF LEFT JOIN c f ON v.url = f.url AND v.time >= f.time),
s AS (SELECT *, CASE WHEN old IS NULL THEN 'no_response'
                     WHEN old % 5 <> 0 THEN CASE WHEN old_tag = tag THEN 'resolved' ELSE 'validator_mismatch' END
                     WHEN old = page_id THEN 'resolved' ELSE 'validator_mismatch' END AS status FROM j)
SELECT page_id * 2 + 1 AS record_id, url AS canonical_url, time,
       CASE WHEN status = 'resolved' THEN old * 2 END AS refers_to, status,
       CASE WHEN status = 'resolved' THEN 'content-type=text/html;date=e' || page_id || ';etag=' || shown || ';expires=x' || page_id
            || ';last-modified=m' || old END AS headers
FROM s""",
    "op7_chat_format": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')),
l AS (SELECT *, length('<|im_start|>') + length(role) + 1 + length(text)
                + len(regexp_extract_all(text, '<\\*\|')) + length('<|im_end|>') + 1 AS n FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n)::BIGINT AS formatted_chars
FROM l GROUP BY conv_id""",
    "op9_exact_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.e, x.e)::BIGINT AS score
      FROM v q JOIN v x ON q.vec_id % 50 = 0 AND x.vec_id <> q.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INT AS rank, vec_id, score FROM r WHERE rank <= 5""",
    "op11_turn_repair": r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (  -- CRC-32, bit by bit
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT)),
                lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
                                         lambda a, z: xor(a // 2, 3988292384 * (a % 2)))), 4294967295) % 20 AS fate FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE fate <> 0),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM d),
r AS (
  SELECT *, left(role, 1) AS a, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN seen > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault FROM n),
ways(state, price, word, lines, after) AS (  -- grammar states: 0 nothing, 1 after s, 2 after u, 3 after a
  SELECT s, 0, '', []::VARCHAR[], s FROM range(4) x(s)
  UNION ALL SELECT s, 5, 'I', [CASE WHEN s = 2 THEN 'assistant:' ELSE 'user:' END], CASE WHEN s = 2 THEN 3 ELSE 2 END FROM range(4) x(s)
  UNION ALL SELECT s, 10, 'II', CASE WHEN s = 2 THEN ['assistant:', 'user:'] ELSE ['user:', 'assistant:'] END,
                   CASE WHEN s = 2 THEN 2 ELSE 3 END FROM range(4) x(s)),
edits(state, letter, cost, after, a) AS (
  SELECT s, 'D', 2, s, NULL::VARCHAR FROM range(4) x(s)
  UNION ALL SELECT s, 'R', 1, CASE WHEN s = 2 THEN 3 ELSE 2 END, NULL FROM range(4) x(s)
  UNION ALL VALUES (0, 'K', 0, 1, 's'), (0, 'K', 0, 2, 'u'), (1, 'K', 0, 2, 'u'), (3, 'K', 0, 2, 'u'), (2, 'K', 0, 3, 'a')),
p(conv_id, i, state, cost, audit, lines) AS (
  SELECT DISTINCT conv_id, 0::BIGINT, 0, 0, '', []::VARCHAR[] FROM r
  UNION ALL
  SELECT conv_id, i, state, cost, audit, lines FROM (
    SELECT r.conv_id, r.i, e.after AS state,
           p.cost + w.price + e.cost + CASE WHEN r.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END AS cost,
           p.audit || w.word || e.letter AS audit,
           list_concat(p.lines, w.lines, CASE e.letter WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [r.role || ':' || r.text]
                       ELSE [CASE WHEN w.after = 2 THEN 'assistant:' ELSE 'user:' END || r.text] END) AS lines,
           row_number() OVER (PARTITION BY r.conv_id, e.after ORDER BY
             p.cost + w.price + e.cost + CASE WHEN r.fault = 't' AND e.letter <> 'D' THEN 5 ELSE 0 END,
             p.audit || w.word || e.letter) AS place
    FROM p JOIN r ON r.conv_id IS NOT DISTINCT FROM p.conv_id AND r.i = p.i + 1
    JOIN ways w ON w.state = p.state
    JOIN edits e ON e.state = w.after AND (e.a IS NULL OR e.a = r.a) AND (e.letter = 'D' OR r.fault NOT IN ('b', 'd'))) q
  WHERE place = 1),
f AS (
  SELECT p.conv_id, p.cost + w.price AS cost, p.audit || w.word AS audit, list_concat(p.lines, w.lines) AS lines,
         row_number() OVER (PARTITION BY p.conv_id ORDER BY p.cost + w.price, p.audit || w.word) AS place
  FROM p JOIN (SELECT conv_id, max(i) AS i FROM r GROUP BY conv_id) z ON p.conv_id IS NOT DISTINCT FROM z.conv_id AND p.i = z.i
  JOIN ways w ON w.state = p.state WHERE w.after IN (0, 3)),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
         count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || a NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
LEFT JOIN f ON c.conv_id IS NOT DISTINCT FROM f.conv_id AND f.place = 1""",
    "op12_substring_dedup": r"""
WITH d AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
v AS (SELECT k, doc_id, i, sha256(array_to_string(ws[i:i + 49], ' ')) AS words
      FROM (SELECT k, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d) x),
m AS (SELECT words, min(doc_id) AS least FROM v GROUP BY words),
g AS (SELECT DISTINCT k, j FROM (
        SELECT k, unnest(range(i, i + 50)) AS j FROM v JOIN m USING (words) WHERE doc_id > least OR (doc_id IS NULL AND least IS NOT NULL)) x),
u AS (SELECT k, unnest(range(1, len(ws) + 1)) AS j, unnest(ws) AS word FROM d),
s AS (SELECT u.k, count(g.j) AS gone, string_agg(u.word, ' ' ORDER BY u.j) FILTER (g.j IS NULL) AS kept
      FROM u LEFT JOIN g ON u.k = g.k AND u.j = g.j GROUP BY u.k)
SELECT d.doc_id, len(ws) AS n_words, coalesce(gone, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN s ON d.k = s.k""",
    "op13_lexical_search": r"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
d AS (SELECT *, len(ts) AS n FROM t WHERE len(ts) > 0),
z AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM d),
f AS (SELECT k, term, count(*) AS tf FROM (SELECT k, unnest(ts) AS term FROM d) x GROUP BY k, term),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
w AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM f GROUP BY term) x, z),
s AS (SELECT item_id, k, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN w USING (term) JOIN d USING (k), z GROUP BY item_id, k),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
      FROM s JOIN d USING (k) WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM r WHERE rank <= 50""",
}
