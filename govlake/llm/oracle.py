"""DuckDB counterparts of the queries that SQL can express."""

OP7 = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
  ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
  SELECT host, path, arg_max(h || p, length(h) * 10000 + length(p)) AS rule,
         arg_max(v, length(h) * 10000 + length(p)) AS v
  FROM (SELECT DISTINCT host, path FROM parts) d JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY host, path)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (host, path)
"""

OP10 = r"""
WITH page AS (SELECT page_id AS n, url, sha256(coalesce(html, '')) AS body FROM pages),
canon AS (
  SELECT *, regexp_replace(regexp_replace(url, '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS bare FROM page),
site AS (
  SELECT n, body, sha256(body || '+') AS body2, CASE WHEN url <> '' THEN
    regexp_replace(regexp_replace(lower(regexp_extract(bare, '^[^/?]*')), '^www\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_extract(bare, '^[^/?]*([^?]*)', 1), '/$', '')
    || CASE WHEN len(q) > 0 THEN '?' || array_to_string(q, '&') ELSE '' END END AS site
  FROM (SELECT *, list_sort(list_filter(string_split(regexp_extract(bare, '\?(.*)$', 1), '&'),
                  lambda p: p <> '' AND NOT starts_with(p, 'utm_'))) AS q FROM canon)),
stored AS (
  SELECT site, n * 4 AS record_id, n * 100 AS ts, body AS digest, n FROM site
  WHERE n % 7 <> 3 AND n % 11 <> 3
  UNION ALL SELECT site, n * 4 + 1, n * 100 + 10, body2, n FROM site WHERE n % 2 = 0),
asked AS (
  SELECT n, k, n * 4 + k AS record_id, n * 100 + 10 * k AS ts, site,
         CASE WHEN n % 5 = 0 THEN sha256('outdated') WHEN n % 2 = 0 THEN body2 ELSE body END AS sent
  FROM site, (VALUES (2), (3)) t(k)),
sent AS (
  SELECT *, CASE WHEN k = 2 AND n % 4 = 2 OR k = 3 AND n % 4 >= 1 THEN sent END AS digest,
         CASE WHEN n % 4 = 0 THEN sent END AS tagged, CASE WHEN n % 4 = 1 THEN sent END AS dated FROM asked),
ranked AS (
  SELECT a.*, s.record_id AS refers_to, s.digest AS theirs, s.n AS their_n,
         row_number() OVER (PARTITION BY a.record_id ORDER BY s.ts DESC, s.record_id DESC) AS r
  FROM sent a LEFT JOIN stored s ON a.site = s.site AND s.ts < a.ts),
judged AS (
  SELECT *, CASE WHEN refers_to IS NULL THEN 'no earlier response'
    WHEN coalesce(digest = theirs, left(tagged, 16) = left(theirs, 16), left(dated, 8) = left(theirs, 8)) THEN 'resolved'
    WHEN coalesce(digest, tagged, dated) IS NULL THEN 'no validator' ELSE 'validators differ' END AS outcome
  FROM ranked WHERE r = 1)
SELECT record_id, site AS canonical_url, ts AS captured_at, outcome, refers_to,
       CASE WHEN outcome = 'resolved' THEN theirs END AS payload_digest,
       CASE WHEN outcome = 'resolved' THEN
         'content-type: text/html' || chr(10) || 'date: day ' || n || ' again' || chr(10)
         || 'etag: ' || CASE WHEN tagged IS NOT NULL THEN 'W/"' || left(tagged, 16) ELSE '"' || left(theirs, 16) END || '"' || chr(10)
         || 'last-modified: as of ' || left(coalesce(dated, theirs), 8) END AS headers
FROM judged
"""

OP9 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
escaped AS (
  SELECT *, replace(replace(replace(replace(text, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), '<|', '\<|') AS body,
         replace(replace(replace(replace(replace(role, '\', '\\'), '###', '\###'), '</turn>', '\</turn>'), '<|', '\<|'), ':', '\:') AS head
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ' || head || ': ' || body || ' </turn>' || chr(10)))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

OP11 = r"""
WITH live AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         list_inner_product(a.q, b.q)::BIGINT AS score
  FROM live a JOIN live b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
positive AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY score DESC, other)::INTEGER AS rank,
       other AS negative_id, p.positive_score, score AS negative_score
FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same
  AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY score DESC, other) <= 3
"""

OP13 = r"""
WITH said AS (
  SELECT doc_id, row_number() OVER () AS row, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
spoken AS (SELECT doc_id, row, len(terms) AS n, terms FROM said WHERE len(terms) > 0),
total AS (SELECT count(*) AS docs, sum(n)::BIGINT AS words FROM spoken),
counted AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(terms) AS term FROM spoken) GROUP BY row, term),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
weighed AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counted, total WHERE term IN (SELECT term FROM asked) GROUP BY term),
scored AS (
  SELECT item_id, row, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term) JOIN spoken USING (row), total GROUP BY item_id, row)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored JOIN spoken USING (row) WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

ORACLE = {"op9_chat": OP9, "op7_url_rules": OP7, "op10_revisits": OP10, "op11_hard_negatives": OP11,
          "op13_ranked_search": OP13}
