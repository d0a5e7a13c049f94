"""DuckDB SQL for the queries that SQL can express."""

ORACLE = {
    "op6_exact": """
WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY body) AS kept, sha256(body) AS text_sha256 FROM t""",
    "op8_urls": r"""
WITH u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
r(verdict, rhost, rpath) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
j AS (
  SELECT *, CASE WHEN (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath) THEN rhost || rpath END AS fit
  FROM u CROSS JOIN r)
SELECT page_id, host, path, arg_max(fit, length(fit)) AS rule, coalesce(arg_max(verdict, length(fit)) FILTER (fit IS NOT NULL), 'allow') AS verdict
FROM j GROUP BY page_id, host, path""",
    "op12_phrases": r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
p AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[ \t]'), lambda w: w <> '') AS ws
  FROM (SELECT lang, unnest(regexp_split_to_array(x, '[.,;:!?\x0A-\x0D]')) AS piece FROM t)),
w AS (
  SELECT lang, w, lead(w, 1) OVER o AS w2, lead(w, 2) OVER o AS w3
  FROM (SELECT lang, piece, unnest(ws) AS w, generate_subscripts(ws, 1) AS place FROM (SELECT lang, ws, row_number() OVER () AS piece FROM p))
  WINDOW o AS (PARTITION BY piece ORDER BY place)),
g AS (
  SELECT lang, 1 AS k, w AS phrase FROM w
  UNION ALL SELECT lang, 2, w || ' ' || w2 FROM w WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, 3, w || ' ' || w2 || ' ' || w3 FROM w WHERE w3 IS NOT NULL),
f AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, s.cut, l.a AS l, r.a AS r, ((1000000::HUGEINT * c.a * c.a) // (l.a::HUGEINT * r.a))::BIGINT AS score
  FROM c JOIN (VALUES (1), (2)) s(cut) ON s.cut < c.k
  JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.ws[1:s.cut], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.ws[s.cut + 1:c.k], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
held AS (
  SELECT lang, phrase, max(a) AS held FROM (
    SELECT lang, array_to_string(ws[1:2], ' ') AS phrase, a FROM c WHERE k = 3
    UNION ALL SELECT lang, array_to_string(ws[2:3], ' '), a FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT b.* FROM best b LEFT JOIN held h USING (lang, phrase) WHERE h.held IS NULL OR 100 * h.held < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
}
