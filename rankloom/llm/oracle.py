"""SQL, for DuckDB, of the queries that SQL can express."""

from __future__ import annotations

# Lower-cased words of letters, digits and everything beyond ASCII.
PLAIN_WORDS = r"regexp_extract_all(translate(coalesce({0}, ''), '{1}', '{2}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def plain_words(column: str) -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return PLAIN_WORDS.format(column, upper, upper.lower())


OP9 = f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {plain_words('text')} AS ws FROM benchmark
  WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item, list_slice(ws, i, i + least(10, len(ws)) - 1) AS words
  FROM (SELECT item, ws, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i
        FROM item WHERE len(ws) > 0)),
doc AS (SELECT row_number() OVER () AS k, doc_id, {plain_words('text')} AS ws FROM documents),
place AS (SELECT k, ws, unnest(range(1, len(ws) + 1)) AS i FROM doc WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT len(words) AS n FROM win),
spot AS (
  SELECT p.k, p.i, s.n, w.item
  FROM place p CROSS JOIN sizes s
  JOIN win w ON w.words = list_slice(p.ws, p.i, p.i + s.n - 1)
  WHERE p.i + s.n - 1 <= len(p.ws)),
hits AS (
  SELECT k, count(DISTINCT j) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS j FROM spot) GROUP BY k),
items AS (
  SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT k, item FROM spot) GROUP BY k)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit,
       coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN hits h USING (k) LEFT JOIN items t USING (k)
"""


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANK_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+')"

OP2 = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {BLANK_WORDS} AS ws FROM documents),
item AS (
  SELECT DISTINCT doc_id, list_slice(ws, i, i + least(5, len(ws)) - 1) AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM doc WHERE len(ws) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM item GROUP BY doc_id),
met AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM item a JOIN item b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM met JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * met.n >= 75 * (x.n + y.n - met.n)),
reach AS (SELECT a AS doc_id, a AS other FROM link UNION SELECT r.doc_id, l.b FROM reach r JOIN link l ON l.a = r.other),
low AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(c.component_id, d.doc_id) AS kept
FROM doc d LEFT JOIN size s USING (doc_id) LEFT JOIN low c USING (doc_id)
"""

OP8 = f"""
WITH doc AS (SELECT doc_id, {BLANK_WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(list_slice(ws, i, i + 50), ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 49)) AS i FROM doc WHERE len(ws) > 50)),
met AS (SELECT h FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
hit AS (SELECT doc_id, i FROM win SEMI JOIN met USING (h)),
begun AS (SELECT *, CAST(coalesce(i > lag(i) OVER w + 51, true) AS INTEGER) AS fresh
          FROM hit WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
stretch AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS s FROM begun)
SELECT doc_id, CAST(min(i) - 1 AS INTEGER) AS "start", CAST(max(i) + 50 AS INTEGER) AS "end",
       CAST(max(i) - min(i) + 51 AS INTEGER) AS n_words
FROM stretch GROUP BY doc_id, s
"""

OP11 = f"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS p FROM documents),
line AS (SELECT lang, regexp_extract_all(p, '[^\\x20\\x09]+') AS ws FROM piece),
words AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM line GROUP BY lang),
sizes AS (SELECT unnest(range(1, 5)) AS k),
gram AS (
  SELECT lang, k, list_slice(ws, i, i + k - 1) AS g
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM line CROSS JOIN sizes WHERE len(ws) >= k)),
f AS (SELECT lang, k, g, count(*) AS n FROM gram GROUP BY ALL HAVING count(*) >= 30),
cand AS (SELECT * FROM f WHERE k > 1),
cut AS (
  SELECT c.lang, c.g, c.n AS a, x.n AS l, y.n AS r, s.k AS cut,
         CAST(2000000::HUGEINT * c.n // (x.n + y.n) AS BIGINT) AS score
  FROM cand c JOIN sizes s ON s.k < c.k
  JOIN f x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, s.k)
  JOIN f y ON y.lang = c.lang AND y.g = list_slice(c.g, s.k + 1, c.k)),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
inner_ AS (
  SELECT lang, list_slice(g, i, i + s - 1) AS g, n
  FROM (SELECT c.lang, c.g, c.n, z.k AS s, unnest(range(1, c.k - z.k + 2)) AS i FROM cand c JOIN sizes z ON z.k > 1 AND z.k < c.k)),
around AS (SELECT lang, g, max(n) AS n FROM inner_ GROUP BY ALL),
kept AS (
  SELECT w.*, array_to_string(w.g, ' ') AS phrase FROM low w LEFT JOIN around o USING (lang, g)
  WHERE o.n IS NULL OR 100 * o.n < 80 * w.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN words USING (lang) QUALIFY rank <= 2000
"""

OP13 = f"""
WITH doc AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat_ws('|', CAST(doc_id AS VARCHAR), md5(coalesce(text, '')))) AS digest FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         1.0::DOUBLE + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS w FROM doc GROUP BY source),
ranked AS (
  SELECT *, row_number() OVER o AS k, sum(3 * source_size) OVER o AS given, sum(w) OVER () - sum(w) OVER o AS shares,
         sum(source_size) OVER () AS total
  FROM src WINDOW o AS (ORDER BY source_size / w, source ROWS UNBOUNDED PRECEDING)),
-- the least number of full sources whose rest leaves none beyond its limit
tried AS (
  SELECT 0 AS k, CAST(any_value(total) AS DOUBLE) AS rest, sum(w) AS shares FROM ranked
  UNION ALL SELECT k, CAST(total - given AS DOUBLE), shares FROM ranked WHERE shares > 0),
chosen AS (
  SELECT k, rest, shares FROM tried t
  WHERE NOT EXISTS (SELECT 1 FROM ranked r WHERE r.k > t.k AND t.rest * r.w / t.shares > 3 * r.source_size)
  ORDER BY k LIMIT 1),
target AS (
  SELECT r.source, r.source_size, r.w,
         CASE WHEN r.k <= c.k THEN CAST(3 * r.source_size AS DOUBLE) ELSE c.rest * r.w / c.shares END AS target
  FROM ranked r CROSS JOIN chosen c),
placed AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.w, CAST(round(t.target) AS BIGINT) AS quota,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
  FROM doc d JOIN target t ON t.source IS NOT DISTINCT FROM d.source),
given AS (
  SELECT *, greatest(0, least(size, quota - s)) AS p0, greatest(0, least(size, quota - source_size - s)) AS p1,
         greatest(0, least(size, quota - 2 * source_size - s)) AS p2,
         s / greatest(quota, 1)::DOUBLE * w AS area, CASE w WHEN 1 THEN 0.5 WHEN 2 THEN 0.0 ELSE -0.5 END AS slope FROM placed)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target, CAST(p0 + p1 + p2 AS BIGINT) AS taken,
       CAST((p0 > 0)::INT + (p1 > 0)::INT + (p2 > 0)::INT AS BIGINT) AS n_passes,
       CASE WHEN p0 = 0 THEN NULL WHEN area <= 0 THEN 0.0 ELSE least(1.0, area * 2.0 / (
         w * (1 - slope) + sqrt(greatest(0.0, (w * (1 - slope)) * (w * (1 - slope)) + area * (2 * (w * (1 + slope) - w * (1 - slope))))))) END AS position
FROM given
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_neardup": OP2, "op8_suffixes": OP8, "op9_decontaminate": OP9, "op11_phrases": OP11, "op13_curriculum": OP13}
