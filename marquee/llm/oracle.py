"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_CANON = """
  CASE WHEN host <> '' THEN
    regexp_replace(regexp_replace(host, '^(www|m)\\.', ''), ':(80|443)$', '')
    || regexp_replace(regexp_replace(path, '(/index)?\\.html?$', ''), '/+$', '')
    || CASE WHEN len(params) > 0 THEN '?' || array_to_string(list_sort(params), '&') ELSE '' END
  END"""

URL_FILTER = f"""
WITH cut AS (
  SELECT page_id, url, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (
  SELECT page_id, url, {LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         list_filter(string_split(CASE WHEN url LIKE '%?%' THEN regexp_extract(url, '^[^?#]*\\?([^#]*)', 1) ELSE '' END, '&'),
                     lambda x: x <> '' AND NOT regexp_matches(x, '(?i)^(utm_[a-z]+|ref|fbclid|gclid|sessionid|sid)(=|$)')) AS params
  FROM cut),
canon AS (SELECT *, {_CANON} AS canonical FROM parts),
listed AS (SELECT DISTINCT canonical FROM canon WHERE contains(url, 'utm_') AND canonical IS NOT NULL),
rules(action, h, p) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
                               ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fitting AS (
  SELECT c.page_id, c.url, r.action, r.h || r.p AS rule,
         row_number() OVER (PARTITION BY c.page_id, c.url ORDER BY length(r.h || r.p) DESC, length(r.h) DESC, r.action DESC) AS rn
  FROM (SELECT DISTINCT page_id, url, host, path FROM canon) c
  JOIN rules r ON (c.host = r.h OR ends_with(c.host, '.' || r.h)) AND starts_with(c.path, r.p))
SELECT c.page_id, c.host, c.path, f.rule,
       coalesce(f.action, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM canon c LEFT JOIN fitting f ON f.page_id IS NOT DISTINCT FROM c.page_id AND f.url IS NOT DISTINCT FROM c.url AND f.rn = 1
LEFT JOIN listed l ON l.canonical = c.canonical"""

NGRAM_JACCARD = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array({LOWER.format("coalesce(text, '')")}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents),
grams AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS g FROM words),
sizes AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM grams),
flat AS (SELECT doc_id, unnest(g) AS s FROM grams),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM flat a JOIN flat b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, seen) AS (SELECT doc_id, doc_id FROM sizes UNION SELECT r.id, e.b FROM reach r JOIN edges e ON e.a = r.seen)
SELECT s.doc_id, s.n AS n_shingles, m.component_id
FROM sizes s JOIN (SELECT id, min(seen) AS component_id FROM reach GROUP BY id) m ON m.id = s.doc_id"""

DECONTAMINATE = f"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM bw WHERE len(w) > 0)),
occ AS (
  SELECT d.doc_id, d.i, d.n, win.item_id
  FROM (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)) d
  JOIN win ON win.n = d.n AND win.g = d.g),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)"""

#: Base32 of a 40 digit hex string: 32 groups of 5 bits from two neighbouring digits each.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
  1 + ((((instr('0123456789abcdef', substr(h, (5 * i) // 4 + 1, 1)) - 1) * 256
       + (instr('0123456789abcdef', substr(h || '00', (5 * i) // 4 + 2, 1)) - 1) * 16
       + (instr('0123456789abcdef', substr(h || '00', (5 * i) // 4 + 3, 1)) - 1)) // CAST(pow(2, 7 - (5 * i) % 4) AS INTEGER)) % 32)::INTEGER, 1)), '')"""

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
last AS (SELECT h, max(page_id) AS m FROM p GROUP BY h)
SELECT p.page_id, CAST(octet_length(encode(p.html)) AS BIGINT) AS payload_bytes, {_BASE32.replace("(h,", "(p.h,").replace("(h ||", "(p.h ||")} AS payload_digest,
       CASE WHEN p.page_id IS NOT DISTINCT FROM m OR m IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM m THEN m END AS refers_to, true AS digest_ok
FROM p JOIN last ON p.h = last.h"""

CENTROIDS = f"""
WITH kept AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v FROM kept
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= 16),
{"".join(f"""
a{i} AS (
  SELECT vec_id, v, c, d FROM (
    SELECT k.vec_id, k.v, m.c, list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d, k.rowid AS r
    FROM (SELECT *, row_number() OVER () AS rowid FROM kept) k, c{i} m)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1),
s{i + 1} AS (
  SELECT c, list(q ORDER BY p) AS v FROM (
    SELECT c, p, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS q
    FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS p FROM a{i}) GROUP BY c, p) GROUP BY c),
c{i + 1} AS (SELECT c{i}.c, coalesce(s.v, c{i}.v) AS v FROM c{i} LEFT JOIN s{i + 1} s ON s.c = c{i}.c),""" for i in range(3))}
last AS (
  SELECT vec_id, c, d FROM (
    SELECT k.vec_id, m.c, list_sum(list_transform(list_zip(k.v, m.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d, k.rowid AS r
    FROM (SELECT *, row_number() OVER () AS rowid FROM kept) k, c3 m)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)
SELECT vec_id, CAST(l.c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY l.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.v, ',')) AS centroid_sha256
FROM last l JOIN c3 m ON m.c = l.c"""

FILTER_AUDIT = """
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS x FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(x, '[\x20\x09-\x0D]+'), lambda y: y <> '') AS w FROM t),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(w) < 200 THEN 'A' ELSE '' END || CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END
         || CASE WHEN 100 * len(regexp_replace(x, '[^A-Z]+', '', 'g')) > 2 * len(x) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 'E' ELSE '' END AS fails FROM w),
marks AS (SELECT doc_id, bool_or(quality = 1) AS q, bool_or(toxic = 1) AS x FROM labels GROUP BY doc_id),
cells AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (WHERE q) AS good, count(*) FILTER (WHERE x) AS toxic
  FROM f LEFT JOIN marks ON marks.doc_id = f.doc_id GROUP BY part, fails),
letters(l) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
steps AS (SELECT o, CAST(s AS INTEGER) AS step, o[s] AS l, o[1 : s - 1] AS before FROM orders, range(1, 6) r(s)),
told AS (
  SELECT part, o, step, l,
         sum(CASE WHEN translate(fails, before || l, '') = fails THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN contains(fails, l) AND translate(fails, before, '') = fails THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN contains(fails, l) AND translate(fails, before, '') <> fails THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN fails = l THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN contains(fails, l) AND translate(fails, before, '') = fails THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN contains(fails, l) AND translate(fails, before, '') = fails THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY part, o, step, l)
SELECT part, o AS filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley
FROM told"""

ORACLE = {
    "op1_url_filter": URL_FILTER,
    "op4_ngram_jaccard": NGRAM_JACCARD,
    "op5_warc": WARC,
    "op10_decontaminate": DECONTAMINATE,
    "op11_centroids": CENTROIDS,
    "op13_filter_audit": FILTER_AUDIT,
}
