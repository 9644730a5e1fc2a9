"""DuckDB SQL with the rows of the registered queries, where SQL can express them."""

OP8 = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents),
per AS (SELECT source, sum(size)::BIGINT AS s FROM sized GROUP BY source),
wt AS (SELECT *, CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3
                 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::BIGINT AS w FROM per),
lev AS (
  SELECT *, 3 * sum(s) OVER () - 4 * coalesce(sum(s) OVER (ORDER BY s / w, source ASC NULLS LAST
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS num,
         2 * sum(w) OVER (ORDER BY s / w, source ASC NULLS LAST
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS den,
         row_number() OVER (ORDER BY s / w, source ASC NULLS LAST) AS pos
  FROM wt),
cut AS (SELECT num, den, pos FROM lev WHERE num * w <= 2 * s * den ORDER BY pos LIMIT 1),
tgt AS (
  SELECT lev.source, lev.s, CASE WHEN cut.pos IS NULL OR lev.pos < cut.pos THEN (2 * lev.s)::DOUBLE
         ELSE least((cut.num * lev.w)::DOUBLE / cut.den::DOUBLE, (2 * lev.s)::DOUBLE) END AS target
  FROM lev LEFT JOIN cut ON true),
run AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY k, doc_id, size
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS p FROM sized),
j AS (SELECT run.*, tgt.s, tgt.target, floor(tgt.target)::BIGINT AS t,
             CASE WHEN tgt.s > 0 THEN floor(tgt.target)::BIGINT // tgt.s ELSE 0 END AS e
      FROM run JOIN tgt ON run.source IS NOT DISTINCT FROM tgt.source)
SELECT doc_id, size, s AS source_size, target,
       (e * size + greatest(0, least(size, t - e * s - p)))::BIGINT AS taken
FROM j
"""

OP1 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
win AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS k
        FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM d WHERE len(ws) >= 13)),
first AS (SELECT k, min(doc_id) AS m FROM win GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM win JOIN first USING (k) WHERE m < doc_id),
words AS (SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
kept AS (SELECT doc_id, string_agg(w, ' ' ORDER BY p) AS t, count(*) AS n
         FROM words LEFT JOIN gone USING (doc_id, p) WHERE gone.p IS NULL GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS p FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.*, r.top IS NOT NULL AND k.doc_id < r.top AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

OP10 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
        ELSE list_distinct(list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' '))) END AS g FROM d),
e AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id
         GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
edge AS (SELECT a, b FROM pair UNION ALL SELECT b, a FROM pair),
reach(a, b) AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, least(s.doc_id, coalesce(min(reach.b), s.doc_id)) AS component_id
FROM s LEFT JOIN reach ON reach.a = s.doc_id GROUP BY s.doc_id, len(s.g)
"""

OP11 = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS s
      FROM r a JOIN r b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT a, b, s FROM p WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
neg AS (SELECT pos.a, pos.b, pos.s, p.b AS n, p.s AS ns,
               row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY p.s DESC, p.b) AS rank
        FROM pos JOIN p ON p.a = pos.a AND NOT p.same AND 30 * pos.s <= 100 * p.s AND 100 * p.s <= 90 * pos.s)
SELECT a AS anchor_id, b AS positive_id, rank::INTEGER AS rank, n AS negative_id, s AS positive_score, ns AS negative_score
FROM neg WHERE rank <= 10
"""

OP13 = r"""
WITH RECURSIVE steps(i, k, c) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
dw AS (SELECT doc_id, unnest(ws) AS w FROM d),
sw AS (SELECT w, count(*) AS n FROM dw GROUP BY w),
tw AS (SELECT w, count(*) AS n FROM b GROUP BY w),
word AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM sw UNION SELECT w FROM tw)),
crc AS (SELECT w, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(h) // 2), lambda i:
                (16 * (instr('0123456789ABCDEF', h[2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2]) - 1)::BIGINT)),
              lambda acc, x: xor(acc >> 8, t[(xor(acc, x) & 255) + 1])), 4294967295) % 10000 AS bucket FROM word, tab),
tot AS (SELECT bucket, coalesce(sum(sw.n), 0) AS s, coalesce(sum(tw.n), 0) AS t
        FROM crc LEFT JOIN sw USING (w) LEFT JOIN tw USING (w) GROUP BY bucket),
al AS (SELECT sum(s)::DOUBLE AS sa, sum(t)::DOUBLE AS ta FROM tot),
gain AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sa + 10000) / ((s + 1)::DOUBLE * (ta + 10000))))::BIGINT AS g FROM tot, al),
wt AS (SELECT doc_id, sum(g)::BIGINT AS weight FROM dw JOIN crc USING (w) JOIN gain USING (bucket) GROUP BY doc_id),
h AS (SELECT doc_id, len(ws)::BIGINT AS n_features,
             ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h FROM d),
sc AS (SELECT h.doc_id, n_features, coalesce(weight, 0) AS weight,
              coalesce(weight, 0) + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
       FROM h LEFT JOIN wt USING (doc_id)),
o AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS r,
             count(*) OVER (PARTITION BY n_features >= 20) AS n FROM sc)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND r <= 10 * n // 100 THEN r END AS rank FROM o
"""

ORACLE = {"op1_substring_dedup": OP1, "op4_line_dedup": OP4, "op8_mixing": OP8, "op10_jaccard_join": OP10,
          "op11_hard_negatives": OP11, "op13_resampling": OP13}
