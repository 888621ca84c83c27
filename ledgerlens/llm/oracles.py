"""Independent DuckDB twins of the operators that SQL can express."""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
o AS (
  SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
         sum(24 + length(role)
             + length(regexp_replace(text, '([<\[])(\\*)(\|im_(?:start|end)\|>|/?s>|/?INST\]|</?SYS>>)', '\1\\\2\3', 'g'))) OVER w AS upto
  FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN role = 'assistant' OR pos = n THEN upto ELSE 0 END)::BIGINT AS formatted_chars
FROM o GROUP BY conv_id"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
         AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS good
  FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE a.good AND b.good AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(node, comp) AS (SELECT vec_id, vec_id FROM v UNION SELECT l.b, r.comp FROM r JOIN l ON l.a = r.node WHERE r.comp < l.b),
c AS (SELECT node, min(comp) AS comp FROM r GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = v.vec_id) AS n_links, comp AS component_id, vec_id = comp AS kept
FROM v JOIN c ON node = vec_id"""

MIX = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('0|' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][(rn - 1) % 3 + 1]::DOUBLE AS w, 2.0::DOUBLE * source_size AS cap FROM s),
p AS (SELECT *, 1.5::DOUBLE * sum(source_size) OVER () AS budget, sum(w) OVER () AS wsum,
             coalesce(sum(cap) OVER b, 0) AS cap0, coalesce(sum(w) OVER b, 0) AS w0 FROM w
      WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, cap * (wsum - w0) <= w * (budget - cap0) AS isfull FROM p),
g AS (SELECT *, budget - coalesce(sum(cap) FILTER (isfull) OVER (), 0) AS rest, wsum - coalesce(sum(w) FILTER (isfull) OVER (), 0) AS wrest FROM f),
t AS (SELECT source, source_size, CASE WHEN isfull THEN cap ELSE w * rest / wrest END AS target FROM g),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
k AS (SELECT d.doc_id, d.size, d.key, e.*, floor(target - epochs * source_size)::BIGINT AS room FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY key RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
             sum(size) OVER (PARTITION BY source, key) AS same FROM k)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN upto <= room THEN size WHEN upto - same < room THEN (size * (room - upto + same)) // same ELSE 0 END)::BIGINT AS taken
FROM c"""

TOPK = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""

# crc32 byte by byte over its table; then a forward table of the cheapest edits, row by row, with at most two inserts between rows.
REPAIR = r"""
WITH RECURSIVE tab AS (
  SELECT list(list_reduce(list_concat([i::BIGINT], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS tab FROM range(256) r(i)),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
z AS (SELECT k.*, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(1, length(key) + 1), lambda i: unicode(substr(key, i, 1))::BIGINT)),
                                  lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind FROM k, tab),
d AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
             CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy FROM z WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos,
             regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare, substr(role, 1, 1) AS initial FROM d),
f AS (SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate'
                     WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
             initial || lead(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS two FROM o),
asked(last, role, after) AS (VALUES (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins AS (SELECT last, last AS after, 0 AS cost, '' AS e FROM asked UNION ALL SELECT last, after, 2, 'I' FROM asked
        UNION ALL SELECT a.last, b.after, 4, 'II' FROM asked a JOIN asked b ON a.after = b.last),
steps AS (SELECT i.last, g.gone, g.cut, g.initial, m.after, i.cost + m.cost AS cost, i.e || m.e AS e
          FROM ins i, (SELECT * FROM (VALUES (true), (false)) x(gone), (VALUES (0), (1)) y(cut), (VALUES ('s'), ('u'), ('a'), ('o')) w(initial)) g,
          LATERAL (SELECT i.after, 3 AS cost, 'D' AS e
                   UNION ALL SELECT a.after, 2 + g.cut, 'R' FROM asked a WHERE a.last = i.after AND NOT g.gone
                   UNION ALL SELECT CASE g.initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, g.cut, 'K' FROM asked a
                             WHERE a.last = i.after AND NOT g.gone AND (a.role = g.initial OR (i.after = 0 AND g.initial = 's'))) m(after, cost, e)),
s(conv_id, pos, last, best) AS (
  SELECT conv_id, 0::BIGINT, 0, {'cost': 0::BIGINT, 'e': ''} FROM (SELECT DISTINCT conv_id FROM o)
  UNION ALL
  SELECT s.conv_id, s.pos + 1, t.after, min({'cost': s.best.cost + t.cost, 'e': s.best.e || t.e})
  FROM s JOIN f ON s.conv_id IS NOT DISTINCT FROM f.conv_id AND f.pos = s.pos + 1
       JOIN steps t ON t.last = s.last AND t.gone = (f.fault IN ('blank', 'duplicate')) AND t.cut = (f.fault = 'truncated')::INT
                   AND t.initial = CASE WHEN f.initial IN ('s', 'u', 'a') THEN f.initial ELSE 'o' END
  GROUP BY s.conv_id, s.pos, t.after),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
             count(*) FILTER (two IS NOT NULL AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
b AS (SELECT n.conv_id, min({'cost': s.best.cost + i.cost, 'e': s.best.e || i.e}) AS best
      FROM n JOIN s ON s.conv_id IS NOT DISTINCT FROM n.conv_id AND s.pos = n.n JOIN ins i ON i.last = s.last AND i.after IN (0, 3) GROUP BY n.conv_id),
e AS (SELECT conv_id, spot, substr(best.e, spot, 1) AS e, length(regexp_replace(substr(best.e, 1, spot), 'I', '', 'g')) AS pos
      FROM (SELECT conv_id, best, unnest(range(1, length(best.e) + 1)) AS spot FROM b)),
r AS (SELECT e.conv_id, e.spot, e.e, f.role, f.text, row_number() OVER (PARTITION BY e.conv_id ORDER BY spot) AS nth
      FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.pos = e.pos AND e.e <> 'I' WHERE e.e <> 'D'),
h AS (SELECT *, max(CASE WHEN nth = 1 AND e = 'K' AND role[1] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id) AS sys FROM r),
x AS (SELECT conv_id, sha256(string_agg(CASE WHEN e = 'K' THEN role WHEN (nth - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''),
                                        chr(10) ORDER BY spot)) AS sha FROM h GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.e, '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id
     LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN x ON x.conv_id IS NOT DISTINCT FROM c.conv_id"""

DIVERGENCE = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
o AS (SELECT lang, source, id, unnest(t) AS term FROM d),
k AS (SELECT lang, term, count(*) AS n FROM o GROUP BY ALL HAVING count(DISTINCT id) >= 10),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM k GROUP BY lang),
c AS (SELECT lang, source, term, count(*) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
g AS (SELECT lang, source, coalesce(max(l.v), 0) AS v, coalesce(sum(c.n), 0) + 2 * coalesce(max(l.v), 0) AS size, max(l.n) + 2 * max(l.v) AS lang_size
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN l USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // g.size::HUGEINT AS p,
             1 + (1000000000::HUGEINT * (k.n + 2)) // g.lang_size::HUGEINT AS q
      FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
u AS (SELECT a.lang, a.source, b.source AS item, coalesce(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)), 0) AS value
      FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
w AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(u.value, 0) AS value
      FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN u ON u.lang = a.lang AND u.source = a.source AND u.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM w)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INT AS rank FROM r WHERE part = 'pair' OR rank <= 10"""
