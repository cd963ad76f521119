"""DuckDB SQL for the corpus queries that SQL can express over whole tables."""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP3 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOW}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS k
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS k
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, i, dw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.k = bw.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM hit GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN items ON d.doc_id = items.doc_id"""

OP8 = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOW}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, k FROM (SELECT doc_id, array_to_string(w[i : i + 4], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0))),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL),
link AS (SELECT a, b FROM shared JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * i >= 75 * (x.n + y.n - i)),
e AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach(x, y) AS (SELECT DISTINCT a, a FROM e UNION SELECT reach.x, e.b FROM reach JOIN e ON reach.y = e.a),
comp AS (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN comp ON d.doc_id = comp.doc_id"""

OP9 = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS k FROM (SELECT doc_id, h, unnest(range(0, greatest(CAST(length(h) / 2 AS BIGINT) - 49, 0))) AS i FROM d)),
f AS (SELECT k, min(doc_id) AS first FROM w GROUP BY k HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 50)) AS p FROM w JOIN f ON w.k = f.k WHERE doc_id > first)),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE prev IS DISTINCT FROM p - 1) AS n_spans FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS prev FROM gone) GROUP BY 1),
kept AS (SELECT b.doc_id, string_agg(substr(h, 2 * b.p + 1, 2), '' ORDER BY b.p) AS h FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT))) AS p FROM d WHERE doc_id IN (SELECT doc_id FROM runs)) b ANTI JOIN gone g ON b.doc_id = g.doc_id AND b.p = g.p GROUP BY 1)
SELECT d.doc_id, CAST(length(d.h) / 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(CASE WHEN r.doc_id IS NULL THEN d.h ELSE coalesce(k.h, '') END)) AS kept_sha256
FROM d LEFT JOIN runs r ON d.doc_id = r.doc_id LEFT JOIN kept k ON d.doc_id = k.doc_id"""

OP10 = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
k AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM k) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM late),
n AS (SELECT doc_id, count(*) AS n_removed FROM gone GROUP BY 1),
kept AS (SELECT b.doc_id, string_agg(w[b.p], ' ' ORDER BY b.p) AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS p FROM d) b ANTI JOIN gone g ON b.doc_id = g.doc_id AND b.p = g.p GROUP BY 1)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN kept ON d.doc_id = kept.doc_id"""

OP13 = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
first AS (SELECT t, min(doc_id) AS least FROM d GROUP BY 1),
told AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY 1),
f AS (SELECT part, CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT) + 4 * CAST(100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 5 * length(d.t) AS INT)
             + 8 * CAST(regexp_matches(d.t, '[#$%&*|]') AS INT) + 16 * CAST(coalesce(least < d.doc_id, false) AS INT) AS mask, coalesce(good, false) AS good, coalesce(bad, false) AS bad
      FROM d JOIN first ON d.t = first.t LEFT JOIN told ON d.doc_id = told.doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad FROM f GROUP BY 1, 2),
l AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS l(x, bit)),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits FROM l a, l b, l c, l d, l e WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1 : step - 1]), 0) AS before FROM o, (SELECT CAST(unnest(range(1, 6)) AS INT) AS step)),
r AS (SELECT part, filter_order, step, s.bit,
             coalesce(sum(n) FILTER (WHERE (mask & (bit | CAST(before AS INT))) = 0), 0) AS kept,
             coalesce(sum(n) FILTER (WHERE (mask & bit) > 0 AND (mask & CAST(before AS INT)) = 0), 0) AS removed,
             coalesce(sum(n) FILTER (WHERE (mask & bit) > 0 AND (mask & CAST(before AS INT)) > 0), 0) AS redundant,
             coalesce(sum(n) FILTER (WHERE mask = bit), 0) AS unique_fails,
             coalesce(sum(good) FILTER (WHERE (mask & bit) > 0 AND (mask & CAST(before AS INT)) = 0), 0) AS good_lost,
             coalesce(sum(bad) FILTER (WHERE (mask & bit) > 0 AND (mask & CAST(before AS INT)) = 0), 0) AS toxic_lost
      FROM c, s GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r"""
