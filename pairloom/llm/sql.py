"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

#: Windows of 13 words of every item (shorter items whole), found in documents by hash joins on whole window texts.
OP10 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[s + 1 : s + 13], ' ') AS t
  FROM b, unnest(range(0, greatest(len(w) - 13, 0) + 1)) u(s) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
docwin AS (
  SELECT doc_id, s, n, array_to_string(w[s + 1 : s + n], ' ') AS t
  FROM w, sizes, unnest(range(0, len(w) - n + 1)) u(s) WHERE len(w) >= n),
hit AS (SELECT DISTINCT d.doc_id, d.s, d.n, win.item_id FROM docwin d JOIN win ON win.t = d.t AND win.n = d.n),
cov AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) u(p) GROUP BY 1),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM hit) GROUP BY 1)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w.w) AS contaminated
FROM w LEFT JOIN cov USING (doc_id) LEFT JOIN its USING (doc_id)
"""

#: SHA-1 in base 32, 5 bits at a time from the hex digest.
OP7 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first_id, sha1(h) AS x FROM p),
bits AS (SELECT page_id, strlen(h)::BIGINT AS payload_bytes, first_id,
  list_transform(range(0, 40), lambda i: strpos('0123456789abcdef', substr(x, (i + 1)::INT, 1)) - 1) AS nib FROM d)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((
    (nib[(5 * j // 4 + 1)::INT] * 16 + CASE WHEN 5 * j // 4 + 2 <= 40 THEN nib[(5 * j // 4 + 2)::INT] ELSE 0 END)
    // (1 << (3 - (5 * j) % 4)::INT)) % 32)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM bits
"""

OP6 = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, md5(array_to_string(w[s + 1 : s + 13], ' ')) AS t FROM w, unnest(range(0, len(w) - 12)) u(s) WHERE len(w) >= 13),
first AS (SELECT t, min(doc_id) AS f FROM win GROUP BY 1),
gone AS (SELECT DISTINCT doc_id, p FROM win JOIN first USING (t), unnest(range(s, s + 13)) u(p) WHERE f < doc_id),
kept AS (SELECT w.doc_id, p, w.w[p + 1] AS x FROM w, unnest(range(0, len(w.w))) u(p) ANTI JOIN gone ON gone.doc_id = w.doc_id AND gone.p = u.p)
SELECT w.doc_id, len(w.w)::BIGINT AS n_words, (len(w.w) - coalesce(k.n, 0))::BIGINT AS n_removed, sha256(coalesce(k.x, '')) AS kept_sha256
FROM w LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY p) AS x FROM kept GROUP BY 1) k USING (doc_id)
"""

#: All pairs that share a shingle, then the smallest doc_id over all paths of links.
OP8 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1 : i + 5], ' ') AS t FROM w, unnest(range(0, greatest(len(w) - 4, 1))) u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.d WHERE r.c < e.y)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM documents d JOIN r ON r.d = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

#: All pairs of a label by cosine in double precision.
OP5 = """
WITH RECURSIVE v AS (SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.x, b.x) >= 0.93),
r AS (SELECT vec_id AS d, vec_id AS c FROM v UNION SELECT l.y, r.c FROM r JOIN l ON l.x = r.d WHERE r.c < l.y)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.x = v.vec_id)::BIGINT AS n_links, min(r.c) AS component_id, v.vec_id = min(r.c) AS kept
FROM v JOIN r ON r.d = v.vec_id GROUP BY v.vec_id
"""

#: Every order of the filters (a row of ``orders``) over counts by part and failed filters.
OP12 = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
f AS (SELECT doc_id, part, len(w) < 100 AS a, 100 * len(list_distinct(w)) < 80 * len(w) AS b,
             100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
             coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e FROM w),
l AS (SELECT doc_id, max(coalesce(quality = 1, false)::INT) AS good, max(coalesce(toxic = 1, false)::INT) AS toxic FROM labels GROUP BY 1),
cells AS (SELECT part, (CASE WHEN a THEN 'A' ELSE '' END || CASE WHEN b THEN 'B' ELSE '' END || CASE WHEN c THEN 'C' ELSE '' END
                        || CASE WHEN d THEN 'D' ELSE '' END || CASE WHEN e THEN 'E' ELSE '' END) AS fails,
                 count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
          FROM f LEFT JOIN l USING (doc_id) GROUP BY ALL),
x AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (SELECT p.x || q.x || r.x || s.x || t.x AS o FROM x p, x q, x r, x s, x t WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5),
steps AS (SELECT o, step, substr(o, step::INT, 1) AS own, substr(o, 1, (step - 1)::INT) AS before FROM orders, range(1, 6) g(step)),
r AS (SELECT part, o AS filter_order, step::INT AS step, own,
        sum(n) FILTER (NOT regexp_matches(fails, '[' || before || own || ']')) AS kept,
        sum(n) FILTER (contains(fails, own) AND (before = '' OR NOT regexp_matches(fails, '[' || before || '.]'))) AS removed,
        sum(n) FILTER (contains(fails, own) AND before <> '' AND regexp_matches(fails, '[' || before || '.]')) AS redundant,
        sum(n) FILTER (fails = own) AS unique_fails,
        sum(good) FILTER (contains(fails, own) AND (before = '' OR NOT regexp_matches(fails, '[' || before || '.]'))) AS good_lost,
        sum(toxic) FILTER (contains(fails, own) AND (before = '' OR NOT regexp_matches(fails, '[' || before || '.]'))) AS toxic_lost
      FROM cells, steps GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       sum(coalesce(removed, 0)) OVER (PARTITION BY part, own)::BIGINT AS shapley
FROM r
"""

#: All scores of every query; sums of products of whole numbers are exact in doubles here.
OP13 = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.x) = len(c.x) WHERE q.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

ORACLE_SQL: dict[str, str] = {"op5_embedding_near_dups": OP5, "op6_substring_dedup": OP6, "op8_token_group_jaccard": OP8,
                              "op7_content_addressed_warc": OP7, "op10_decontamination": OP10,
                              "op12_filter_audit": OP12, "op13_exact_top_k": OP13}
