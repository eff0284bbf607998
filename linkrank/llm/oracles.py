"""SQL for the queries that SQL can express."""

from __future__ import annotations

# Base32 of a SHA-1: five hexadecimal digits make four letters.
OP1 = r"""WITH p AS (SELECT page_id, url, coalesce(html, '') AS x FROM pages),
h AS (SELECT *, strlen(x) AS n, sha1(x) AS hex, max(page_id) OVER (PARTITION BY x) AS original FROM p)
SELECT page_id, n::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(hex, (5 * (i // 4) + 1)::INTEGER, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN page_id = original THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> original THEN original END AS refers_to,
  CASE WHEN coalesce(url, '') = '' THEN 'about:blank' ELSE url END AS target_uri
FROM h"""

OP4 = r"""WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e, label FROM embeddings),
near AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(id, node) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.id, n.b FROM reach r JOIN near n ON n.a = r.node),
low AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id),
deg AS (SELECT a, count(*) AS n FROM near GROUP BY a)
SELECT id AS vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, id = component_id AS kept
FROM low LEFT JOIN deg ON deg.a = low.id"""

OP10 = r"""WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents),
s AS (SELECT DISTINCT r, unnest(CASE WHEN len(words) = 0 THEN []::VARCHAR[] WHEN len(words) < 3 THEN [array_to_string(words, ' ')]
  ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2]) END) AS g FROM w WHERE doc_id IS NOT NULL),
n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
near AS (SELECT DISTINCT p.doc_id AS a, q.doc_id AS b FROM (SELECT a.r AS a, b.r AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.r <> b.r
  GROUP BY a.r, b.r) c JOIN n x ON x.r = c.a JOIN n y ON y.r = c.b JOIN w p ON p.r = c.a JOIN w q ON q.r = c.b WHERE 100 * k >= 90 * (x.n + y.n - k)),
reach(id, node) AS (SELECT DISTINCT doc_id, doc_id FROM w WHERE doc_id IS NOT NULL UNION SELECT r.id, e.b FROM reach r JOIN near e ON e.a = r.node),
low AS (SELECT id, min(node) AS component_id FROM reach GROUP BY id)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, low.component_id FROM w LEFT JOIN n ON n.r = w.r LEFT JOIN low ON low.id = w.doc_id"""

OP11 = r"""WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
g AS (SELECT x, max(doc_id) AS keep_id, count(*) AS n FROM t GROUP BY x)
SELECT doc_id, keep_id, n::BIGINT AS group_size, doc_id = keep_id AS kept, sha256(x) AS text_sha256 FROM t JOIN g USING (x)"""

OP12 = r"""WITH t AS (SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id
  ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS donor,
  xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)), lambda crc, b:
    list_reduce(list_concat([xor(crc, b)], range(8)), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END))), 4294967295::BIGINT) % 9 AS h
  FROM t GROUP BY conv_id),
c AS (SELECT o.conv_id, o.h, o.donor, least(o.h, coalesce(d.own, 0)) AS used, least(o.h, coalesce(d.own, 0)) + greatest(o.own - o.h, 0) AS length
  FROM o LEFT JOIN o d ON d.conv_id = o.donor),
b AS (SELECT c.conv_id, t.pos AS depth, c.length, t.r, t.x FROM c JOIN t ON t.conv_id = c.donor AND t.pos <= c.h
  UNION ALL SELECT c.conv_id, t.pos - c.h + c.used, c.length, t.r, t.x FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
p AS (SELECT conv_id, depth, length, strlen(x) AS bytes, string_agg(sha256(strlen(r)::VARCHAR || ':' || r || x), ',') OVER (PARTITION BY conv_id ORDER BY depth) AS k FROM b
  UNION ALL SELECT conv_id, 0, length, 0, '' FROM c),
q AS (SELECT *, lag(k) OVER (PARTITION BY conv_id ORDER BY depth) AS up FROM p),
n AS (SELECT k, any_value(up) AS up, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n, any_value(bytes) AS bytes,
  coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = length), '') AS ends FROM q GROUP BY k),
kids AS (SELECT up AS k, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY up),
s AS (SELECT a.k, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((n.n - 1) * n.bytes) AS saved FROM n JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  LEFT JOIN kids ON kids.k = n.k GROUP BY a.k)
SELECT n.conv_id, n.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(kids.n_children, 0)::BIGINT AS n_children,
  s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n LEFT JOIN n u ON u.k = n.up LEFT JOIN kids ON kids.k = n.k JOIN s ON s.k = n.k"""

OP13 = r"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
  list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id AS other, list_inner_product(a.e, b.e)::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
SELECT p.anchor_id, p.other AS positive_id, (row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other))::INTEGER AS rank,
  n.other AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) <= 3"""

ORACLES: dict[str, str] = {
    "op1_warc_roundtrip": OP1,
    "op4_lattice_duplicates": OP4,
    "op10_jaccard_join": OP10,
    "op11_exact_copies": OP11,
    "op12_conversation_trie": OP12,
    "op13_hard_negatives": OP13,
}
