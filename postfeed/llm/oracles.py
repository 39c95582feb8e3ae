"""SQL for the operators that SQL can express."""

from __future__ import annotations

OP7 = """
WITH norm AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), groups AS (
  SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM norm GROUP BY t
)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM norm n JOIN groups g ON n.t = g.t
"""


OP3 = """
WITH RECURSIVE valid AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, sqrt(list_dot_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS size
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM valid a JOIN valid b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.95
), reach AS (
  SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT reach.vec_id, links.b FROM reach JOIN links ON reach.r = links.a
), roots AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.component_id, e.vec_id = r.component_id AS kept
FROM embeddings e JOIN roots r ON r.vec_id = e.vec_id LEFT JOIN counts c ON c.a = e.vec_id
"""

# Shingles are compared as text; a word holds no blank, so joined words are equal only if the words are.
OP5 = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\x09-\\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0) t
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
sets AS (SELECT doc_id, md5(string_agg(s, chr(10) ORDER BY s)) AS whole FROM shingles GROUP BY doc_id),
classes AS (SELECT whole, min(doc_id) AS node FROM sets GROUP BY whole),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id
  WHERE a.doc_id IN (SELECT node FROM classes) AND b.doc_id IN (SELECT node FROM classes) GROUP BY ALL
), linked AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)
), links AS (SELECT a, b FROM linked UNION ALL SELECT b, a FROM linked),
reach AS (SELECT node, node AS r FROM classes UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.r = links.a),
roots AS (SELECT node, min(r) AS component_id FROM reach GROUP BY node)
SELECT w.doc_id, coalesce(z.n, 0) AS n_shingles, coalesce(r.component_id, w.doc_id) AS component_id, w.doc_id = coalesce(r.component_id, w.doc_id) AS kept
FROM words w LEFT JOIN sizes z ON z.doc_id = w.doc_id LEFT JOIN sets s ON s.doc_id = w.doc_id
LEFT JOIN classes c ON c.whole = s.whole LEFT JOIN roots r ON r.node = c.node
"""

# Every step of every order against every mask of the part.
OP12 = """
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^ \\x09-\\x0D]+') AS w FROM documents
), firsts AS (SELECT t, min(doc_id) AS first FROM docs GROUP BY t), masked AS (
  SELECT d.doc_id, d.part, CAST(len(w) < 50 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INTEGER)
    + 4 * CAST(100 * len(regexp_extract_all(d.t, '[A-Z]')) > 5 * length(d.t) AS INTEGER)
    + 8 * CAST(regexp_matches(d.t, '[#$%&*|]') AS INTEGER) + 16 * CAST(d.doc_id > f.first AS INTEGER) AS mask
  FROM docs d JOIN firsts f ON f.t = d.t
), masks AS (
  SELECT m.part, m.mask, count(*) AS n, count(*) FILTER (WHERE l.quality = 1) AS good, count(*) FILTER (WHERE l.toxic = 1) AS toxic
  FROM masked m LEFT JOIN labels l ON l.doc_id = m.doc_id GROUP BY ALL
), letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x, unnest([1, 2, 4, 8, 16]) AS b), perms AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND len(list_distinct([a.b, b.b, c.b, d.b, e.b])) = 5
), steps AS (
  SELECT filter_order, k AS step, bits[k] AS bit, CAST(coalesce(list_sum(bits[1 : k - 1]), 0) AS INTEGER) AS before FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS k) s
), counted AS (
  SELECT m.part, filter_order, step, bit, sum(n) FILTER (WHERE mask & (before | bit) = 0) AS kept, sum(n) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS removed,
    sum(n) FILTER (WHERE mask & before <> 0 AND mask & bit <> 0) AS redundant, sum(n) FILTER (WHERE mask = bit) AS unique_fails,
    sum(good) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS good_lost, sum(toxic) FILTER (WHERE mask & before = 0 AND mask & bit <> 0) AS toxic_lost
  FROM steps, masks m GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
  CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails, CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost,
  CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost, CAST(coalesce(sum(removed) OVER (PARTITION BY part, bit), 0) AS BIGINT) AS shapley
FROM counted
"""

# Runs of three as lists; a path from a leaf takes the rest of its run on every level, first in its source, then above it.
# crc32 by a table of bytes: its last step inverts the bits, so the sum is even where the last bit is still set.
OP13 = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i)) t
), told AS (
  SELECT *, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])) & 1 = 1 AS tampered FROM documents, crc
), framed AS (
  SELECT doc_id, source, tampered, text, concat(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
    coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-')) AS head,
    CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS changed FROM told
), leaves AS (
  SELECT doc_id, source, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) AS again FROM framed
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n,
    dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g FROM leaves
), tree(g, lvl, idx, n, d) AS (
  SELECT g, 0, idx, n, leaf FROM numbered UNION ALL
  SELECT g, lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM tree WHERE n > 1 GROUP BY g, lvl, idx // 3, n
), runs AS (SELECT g, lvl, idx // 3 AS run, list(d ORDER BY idx) AS ds FROM tree WHERE n > 1 GROUP BY ALL),
subroots AS (SELECT g, d FROM tree WHERE n = 1),
top(lvl, idx, n, d) AS (
  SELECT 0, g, (SELECT count(*) FROM subroots), d FROM subroots UNION ALL
  SELECT lvl + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lvl, idx // 3, n
), top_runs AS (SELECT lvl, idx // 3 AS run, list(d ORDER BY idx) AS ds FROM top WHERE n > 1 GROUP BY ALL),
path(g, leaf_idx, lvl, idx, n, acc, sibs) AS (
  SELECT g, idx, 0, idx, n, again, '' FROM numbered UNION ALL
  SELECT p.g, p.leaf_idx, p.lvl + 1, p.idx // 3, (p.n + 2) // 3, sha256(array_to_string(ds[1 : p.idx % 3], '') || acc || array_to_string(ds[p.idx % 3 + 2 :], '')),
    sibs || array_to_string(ds[1 : p.idx % 3], '') || array_to_string(ds[p.idx % 3 + 2 :], '')
  FROM path p JOIN runs r ON r.g = p.g AND r.lvl = p.lvl AND r.run = p.idx // 3 WHERE p.n > 1
), over(g, leaf_idx, lvl, idx, n, acc, sibs) AS (
  SELECT g, leaf_idx, 0, g, (SELECT count(*) FROM subroots), acc, sibs FROM path WHERE n = 1 UNION ALL
  SELECT p.g, p.leaf_idx, p.lvl + 1, p.idx // 3, (p.n + 2) // 3, sha256(array_to_string(ds[1 : p.idx % 3], '') || acc || array_to_string(ds[p.idx % 3 + 2 :], '')),
    sibs || array_to_string(ds[1 : p.idx % 3], '') || array_to_string(ds[p.idx % 3 + 2 :], '')
  FROM over p JOIN top_runs r ON r.lvl = p.lvl AND r.run = p.idx // 3 WHERE p.n > 1
)
SELECT m.doc_id, m.leaf, s.d AS subroot, (SELECT d FROM top WHERE n = 1) AS root, sha256(o.sibs) AS proof_sha256, o.acc AS folded_root,
  o.acc = (SELECT d FROM top WHERE n = 1) AS verified
FROM numbered m JOIN over o ON o.g = m.g AND o.leaf_idx = m.idx AND o.n = 1 JOIN subroots s ON s.g = m.g
"""

# Five hex digits of the digest are four digits of base 32.
OP11 = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY hex) AS last, array_to_string(list_transform(range(8), lambda i: array_to_string(list_transform([15, 10, 5, 0],
    lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[((CAST('0x' || hex[5 * i + 1 : 5 * i + 5] AS BIGINT) >> s) & 31) + 1]), '')), '') AS payload_digest FROM payloads
)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id < last THEN last END AS refers_to
FROM named
"""


def llm_oracles() -> dict[str, str]:
    return {
        "op3_near_vectors": OP3, "op5_minhash": OP5, "op7_exact_dedup": OP7, "op11_warc": OP11, "op12_filter_audit": OP12, "op13_merkle": OP13,
    }
