"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from .mih_search import K
from .mixing import ALPHA, BLOCK_CHARS, PARTS

TOP_K = f"""
WITH codes AS (
  SELECT vec_id,
    list_sum(list_transform(embedding[1:32], lambda x, i: CASE WHEN x > 0 THEN 1::BIGINT << (i - 1)::INTEGER ELSE 0 END))::BIGINT AS low,
    list_sum(list_transform(embedding[33:64], lambda x, i: CASE WHEN x > 0 THEN 1::BIGINT << (i - 1)::INTEGER ELSE 0 END))::BIGINT AS high
  FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS neighbor_id, (bit_count(xor(q.low, c.low)) + bit_count(xor(q.high, c.high)))::BIGINT AS distance
  FROM codes q JOIN codes c ON c.vec_id <> q.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id))::INTEGER AS rank, neighbor_id, distance
FROM pairs QUALIFY rank <= {K}
"""

MIX = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, source, length(coalesce(text, ''))::BIGINT AS chars,
    md5(coalesce(doc_id::VARCHAR, 'null')) || md5(coalesce(text, '')) AS key FROM documents),
places AS (
  SELECT *, coalesce(sum(chars) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start_char FROM docs),
blocks AS (SELECT *, start_char // {BLOCK_CHARS} AS block FROM places),
weights AS (SELECT source, pow(sum(chars)::DOUBLE, {ALPHA}) AS weight, (sum(chars) // {BLOCK_CHARS} + 1)::BIGINT AS blocks FROM docs GROUP BY source HAVING sum(chars) > 0),
parts AS (
  SELECT source, blocks, row_number() OVER (ORDER BY source NULLS FIRST) AS i,
    greatest(round(weight / (SELECT list_sum(list(weight ORDER BY source NULLS FIRST)) FROM weights) * {PARTS})::BIGINT, 1) AS w FROM weights),
shares AS (
  SELECT list(w ORDER BY i) AS w, sum(w)::BIGINT AS total, max(ceil(blocks / w * (SELECT sum(w) FROM parts)))::BIGINT + 1 AS slots FROM parts),
run(t, done, k) AS (
  SELECT -1::BIGINT, list_transform(w, lambda x: 0::BIGINT), NULL::BIGINT FROM shares
  UNION ALL
  SELECT t + 1, list_transform(done, lambda d, i: d + (i = next)::BIGINT), next
  FROM (
    SELECT t, done, list_min(list_filter(list_transform(w, lambda x, i:
        CASE WHEN (done[i] * total) // x <= t + 1
          THEN {{'due': ((done[i] + 1) * total + x - 1) // x, 'i': i}} END), lambda x: x IS NOT NULL)).i::BIGINT AS next
    FROM run, shares WHERE t + 1 < slots) step),
cells AS (SELECT k AS i, t AS slot, row_number() OVER (PARTITION BY k ORDER BY t) - 1 AS block FROM run WHERE k IS NOT NULL)
SELECT b.doc_id, b.source, b.chars, b.start_char, b.block, c.slot
FROM blocks b
LEFT JOIN parts p ON b.source IS NOT DISTINCT FROM p.source
LEFT JOIN cells c ON c.i = p.i AND c.block = b.block
"""

EXACT = """
WITH texts AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM texts WINDOW w AS (PARTITION BY t)
"""

TRIE = """
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS place,
    struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL),
stored AS (
  SELECT conv_id, list(t ORDER BY place) AS ts,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295) % 9 AS h
  FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.ts, [])[1:c.h], c.ts[c.h + 1:]) AS ts
  FROM stored c LEFT JOIN stored b ON b.conv_id = c.conv_id - c.conv_id % 5),
prefixes AS (SELECT conv_id, len(ts) AS n, d::BIGINT AS depth, ts[1:d] AS path FROM (SELECT *, unnest(range(len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CASE WHEN n = depth THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE (count(*) - 1) * strlen(path[depth].text) END AS saved
  FROM prefixes GROUP BY depth, path),
named AS (SELECT p.conv_id AS member, p.depth, n.conv_id FROM prefixes p JOIN nodes n ON n.depth = p.depth AND n.path = p.path),
kin AS (SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id FROM nodes n LEFT JOIN named up ON up.member = n.conv_id AND up.depth = n.depth - 1),
children AS (SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM kin WHERE depth > 0 GROUP BY ALL),
sums AS (
  SELECT a.conv_id, a.depth, sum((c.n_children IS NULL)::BIGINT)::BIGINT AS n_leaves, sum(n.saved)::BIGINT AS saved_tokens
  FROM nodes n JOIN named a ON a.member = n.conv_id AND a.depth <= n.depth
  LEFT JOIN children c ON c.conv_id = n.conv_id AND c.depth = n.depth
  GROUP BY ALL)
SELECT n.conv_id, n.depth, k.parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children, s.n_leaves, s.saved_tokens, n.ends_sha256,
  l.turn_conv_id, l.turn_place
FROM nodes n JOIN kin k USING (conv_id, depth) JOIN sums s USING (conv_id, depth) LEFT JOIN children c USING (conv_id, depth)
LEFT JOIN (
  SELECT r.conv_id, d::BIGINT AS depth, CASE WHEN d <= r.hb THEN r.base ELSE r.conv_id END AS turn_conv_id,
    CASE WHEN d <= r.hb THEN d ELSE d - r.hb + r.h END::BIGINT AS turn_place
  FROM (SELECT c.conv_id, c.h, c.conv_id - c.conv_id % 5 AS base, least(c.h, len(coalesce(b.ts, []))) AS hb, unnest(range(1, least(c.h, len(coalesce(b.ts, []))) + greatest(len(c.ts) - c.h, 0) + 1)) AS d
        FROM stored c LEFT JOIN stored b ON b.conv_id = c.conv_id - c.conv_id % 5) r) l USING (conv_id, depth)
"""

RANKED = """
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
items AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
totals AS (SELECT count(*) AS big_n, sum(len(ts))::BIGINT AS big_l FROM words WHERE len(ts) > 0),
entries AS (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ts) AS n, unnest(ts) AS term FROM words) x WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * max(big_n) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM entries, totals GROUP BY term),
adds AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * big_n) // big_l))) AS add FROM entries JOIN weights USING (term), totals),
scores AS (SELECT item_id, doc_id, sum(add)::BIGINT AS score FROM items JOIN adds USING (term) GROUP BY ALL HAVING sum(add) > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST)::INTEGER AS rank, doc_id, score
FROM scores QUALIFY rank <= 10
"""

ORACLE_SQL: dict[str, str] = {"op3_exact_top_k": TOP_K, "op7_mixing_sources": MIX, "op11_exact_dedup": EXACT, "op12_ranked_search": RANKED, "op13_prefix_trie": TRIE}
