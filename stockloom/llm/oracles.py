"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_MIX = """
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS n,
    ((coalesce(doc_id, 0)::HUGEINT + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END)
      * 2862933555777941757 % 18446744073709551616 // 4294967296) % 4096 AS cell
  FROM documents
), docs AS (
  SELECT doc_id, source, coalesce(n, 0)::BIGINT AS size, cell FROM sized
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM docs GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][place % 3 + 1] AS weight, [-0.5::DOUBLE, 0::DOUBLE, 0.5::DOUBLE][place % 3 + 1] AS tilt,
    3 * source_size AS most
  FROM totals
), levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(most) OVER before, 0))::DOUBLE
    / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0))::DOUBLE AS level
  FROM weighed
  WINDOW before AS (ORDER BY most::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), goals AS (
  SELECT *, least(most::DOUBLE, coalesce(
    max(level) FILTER (level * weight <= most) OVER () * weight, most::DOUBLE)) AS target
  FROM levels
), placed AS (
  SELECT d.doc_id, d.size, g.source_size, g.target, g.tilt, round(g.target)::BIGINT AS quota,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.cell, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM docs d JOIN goals g ON d.source IS NOT DISTINCT FROM g.source
), mixed AS (
  SELECT *, CASE WHEN source_size > 0 THEN (quota // source_size) * size
    + greatest(0, least(size, quota % source_size - before)) ELSE 0 END::BIGINT AS taken
  FROM placed
)
SELECT doc_id, size, source_size, target, taken, CASE WHEN taken > 0 THEN least(1::DOUBLE,
    2 * (before / target) / ((1 - tilt) + sqrt((1 - tilt) * (1 - tilt) + 4 * tilt * (before / target)))) END AS position
FROM mixed
"""

_SHARDS = """
WITH RECURSIVE steps(byte, x, n) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n + 1 FROM steps WHERE n < 8
), crc AS (
  SELECT list(x ORDER BY byte) AS t FROM steps WHERE n = 8
), bytes AS (
  SELECT doc_id, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size,
    list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda s: ('0x' || s)::BIGINT) AS b
  FROM documents
), docs AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295::BIGINT) AS text_crc32
  FROM bytes, crc
), walk(doc_id, key, place) AS (
  SELECT DISTINCT doc_id, coalesce(doc_id, 0)::HUGEINT + CASE WHEN doc_id < 0 THEN 18446744073709551616 ELSE 0 END, 0::BIGINT
  FROM documents
  UNION ALL
  SELECT doc_id, k, floor((place + 1) * (2147483648::DOUBLE / (k // 8589934592 + 1)::DOUBLE))::BIGINT
  FROM (SELECT doc_id, place, (key * 2862933555777941757 + 1) % 18446744073709551616 AS k FROM walk WHERE place < 41)
), places AS (
  SELECT doc_id, max(place) FILTER (place < 40)::INTEGER AS shard, max(place) FILTER (place < 41)::INTEGER AS grown_shard
  FROM walk GROUP BY doc_id
), cells AS (
  SELECT d.*, p.shard, p.grown_shard, (xor(coalesce(d.doc_id, 0), text_crc32)::HUGEINT
      + CASE WHEN d.doc_id < 0 THEN 18446744073709551616 ELSE 0 END)
    * 2862933555777941757 % 18446744073709551616 // 4294967296 % 1638 AS cell
  FROM docs d JOIN places p ON d.doc_id IS NOT DISTINCT FROM p.doc_id
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard, row_number() OVER (
    PARTITION BY shard ORDER BY cell, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, grown_shard
FROM cells
"""

_EXACT = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

_TRIE = """
WITH RECURSIVE steps(byte, x, n) AS (
  SELECT i, i, 0 FROM range(256) r(i)
  UNION ALL
  SELECT byte, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, n + 1 FROM steps WHERE n < 8
), crc AS (
  SELECT list(x ORDER BY byte) AS t FROM steps WHERE n = 8
), convs AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
      ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS turns,
    list_transform(regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda s: ('0x' || s)::BIGINT) AS b
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), shared AS (
  SELECT conv_id, turns, conv_id - conv_id % 5 AS base, xor(list_reduce(list_prepend(4294967295::BIGINT, b),
    lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1])), 4294967295::BIGINT) % 9 AS h
  FROM convs, crc
), rebuilt AS (
  SELECT s.conv_id, list_concat(coalesce(b.turns[1:s.h], []), s.turns[s.h + 1:]) AS turns
  FROM shared s LEFT JOIN convs b ON b.conv_id = s.base
), prefixes AS (
  SELECT conv_id, d AS depth, turns[1:d]::VARCHAR AS node, turns[1:greatest(d - 1, 0)]::VARCHAR AS parent,
    CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(turns[d].text)) END AS bytes, d = len(turns) AS ends
  FROM rebuilt, unnest(range(len(turns) + 1)) u(d)
), nodes AS (
  SELECT depth, node, any_value(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
    (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY depth, node
), children AS (
  SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
), valued AS (
  SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (depth, node)
), totals AS (
  SELECT p.depth, p.node, sum((v.n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(v.saved)::BIGINT AS saved_tokens
  FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.depth <= v.depth GROUP BY p.depth, p.node
)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, v.n_children, t.n_leaves, t.saved_tokens, v.ends_sha256
FROM valued v JOIN totals t USING (depth, node)
  LEFT JOIN nodes p ON v.depth > 0 AND p.depth = v.depth - 1 AND p.node = v.parent
"""

ORACLES: dict[str, str] = {
    "op5_exact_duplicates": _EXACT,
    "op6_curriculum_mix": _MIX,
    "op10_jump_hash_shards": _SHARDS,
    "op11_conversation_trie": _TRIE,
}
