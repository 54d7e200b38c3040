"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

from tessera.llm.line_dedup import MIN_CHARS, MIN_DOCS
from tessera.llm.mixing import KEY_SEED

# A source is capped when its share by weight, among the sources with more words per unit
# of weight, is above three times its size; sorted by words per weight the capped ones
# come first.
MIX = f"""WITH docs AS (
  SELECT doc_id, source,
         CAST(len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS size,
         CAST('0x' || substr(md5('{KEY_SEED}' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 15)
              AS BIGINT) AS key
  FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS s,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM docs GROUP BY source),
tot AS (SELECT sum(s) AS t FROM src),
ord AS (
  SELECT src.*, t,
         coalesce(sum(3 * s) OVER (ORDER BY CAST(s AS DOUBLE) / w, source NULLS LAST
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS closed,
         sum(w) OVER (ORDER BY CAST(s AS DOUBLE) / w, source NULLS LAST
                      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM src, tot),
cap AS (SELECT *, w * (t - closed) > 3 * s * open AS capped FROM ord),
fin AS (
  SELECT coalesce(sum(CASE WHEN capped THEN 3 * s END), 0) AS c,
         sum(CASE WHEN NOT capped THEN w END) AS ow FROM cap),
budget AS (
  SELECT source, s, CASE WHEN capped THEN CAST(3 * s AS DOUBLE)
                         ELSE CAST(w * (t - c) AS DOUBLE) / CAST(ow AS DOUBLE) END AS target,
         CASE WHEN capped THEN 3 * s ELSE w * (t - c) // ow END AS words
  FROM cap, fin),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source
                                     ORDER BY key, doc_id NULLS FIRST, size
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM docs)
SELECT p.doc_id, p.size, CAST(b.s AS BIGINT) AS source_size, b.target,
       CAST(p.size * (b.words // greatest(b.s, 1))
            + least(p.size, greatest(0, b.words % greatest(b.s, 1) - p.before)) AS BIGINT) AS taken
FROM placed p JOIN budget b ON p.source IS NOT DISTINCT FROM b.source"""

LINES = f"""WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
flat AS (SELECT r, doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM flat),
often AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= {MIN_CHARS}
  GROUP BY key HAVING count(DISTINCT doc_id) + max(CAST(doc_id IS NULL AS INT)) >= {MIN_DOCS}),
marked AS (
  SELECT k.*, o.key IS NOT NULL AND k.doc_id IS DISTINCT FROM o.keeper AS gone
  FROM keyed k LEFT JOIN often o ON k.key = o.key)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))
         AS kept_sha256
FROM marked GROUP BY r, doc_id"""

# CRC-32 bit by bit: DuckDB has no function for it.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT)),
  lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

# A node's key is the digests of its turns, one after another. Subtree totals: every node adds
# to all prefixes of its smallest member.
TRIE = f"""WITH turns AS (
  SELECT conv_id, md5(octet_length(encode(role)) || ':' || role || text) AS digest,
         octet_length(encode(text)) AS bytes, turn
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations WHERE conv_id IS NOT NULL)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos
  FROM turns),
plan AS (
  SELECT c.conv_id, c.conv_id - c.conv_id % 5 AS base, h, least(h, coalesce(b.n, 0)) AS taken
  FROM (SELECT conv_id, {CRC32.format("CAST(conv_id AS VARCHAR)")} % 9 AS h
        FROM (SELECT DISTINCT conv_id FROM placed)) c
  LEFT JOIN (SELECT conv_id, count(*) AS n FROM placed GROUP BY 1) b
    ON b.conv_id = c.conv_id - c.conv_id % 5),
rebuilt AS (
  SELECT p.conv_id AS c, t.pos AS depth, digest, bytes
  FROM plan p JOIN placed t ON t.conv_id = p.base AND t.pos <= p.taken
  UNION ALL
  SELECT p.conv_id, t.pos - p.h + p.taken, digest, bytes
  FROM plan p JOIN placed t ON t.conv_id = p.conv_id AND t.pos > p.h),
prefixes AS (
  SELECT c, depth, bytes, string_agg(digest, '') OVER (PARTITION BY c ORDER BY depth) AS key
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
nodes AS (
  SELECT key, min(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs,
         (count(*) - 1) * min(bytes) AS own FROM prefixes GROUP BY key),
kids AS (
  SELECT left(key, length(key) - 32) AS key, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
below AS (
  SELECT a.key, count(*) FILTER (k.key IS NULL) AS n_leaves, sum(u.own) AS saved
  FROM nodes u LEFT JOIN kids k ON k.key = u.key
  JOIN prefixes a ON a.c = u.conv_id AND a.depth <= u.depth GROUP BY a.key),
ends AS (
  SELECT key, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest
  FROM (SELECT c, arg_max(key, depth) AS key FROM prefixes GROUP BY c) GROUP BY key)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs,
       coalesce(k.n, 0) AS n_children, b.n_leaves, CAST(b.saved AS BIGINT) AS saved_tokens,
       coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n JOIN below b ON b.key = n.key
LEFT JOIN nodes p ON n.depth > 0 AND p.key = left(n.key, length(n.key) - 32)
LEFT JOIN kids k ON k.key = n.key LEFT JOIN ends e ON e.key = n.key"""

ORACLES: dict[str, str] = {"op9_mix_sources": MIX, "op12_prefix_trie": TRIE,
                           "op13_line_dedup": LINES}
