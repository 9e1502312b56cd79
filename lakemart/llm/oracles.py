"""DuckDB SQL for the queries of this subpackage that SQL can express, written from their contracts."""

from __future__ import annotations

from lakemart.llm.chat import ORACLE_SQL as CHAT

WORD = r"[^\x20\x09-\x0D]+"

#: Words and windows as rows; a window that also starts earlier removes its words.
SUBSTRINGS = rf"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 18)) AS i,
    unnest(list_transform(range(1, len(w) - 18), lambda k: array_to_string(w[k:k + 19], ' '))) AS words
  FROM texts WHERE len(w) >= 20
),
firsts AS (SELECT words, min((doc_id, i)) AS first FROM windows GROUP BY words HAVING count(*) > 1),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS pos
  FROM windows JOIN firsts USING (words) WHERE (doc_id, i) > first
),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM texts)
  ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
)
SELECT t.doc_id, len(t.w) AS n_words, len(t.w) - coalesce(k.n, 0) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM texts t LEFT JOIN kept k USING (doc_id)
"""

#: The CRC-32 table, eight steps for each byte, and the checksum byte by byte.
SHARDING = """
WITH RECURSIVE step(n, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
),
crc AS (SELECT list(c ORDER BY n) AS t FROM step WHERE k = 8),
hexed AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
bytes AS (
  SELECT doc_id, length(h) // 2 + 1 AS size, coalesce('k' || doc_id, 'n') AS key,
    list_transform(range(length(h) // 2), lambda i: ('0x' || substr(h, CAST(2 * i + 1 AS INTEGER), 2))::BIGINT) AS b
  FROM hexed
),
summed AS (
  SELECT doc_id, key, size, md5('slot#' || coalesce(CAST(doc_id AS VARCHAR), 'n')) AS digest,
    xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc
),
draws AS (
  SELECT key, shard, -1.0 / ln((('0x' || substr(md5(key || '#' || shard), 1, 13))::BIGINT + 0.5) / 4503599627370496.0) AS score
  FROM (SELECT DISTINCT key FROM summed), range(9) r(shard)
),
chosen AS (
  SELECT key, arg_max(shard, score) FILTER (WHERE shard < 8) AS shard, arg_max(shard, score) AS grown_shard FROM draws GROUP BY key
)
SELECT doc_id, CAST(size AS BIGINT) AS size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
  row_number() OVER (
    PARTITION BY shard ORDER BY ('0x' || substr(digest, 1, 8))::BIGINT % 1024, digest, text_crc32, size
  ) - 1 AS slot,
  CAST(grown_shard AS INTEGER) AS grown_shard
FROM summed JOIN chosen USING (key)
"""

#: Checksum of a decimal number, by the same table: ``decimal_crc`` (key, h).
_DECIMAL_CRC = """
step(n, c, k) AS (
  SELECT i, i::BIGINT, 0 FROM range(256) t(i)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM step WHERE k < 8
),
crc AS (SELECT list(c ORDER BY n) AS t FROM step WHERE k = 8),
decimal_crc AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(key AS VARCHAR), ''), lambda x: ascii(x)::BIGINT)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h
  FROM keys, crc
),
"""

#: Nodes are groups of equal prefixes; what stands below a node is found over the prefixes of each node's smallest member.
TRIE = f"""
WITH RECURSIVE keys AS (SELECT DISTINCT conv_id AS key FROM conversations WHERE conv_id IS NOT NULL), {_DECIMAL_CRC}
placed AS (
  SELECT conv_id, coalesce(text, '') AS text, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS place
  FROM conversations WHERE conv_id IS NOT NULL
),
rebuilt AS (
  SELECT key AS conv_id, 0 AS half, place, digest, text FROM decimal_crc JOIN placed p ON p.conv_id = key - key % 100 AND p.place <= h % 6
  UNION ALL SELECT key, 1, place, digest, text FROM decimal_crc JOIN placed p ON p.conv_id = key AND p.place > h % 6
),
line AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY half, place) AS depth FROM rebuilt),
prefixes AS (
  SELECT conv_id, depth, length(text) AS points, md5(string_agg(digest, '/') OVER (PARTITION BY conv_id ORDER BY depth)) AS prefix FROM line
  UNION ALL SELECT key, 0, 0, '' FROM keys
),
lengths AS (SELECT conv_id, max(depth) AS n FROM prefixes GROUP BY conv_id),
groups_ AS (
  SELECT depth, prefix, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(points) AS points,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE depth = n), '')) AS ends_sha256
  FROM prefixes JOIN lengths USING (conv_id) GROUP BY depth, prefix
),
children AS (
  SELECT p.depth, p.prefix, count(DISTINCT c.prefix) AS n_children
  FROM prefixes c JOIN prefixes p ON c.conv_id = p.conv_id AND c.depth = p.depth + 1 GROUP BY p.depth, p.prefix
),
nodes AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM groups_ g LEFT JOIN children USING (depth, prefix)),
subtrees AS (
  SELECT p.depth, p.prefix, count(*) FILTER (WHERE n.n_children = 0) AS n_leaves, sum((n.n_convs - 1) * n.points) AS saved
  FROM nodes n JOIN prefixes p ON p.conv_id = n.conv_id AND p.depth <= n.depth GROUP BY p.depth, p.prefix
)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s USING (depth, prefix)
LEFT JOIN prefixes w ON w.conv_id = n.conv_id AND w.depth = n.depth - 1
LEFT JOIN groups_ up ON up.depth = w.depth AND up.prefix = w.prefix
"""

#: Runs are islands of places whose word returns after the same distance; one inside another of a smaller period isn't one.
RUNS = rf"""
WITH RECURSIVE keys AS (SELECT DISTINCT doc_id AS key FROM documents WHERE doc_id IS NOT NULL), {_DECIMAL_CRC}
texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
planted AS (
  SELECT doc_id, w, len(w) AS n, h % 10 = 0 AND len(w) > 0 AS chosen, h // 10 AS g FROM texts JOIN decimal_crc ON key = doc_id
),
changed AS (
  SELECT doc_id, n, CASE WHEN chosen THEN list_transform(range(n),
      lambda i: w[CASE WHEN i >= g % n THEN g % n + (i - g % n) % (1 + (n - g % n) // (3 + g % 8)) ELSE i END + 1]) ELSE w END AS w
  FROM planted
),
words AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM changed),
pairs AS (
  SELECT a.doc_id, a.i, b.i - a.i AS q FROM words a JOIN words b ON a.doc_id = b.doc_id AND a.word = b.word AND b.i > a.i AND (b.i - a.i) * 4 <= a.n
),
islands AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island
),
long_ AS (SELECT * FROM islands WHERE length >= greatest(6, 4 * q)),
runs AS (
  SELECT * FROM long_ r WHERE NOT EXISTS (
    SELECT 1 FROM long_ s WHERE s.doc_id = r.doc_id AND s.q < r.q AND s.start <= r.start AND s.start + s.length >= r.start + r.length)
),
told AS (
  SELECT doc_id, count(*) AS n_runs, sha256(string_agg(start || ',' || length || ',' || q || chr(10), '' ORDER BY start, q)) AS runs_sha256
  FROM runs GROUP BY doc_id
),
best AS (
  SELECT * FROM runs
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY CAST(length AS DOUBLE) / q DESC, start, q) = 1
),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + q, start + length)) AS i FROM runs),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, b.start, b.length, b.q AS period, 1000 * b.length // b.q AS exponent_milli,
  coalesce(runs_sha256, sha256('')) AS runs_sha256, sha256(coalesce(k.text, '')) AS collapsed_sha256
FROM texts d LEFT JOIN told USING (doc_id) LEFT JOIN best b USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""

#: Every one of the 4,096 offsets is tried on every document.
MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS size,
    md5('42#' || coalesce(CAST(doc_id AS VARCHAR), 'none')) AS digest
  FROM documents
),
parts AS (
  SELECT *, (length(bin(size + 1)) - 1) * 16 + ((((size + 1) << 4) >> (length(bin(size + 1)) - 1)) & 15) AS sixteenth FROM sized
),
placed AS (
  SELECT *, row_number() OVER (
    PARTITION BY source ORDER BY sixteenth * 64 + ('0x' || substr(digest, 1, 4))::BIGINT % 64, size, digest) - 1 AS place
  FROM parts
),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n,
    [1.0, 2.0, 3.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight, 3.0::DOUBLE * sum(size) AS cap
  FROM sized GROUP BY source
),
levels AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER (
      ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
    / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
),
shares AS (
  SELECT *, least(cap, coalesce(
    (SELECT arg_min(l.level, l.cap / l.weight) FROM levels l WHERE l.level * l.weight <= l.cap) * weight, cap)) AS target
  FROM levels
),
rates AS (
  SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
    ('0x' || substr(md5('42/' || coalesce(source, 'none')), 1, 8))::BIGINT % 16777216 AS first_offset
  FROM shares
),
turned AS (
  SELECT p.doc_id, p.size, r.source, r.source_size, r.target, r.first_offset, CAST(floor(rate) AS BIGINT) AS whole,
    CAST(floor((rate - floor(rate)) * 16777216 + 0.5) AS BIGINT) AS part, p.place, r.n,
    (p.place * part) // 16777216 AS stratum,
    CASE WHEN stratum % 2 = 1 THEN (stratum * 16777216 + greatest(part, 1) - 1) // greatest(part, 1)
      + least(((stratum + 1) * 16777216 + greatest(part, 1) - 1) // greatest(part, 1), r.n) - 1 - p.place ELSE p.place END AS pos
  FROM placed p JOIN rates r ON p.source IS NOT DISTINCT FROM r.source
),
tried AS (
  SELECT source, any_value(target) AS target, draw, any_value((first_offset + draw * 4096) % 16777216) AS offset_,
    sum((whole + ((pos + 1) * part + (first_offset + draw * 4096) % 16777216) // 16777216
      - (pos * part + (first_offset + draw * 4096) % 16777216) // 16777216) * size) AS taken
  FROM turned, range(4096) d(draw) GROUP BY source, draw
),
best AS (SELECT source, arg_min(offset_, (abs(taken - target), draw)) AS offset_ FROM tried GROUP BY source)
SELECT doc_id, size, source_size, target,
  (whole + ((pos + 1) * part + offset_) // 16777216 - (pos * part + offset_) // 16777216) * size AS taken,
  CAST(whole + ((pos + 1) * part + offset_) // 16777216 - (pos * part + offset_) // 16777216 AS INTEGER) AS n_copies
FROM turned t JOIN best b ON t.source IS NOT DISTINCT FROM b.source
"""

ORACLES = {
    "op1_substring_dedup": SUBSTRINGS,
    "op2_chat_format": CHAT,
    "op6_source_mix": MIXING,
    "op9_sharding": SHARDING,
    "op11_prefix_trie": TRIE,
    "op12_periodic_runs": RUNS,
}
