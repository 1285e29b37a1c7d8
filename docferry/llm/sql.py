"""DuckDB SQL for the numbered queries that SQL can express."""

from __future__ import annotations

from docferry.llm.common import UPPER
from docferry.llm.mixing import EPOCHS
from docferry.llm.sharding import BITS, SHARD_BYTES
from docferry.llm.warc import LEAST_BYTES

OP3 = f"""
WITH p AS (SELECT page_id, sha1(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT *, CASE WHEN n >= {LEAST_BYTES} THEN max(page_id) OVER (PARTITION BY digest, n) END AS first FROM p)
SELECT page_id, n::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN first IS NOT NULL AND first IS DISTINCT FROM page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to
FROM g
"""

OP6 = rf"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5('mix:' || doc_id) AS key
  FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1 AS o FROM s GROUP BY source),
w AS (SELECT *, (o % 3 + 1)::DOUBLE AS weight, {EPOCHS} * source_size AS lim FROM t),
r AS (SELECT *, row_number() OVER (ORDER BY lim / weight, o) AS rank FROM w),
l AS (
  SELECT a.*, ((SELECT sum(source_size) FROM r) - (SELECT coalesce(sum(lim), 0) FROM r b WHERE b.rank < a.rank))
    / (SELECT sum(weight) FROM r b WHERE b.rank >= a.rank) AS level FROM r a),
v AS (SELECT min_by(level, rank) AS level FROM l WHERE level <= lim / weight),
g AS (SELECT l.source, l.source_size, least(v.level * weight, lim)::DOUBLE AS target FROM l, v),
e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM g),
b AS (SELECT *, round(target - epochs * source_size)::BIGINT AS budget FROM e),
c AS (
  SELECT s.*, b.source_size, b.target, b.epochs, b.budget,
    coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY key, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM s JOIN b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, budget - before)))::BIGINT AS taken FROM c
"""

OP7 = f"""
WITH r AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT AS n_bytes, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, {BITS // 4}))::BIGINT AS hash
  FROM documents),
l AS (SELECT r.*, d::INTEGER AS depth, hash >> ({BITS} - d)::INTEGER AS prefix FROM r, range(0, 31) t(d)),
s AS (SELECT *, sum(n_bytes) OVER w AS shard_bytes, count(*) OVER w AS shard_rows FROM l WINDOW w AS (PARTITION BY depth, prefix))
SELECT doc_id, n_bytes, min(depth) AS depth, min_by(prefix, depth) AS prefix, 0::BIGINT AS piece,
  min_by(shard_bytes, depth)::BIGINT AS shard_bytes, min_by(shard_rows, depth) AS shard_rows
FROM s WHERE shard_bytes <= {SHARD_BYTES} OR shard_rows = 1 GROUP BY doc_id, n_bytes
"""

OP8 = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER (PARTITION BY norm ORDER BY doc_id DESC) = 1 AS kept, sha256(norm) AS text_sha256
FROM n
"""

ORACLE = {"op3_warc": OP3, "op6_mixing": OP6, "op7_sharding": OP7, "op8_exact_dedup": OP8}
