"""SQL that gives the result of each query in ``catalog.py`` from the driver tables."""

LF, CR, TAB = "chr(10)", "chr(13)", "chr(9)"

DAMAGED = """
SELECT event_id, CASE event_id % 7
    WHEN 0 THEN props || ' x'
    WHEN 1 THEN replace(props, '}', '')
    WHEN 2 THEN '[' || props || ']'
    WHEN 3 THEN ' '
    ELSE props END AS doc
FROM events"""

VALID = "(trim(doc) <> '' AND json_valid(doc))"

MARKED = f"""
SELECT doc_id, CASE doc_id % 4
    WHEN 0 THEN '---' || {LF} || front || {LF} || '---' || {LF} || text
    WHEN 1 THEN '---' || {CR} || {LF} || front || {LF} || '---' || {CR} || {LF} || text
    WHEN 2 THEN '---' || {LF} || front || {LF} || '---'
    ELSE text END AS whole
FROM (SELECT *, 'source: ' || source || {LF} || 'n: ' || n_chars AS front FROM documents)"""

FRONT = r"'(?s)\A---\r?\n(.*?)\n---(?:\r?\n(.*)|\z)'"

EVENT_DOC = """'{"event_id":' || event_id || ',"event_type":"' || event_type || '","props":"' || replace(props, '"', '\\"') || '"}'"""


def bodies(line: str, table: str, key: str, size: int = 500) -> str:
    return f"""
SELECT batch_id, count(*) AS n_docs, CAST(octet_length(encode(body)) AS INTEGER) AS n_bytes, md5(body) AS body_md5
FROM (SELECT batch_id, unnest(l) AS x, body FROM (
    SELECT batch_id, list(line) AS l, string_agg(line, '' ORDER BY key) AS body
    FROM (SELECT {key} AS key, {line} AS line, (row_number() OVER (ORDER BY {key}) - 1) // {size} AS batch_id FROM {table})
    GROUP BY batch_id))
GROUP BY batch_id, body"""


REPLIES = """
SELECT *, CASE rest WHEN 8 THEN 400 WHEN 9 THEN 429 ELSE 200 END AS status, rest IN (3, 4) AS failed
FROM (SELECT *, event_id % 10 AS rest FROM events)"""

ITEMS = f"""
SELECT 'create' AS action, CASE WHEN failed THEN 409 WHEN rest = 5 THEN 200 ELSE 201 END AS code, *
FROM ({REPLIES}) WHERE status = 200
UNION ALL
SELECT 'index' AS action, CASE WHEN failed THEN 400 WHEN rest = 6 THEN 200 ELSE 201 END AS code, *
FROM ({REPLIES}) WHERE status = 200"""

ACCEPTED = "(action = 'create' AND code = 201 OR action = 'index' AND code IN (200, 201))"

COMMAS = "regexp_replace(reverse(regexp_replace(reverse(CAST({} AS VARCHAR)), '(...)', '\\1,', 'g')), '^,', '')"

TARGETS = """
SELECT c_name, c_custkey % 7 AS k, 'Brand#' || (c_custkey % 60) AS named FROM customer"""

ORACLE: dict[str, str] = {
    "ndjson_valid": f"SELECT event_id, {VALID} AND ltrim(doc) LIKE '{{%' AS ok FROM ({DAMAGED})",
    "objects_gate": f"""
SELECT count(*) AS n, count(*) FILTER (NOT ({VALID} AND ltrim(doc) LIKE '{{%')) AS n_bad FROM ({DAMAGED})""",
    "root_shapes": f"""
SELECT CASE WHEN NOT {VALID} THEN 'invalid' WHEN ltrim(doc) LIKE '{{%' THEN 'object'
    WHEN ltrim(doc) LIKE '[%' THEN 'array' ELSE 'other' END AS shape, count(*) AS n
FROM ({DAMAGED}) GROUP BY 1""",
    "line_errors": f"""
SELECT error, count(*) AS n FROM (
    SELECT CASE WHEN trim(doc) = '' THEN 'blank line' WHEN NOT json_valid(doc) THEN 'invalid JSON'
        WHEN ltrim(doc) NOT LIKE '{{%' THEN 'not a JSON object' END AS error FROM ({DAMAGED}))
WHERE error IS NOT NULL GROUP BY error""",
    "kept_documents": f"SELECT event_id, doc FROM ({DAMAGED}) WHERE {VALID} AND ltrim(doc) LIKE '{{%'",
    "update_ids": """
SELECT o_orderkey, CASE WHEN k >= 2 THEN 'o' || o_orderkey END AS id,
    CASE WHEN k = 1 THEN '{"_id":' || o_orderkey || ',' ELSE '{' END
        || '"o_orderstatus":"' || o_orderstatus || '","o_custkey":' || o_custkey || '}' AS doc,
    CASE k WHEN 0 THEN '_id is missing' WHEN 1 THEN '_id is not a string' END AS error
FROM (SELECT *, o_orderkey % 4 AS k FROM orders)""",
    "csv_row_docs": """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment
FROM customer""",
    "wrap_content": "SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS body_md5 FROM documents",
    "file_metadata": """
SELECT doc_id, '/data/' || source || '/' || doc_id || '.txt' AS path, doc_id || '.txt' AS name,
    CASE WHEN doc_id % 3 <> 0 THEN lang END AS lang
FROM documents""",
    "distinct_paths": "SELECT DISTINCT '/data/' || source || '/' || lang || '.txt' AS path FROM documents ORDER BY path",
    "frontmatter": f"""
SELECT doc_id, CASE WHEN regexp_matches(whole, {FRONT}) THEN regexp_extract(whole, {FRONT}, 1) END AS front,
    md5(CASE WHEN regexp_matches(whole, {FRONT}) THEN regexp_extract(whole, {FRONT}, 2) ELSE whole END) AS body_md5
FROM ({MARKED})""",
    "frontmatter_fields": """
SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN source END AS source, CASE WHEN doc_id % 4 < 3 THEN n_chars END AS n
FROM documents""",
    "yaml_fields": "SELECT doc_id, source, lang AS tag, n_chars AS n, doc_id AS id FROM documents",
    "content_conflict": "SELECT doc_id, doc_id % 3 = 0 AS conflict FROM documents",
    "split_documents": f"""
SELECT doc_id, idx, md5(chunk) AS chunk_md5 FROM (
    SELECT doc_id, CAST(unnest(range(1, len(chunks) + 1)) AS INTEGER) AS idx, unnest(chunks) AS chunk FROM (
        SELECT doc_id, list_filter(string_split_regex(whole, '(?m)^[ \\t]*---[ \\t\\r]*$\\n?'),
            lambda x: NOT regexp_full_match(x, '\\s*')) AS chunks
        FROM (SELECT doc_id, '---' || {LF} || source || {LF} || '---' || {LF} || text || {LF} || ' --- ' || {LF}
            || ' ' || {LF} || '---' || {CR} || {LF} || lang AS whole FROM documents)))""",
    "explode_rows": """
SELECT l_orderkey, l_linenumber, 0 AS row, l_partkey AS key, 'part' AS of FROM lineitem WHERE l_linenumber % 3 = 0
UNION ALL
SELECT l_orderkey, l_linenumber, 1, l_suppkey, 'supplier' FROM lineitem WHERE l_linenumber % 3 = 0
UNION ALL
SELECT l_orderkey, l_linenumber, 0, l_suppkey, NULL FROM lineitem WHERE l_linenumber % 3 <> 0""",
    "exploded_text": """
SELECT l_orderkey, l_linenumber, CAST(unnest([0, 1]) AS INTEGER) AS row, '{"price": ' || CAST(l_extendedprice AS DECIMAL(18, 2)) || ', "key":' || l_partkey
    || '.0,"e":1e' || l_linenumber || '}' AS doc
FROM lineitem""",
    "toon_rows": """
SELECT p_partkey, 1 AS idx, 0 AS row, p_partkey AS id, p_name AS name, CAST(p_size AS VARCHAR) AS size,
    CAST(NULL AS BIGINT) AS first_size FROM part
UNION ALL SELECT p_partkey, 1, 1, -p_size, p_type, 'true', NULL FROM part
UNION ALL SELECT p_partkey, 2, 0, p_partkey, p_brand, NULL, p_size FROM part""",
    "toon_errors": """
SELECT p_partkey, CASE p_partkey % 5 WHEN 0 THEN 'declared length differs' WHEN 1 THEN 'row width differs from header'
    WHEN 2 THEN 'not an object' WHEN 3 THEN 'row is not an object' END AS error
FROM part""",
    "row_index": """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_index FROM orders""",
    "assign_batches": """
SELECT batch_id, count(*) AS n, min(event_id) AS min_id, max(event_id) AS max_id
FROM (SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // 500 AS batch_id FROM events) GROUP BY batch_id""",
    "bulk_create": bodies(f"'{{\"create\":{{}}}}' || {LF} || props || {LF}", "events", "event_id"),
    "bulk_index": bodies(f"'{{\"index\":{{}}}}' || {LF} || props || {LF}", "events", "event_id"),
    "bulk_update": bodies(
        f"""'{{"update":{{"_id":"o' || o_orderkey || '"}}}}' || {LF} || '{{"doc":{{"o_orderstatus":"' || o_orderstatus
        || '","o_custkey":' || o_custkey || '}}}}' || {LF}""",
        "orders",
        "o_orderkey",
    ),
    "reply_success": f"""
SELECT action, count(*) AS n_items, count(*) FILTER ({ACCEPTED}) AS n_accepted FROM ({ITEMS}) GROUP BY action""",
    "reply_errors": f"""
SELECT event_type AS "index", event_type AS type, 'user ' || user_id AS reason, count(*) AS n
FROM ({ITEMS}) WHERE rest = 3 GROUP BY ALL""",
    "request_errors": f"""
SELECT status, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN event_type || ' text' ELSE 'unknown' END AS cause,
    count(*) AS n
FROM ({REPLIES}) WHERE status <> 200 GROUP BY 1, 2""",
    "run_summary": f"""
SELECT n_requests, n_docs, n_accepted,
    {COMMAS.format("n_accepted")} || ' of ' || {COMMAS.format("n_docs")} || ' docs accepted' AS summary
FROM (SELECT (SELECT count(*) FROM events) AS n_requests, (SELECT 2 * count(*) FROM events) AS n_docs,
    (SELECT count(*) FILTER ({ACCEPTED}) FROM ({ITEMS})) AS n_accepted)""",
    "pattern_match": """
SELECT p_partkey, CASE WHEN p_name LIKE 'large%' THEN true WHEN p_name LIKE '% bolt' THEN false
    WHEN starts_with(p_name, 'small_') THEN true WHEN p_name LIKE 'small%' THEN false
    ELSE p_name LIKE '%widget%' END AS matched
FROM part""",
    "template_match": """
SELECT p_partkey, CASE WHEN p_brand LIKE '%#5' THEN true WHEN p_brand = 'Brand#1' || (p_size % 10) THEN false
    ELSE p_brand LIKE 'Brand#1%' END AS matched
FROM part""",
    "template_defaults": """
SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN p_brand WHEN 1 THEN p_type WHEN 2 THEN p_brand END AS default_name
FROM part""",
    "preflight_check": f"""
SELECT c_name AS "index",
    CASE WHEN k = 5 THEN 'pipeline name without pipeline' WHEN k = 4 THEN 'template names no pipeline'
        WHEN k = 6 THEN 'template names another pipeline'
        WHEN k = 3 AND named NOT IN (SELECT p_brand FROM part) THEN 'template pipeline is missing' ELSE 'ok' END AS status,
    CASE WHEN k IN (2, 3, 6) THEN named END AS template_pipeline,
    CASE k WHEN 0 THEN '_none' WHEN 1 THEN named END AS request_pipeline,
    CASE WHEN k IN (2, 3, 6) THEN true END AS patterns_match
FROM ({TARGETS})""",
    "missing_defaults": f"""
SELECT c_name AS name, named AS template_pipeline FROM ({TARGETS}) WHERE named NOT IN (SELECT p_brand FROM part)""",
    "processors": """
SELECT doc_id, toxic = 1 AS toxic, 'labels' AS origin, 2 AS n_tags, CAST(doc_id AS VARCHAR) AS second_tag FROM labels""",
    "typed_mapping": """
SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 5 <> 0 THEN CAST(l_partkey AS INTEGER) END AS part,
    l_quantity AS quantity, l_returnflag = 'R' AS returned,
    CASE WHEN l_orderkey % 6 <> 0 THEN CAST(l_shipdate AS DATE) END AS shipped, l_linestatus AS state
FROM lineitem""",
    "index_sort": """
SELECT c_custkey, row_number() OVER (ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) - 1 AS row_index FROM customer""",
    # A name that is only a suffix has no extension, and a URL without path has no name.
    "url_format": r"""
SELECT page_id, kind, CASE WHEN s = 6 AND path THEN 'gzip' WHEN kind IS NULL THEN 'unsupported' END AS error FROM (
    SELECT page_id, s, path, CASE
        WHEN s = 6 AND path OR s = 5 AND named THEN NULL
        WHEN s = 1 AND named THEN 'csv' WHEN s = 2 AND named THEN 'ndjson' WHEN s = 3 AND named THEN 'json'
        WHEN s = 4 AND named THEN 'toon'
        ELSE CASE page_id % 6 WHEN 0 THEN 'csv' WHEN 1 THEN 'ndjson' WHEN 2 THEN 'json' WHEN 3 THEN 'toon' END END AS kind
    FROM (SELECT page_id, page_id % 8 AS s, regexp_matches(base, '^[a-z]+://[^/]*/') AS path,
            regexp_matches(base, '^[a-z]+://[^/]*/(.*[^/])?$') AND base NOT LIKE '%/' AS named
        FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS base FROM pages)))""",
    "suffix_rules": """
SELECT page_id, k IN (2, 3) AS input_refused, k IN (0, 2, 3) AS output_refused,
    CASE WHEN k = 0 THEN 'csv' WHEN k = 1 THEN 'ndjson' WHEN k = 4 THEN 'file'
        WHEN k = 5 AND url NOT LIKE '%/' THEN 'ndjson' END AS kind
FROM (SELECT *, page_id % 6 AS k FROM pages)""",
    "ndjson_roundtrip": "SELECT event_id, event_type, props FROM events",
    "ndjson_gz_roundtrip": "SELECT event_id, event_type, props FROM events",
    "csv_file_docs": """
SELECT CAST(conv_id AS VARCHAR) AS conv_id, CAST(turn AS VARCHAR) AS turn, role, md5(text) AS text_md5 FROM conversations""",
    "csv_split": "SELECT doc_id, lang, md5(text) AS text_md5 FROM documents",
    "csv_odd_rows": f"""
SELECT event_id, CASE k WHEN 0 THEN event_type || ' "q"' WHEN 3 THEN 'first' || {LF} || 'second,' || event_type
        WHEN 4 THEN 'plain"' || event_type WHEN 5 THEN event_type END AS value,
    CASE k WHEN 0 THEN 'x' WHEN 3 THEN 'z' WHEN 4 THEN '' WHEN 5 THEN 'z' END AS more,
    CASE WHEN k IN (1, 2) THEN 'row length differs from header' END AS error
FROM (SELECT *, event_id % 6 AS k FROM events)""",
    "csv_gz": "SELECT c_custkey, c_name FROM customer",
    "error_places": f"""
SELECT event_id % 16 AS part, line, CASE WHEN trim(doc) = '' THEN 'blank line' WHEN NOT json_valid(doc) THEN 'invalid JSON'
        WHEN ltrim(doc) NOT LIKE '{{%' THEN 'not a JSON object' END AS error
FROM (SELECT *, row_number() OVER (PARTITION BY event_id % 16 ORDER BY event_id) AS line FROM ({DAMAGED}))
WHERE error IS NOT NULL""",
    "toon_long": """
SELECT o_custkey % 4 AS part, o_orderkey AS key, o_orderstatus AS state, CAST(NULL AS VARCHAR) AS error FROM orders WHERE o_custkey % 4 <> 2
UNION ALL SELECT DISTINCT 2, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), 'declared length differs' FROM orders WHERE o_custkey % 4 = 2
UNION ALL SELECT DISTINCT 3, -1, CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM orders WHERE o_custkey % 4 = 3""",
    "pretty_json": """
SELECT n_name AS name, CAST(n_nationkey AS BIGINT) AS key FROM nation UNION ALL SELECT o_orderstatus, o_orderkey FROM orders""",
    "send_ledger": "SELECT count(*) AS n_docs, CAST(0 AS BIGINT) AS too_large, CAST(0 AS BIGINT) AS sent_twice FROM events",
    "load_summary": f"""
SELECT count(*) AS n_read, count(*) FILTER (NOT ok) AS n_refused, count(*) FILTER (ok) AS n_docs, count(*) FILTER (ok) AS n_accepted,
    count(*) FILTER (NOT ok) AS n_kept
FROM (SELECT {VALID} AND ltrim(doc) LIKE '{{%' AS ok FROM ({DAMAGED}))""",
    "bulk_source": """
SELECT count(*) FILTER (o_orderkey % 4 >= 2) AS n_docs, count(*) FILTER (o_orderkey % 4 < 2) AS n_refused, 'sent' AS outcome,
    CAST(0 AS BIGINT) AS odd FROM orders""",
    "utf8_lines": "SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'invalid UTF-8' END AS error FROM events",
    "content_fields": "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'no name' WHEN 1 THEN 'has dots' WHEN 2 THEN 'no name' END AS error FROM documents",
    "output_rules": """
SELECT page_id, CASE WHEN page_id % 5 IN (2, 4) THEN 'compressed' WHEN page_id % 5 = 3 AND page_id % 3 > 1 THEN 'several inputs' END AS error
FROM pages""",
    "shard_sort": """
SELECT c_custkey, shard, row_number() OVER (PARTITION BY shard ORDER BY c_mktsegment, c_acctbal DESC, c_custkey) - 1 AS place
FROM (SELECT *, CAST(CAST('0x' || substr(md5(CAST(c_custkey AS VARCHAR)), 1, 8) AS BIGINT) % 5 AS INTEGER) AS shard FROM customer)""",
    "jsonl_files": "SELECT event_id, event_type, props, true AS named FROM events",
    "concat_inputs": """
SELECT kind, count(*) AS n, CAST(sum(key) AS BIGINT) AS keys
FROM (SELECT event_type AS kind, event_id AS key FROM events UNION ALL SELECT o_orderstatus, o_orderkey FROM orders) GROUP BY kind""",
    "batches_as_read": """
SELECT batch_id, count(*) AS n, CAST(count(*) AS INTEGER) AS n_places
FROM (SELECT (row_number() OVER (ORDER BY event_id) - 1) // 700 AS batch_id FROM events) GROUP BY batch_id""",
    "text_files": f"""
SELECT s_suppkey, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS INTEGER) AS nation,
    s_name || {LF} || 'from ' || s_nationkey || {LF} AS body
FROM supplier""",
    "markdown_files": f"""
SELECT s_suppkey, s_name AS name, s_nationkey AS nation,
    'About ' || s_name || {LF} || 'from ' || s_nationkey || {LF} AS body
FROM supplier""",
    "yaml_files": "SELECT s_suppkey, s_name AS name, s_nationkey AS nation, CAST(NULL AS VARCHAR) AS body FROM supplier",
    "json_files": "SELECT s_suppkey, s_name AS name, s_nationkey AS nation, CAST(NULL AS VARCHAR) AS body FROM supplier",
    "toon_files": """
SELECT s_suppkey, s_name AS name, s_nationkey AS nation, CAST(NULL AS VARCHAR) AS body FROM supplier
UNION ALL SELECT s_suppkey, '#' || s_suppkey, -1, NULL FROM supplier""",
    "mixed_files": f"""
SELECT s_suppkey, CASE WHEN k > 0 THEN s_name END AS name, CASE WHEN k > 0 THEN s_nationkey END AS nation,
    CASE k WHEN 0 THEN s_name || {LF} || 'from ' || s_nationkey || {LF}
        WHEN 1 THEN 'About ' || s_name || {LF} || 'from ' || s_nationkey || {LF} END AS body
FROM (SELECT *, s_suppkey % 4 AS k FROM supplier)""",
    "listed_files": "SELECT s_suppkey, 'txt' AS suffix FROM supplier",
    "bulk_dry_run": f"""
SELECT n AS n_docs, n AS n_accepted, {COMMAS.format("n")} || ' of ' || {COMMAS.format("n")} || ' docs accepted' AS summary
FROM (SELECT count(*) AS n FROM events)""",
    "stream_copy": "SELECT event_id, event_type, props FROM events",
    "stream_bulk_dry_run": "SELECT count(*) AS n_docs, count(*) AS n_accepted FROM events",
    "first_load": bodies(f"'{{\"create\":{{}}}}' || {LF} || {EVENT_DOC} || {LF}", "events", "event_id", 5000),
}
