"""What each query must give, as SQL over the driver's tables; no message is ever built here."""

_FROM = "'User ' || user_id || ' <u' || user_id || '@mail.test>'"
_TO = "'\"Doe, Jane\" <ops@mail.test>|audit@mail.test'"
_IS_ERROR = "event_type = 'error'"
_DATE = "strftime(ts, '%a, %-d %b %Y %H:%M:%S') || ' +0000'"

# Bytes of a message: each header line with its line end, the blank line, the body.
_SIZE = f"""strlen('Date: ' || {_DATE}) + 2
  + strlen('From: User ' || user_id || ' <u' || user_id || '@mail.test>') + 2
  + strlen('To: "Doe, Jane" <ops@mail.test>,') + 2 + strlen(' audit@mail.test') + 2
  + CASE WHEN {_IS_ERROR} THEN strlen('Cc: oncall@mail.test') + 2 ELSE 0 END
  + strlen('Subject: ' || event_type) + 2
  + strlen('MIME-Version: 1.0') + 2 + strlen('Content-Type: application/json') + 2
  + 2 + strlen(props)"""

_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

_CONV = """(SELECT *, row_number() OVER (PARTITION BY role ORDER BY conv_id, turn) AS uid FROM conversations) c"""
_CONV_DEFAULT = """uid, 'conv ' || conv_id || ' turn ' || turn AS subject, CAST(-1 AS BIGINT) AS sent,
  uid * 1000000 AS received, role || '@mail.test' AS "from", 'c' || conv_id || '@mail.test' AS "to",
  '-' AS cc, '-' AS bcc"""

_ORDERS = "orders JOIN customer ON o_custkey = c_custkey"
_SUBJECT = "'Order ' || o_orderkey || ' ' || o_orderstatus"
_IS_RUSH = "o_orderpriority LIKE '1%'"

ORACLES: dict[str, str] = {
    "inbox": f"""
SELECT event_type AS subject, {_FROM} AS "fromFirst", '"Doe, Jane" <ops@mail.test>' AS "toFirst", props AS content
FROM events""",
    "scan_current": "SELECT event_id + 1 AS uid, event_type AS subject FROM events",
    "scan_offset": "SELECT event_id + 1 AS uid, event_type AS subject FROM events WHERE event_id + 1 >= 501",
    "scan_batched": """
SELECT event_id // 50 AS page, count(*) AS messages, CAST(sum(event_id + 1) AS BIGINT) AS uid_sum
FROM events WHERE (event_id + 1) % 7 <> 0 GROUP BY 1""",
    "scan_batch_sizes": """
SELECT CAST(size AS INTEGER) AS size, count(*) AS messages, CAST(sum(event_id + 1) AS BIGINT) AS uid_sum,
  CAST(sum(length(event_type)) AS BIGINT) AS letters
FROM events, (SELECT unnest([7, 50, 100000]) AS size) WHERE (event_id + 1) % 7 <> 0 GROUP BY 1""",
    "import_resume": "SELECT event_id + 1 AS uid, event_type AS subject FROM events",
    "compact_resume": "SELECT event_id + 1 AS uid, event_type AS subject FROM events",
    "meta_casts": f"""
SELECT CAST(event_id + 1 AS VARCHAR) AS uid, CAST({_SIZE} AS BIGINT) AS bytes,
  CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS seen, CAST(event_id % 10 = 0 AS INTEGER) AS draft,
  epoch_us(ts) // 1000000 AS received
FROM events""",
    "outbox_alias": f"""
SELECT {_SUBJECT} AS subject, c_name || ' <c' || o_custkey || '@mail.test>' AS "to", '-' AS cc, {_SUBJECT} AS content
FROM {_ORDERS}""",
    "scan_folder": f"""
SELECT uid, 'conv ' || conv_id || ' turn ' || turn AS subject, text AS content FROM {_CONV} WHERE role = 'user'""",
    "scan_all_folders": """
SELECT role AS folder, count(*) AS messages, CAST(sum(
  strlen('From: ' || role || '@mail.test') + 2 + strlen('To: c' || conv_id || '@mail.test') + 2
  + strlen('Reply-To: thread-' || conv_id || '@mail.test') + 2
  + strlen('Subject: conv ' || conv_id || ' turn ' || turn) + 2
  + strlen('MIME-Version: 1.0') + 2 + strlen('Content-Type: text/plain; charset=UTF-8') + 2
  + strlen('Content-Transfer-Encoding: 8bit') + 2 + 2 + strlen(text)) AS BIGINT) AS bytes
FROM conversations GROUP BY role""",
    "stream_all": "SELECT event_id + 1 AS uid, event_type AS subject FROM events",
    "stream_new": """
SELECT event_id + 1 AS uid, event_type AS subject FROM events
WHERE event_id + 1 > (SELECT count(*) // 2 FROM events)""",
    "meta_envelope": """
SELECT event_id + 1 AS uid,
  CASE WHEN event_id % 11 = 0 THEN -1 ELSE epoch_us(date_trunc('second', ts)) // 1000000 END AS sent,
  epoch_us(ts) AS received
FROM events""",
    "meta_addresses": f"""
SELECT event_id + 1 AS uid, {_FROM} AS "from", {_FROM} AS "fromFirst", {_FROM} AS "replyTo",
  {_TO} AS "to", '"Doe, Jane" <ops@mail.test>' AS "toFirst",
  CASE WHEN {_IS_ERROR} THEN 'oncall@mail.test' ELSE '-' END AS cc, '-' AS bcc,
  {_TO} || CASE WHEN {_IS_ERROR} THEN '|oncall@mail.test' ELSE '' END AS recipients
FROM events""",
    "meta_bcc": f"""
SELECT event_id + 1 AS uid, CASE WHEN user_id % 3 = 0 THEN 'Hidden <h' || user_id || '@mail.test>' ELSE '-' END AS bcc,
  {_TO} || CASE WHEN {_IS_ERROR} THEN '|oncall@mail.test' ELSE '' END
  || CASE WHEN user_id % 3 = 0 THEN '|Hidden <h' || user_id || '@mail.test>' ELSE '' END AS recipients
FROM events""",
    "meta_flags": """
SELECT event_id + 1 AS uid, CAST(user_id % 2 = 0 AS INTEGER) AS seen, CAST(event_id % 10 = 0 AS INTEGER) AS draft,
  CAST(event_type = 'purchase' AS INTEGER) AS answered
FROM events""",
    "meta_size_type": f"""
SELECT event_id + 1 AS uid, CAST({_SIZE} AS BIGINT) AS "sizeInBytes", 'application/json' AS "contentType" FROM events""",
    "meta_headers": f"""
SELECT event_id + 1 AS uid, CAST(6 + CAST({_IS_ERROR} AS INTEGER) AS INTEGER) AS headers,
  'Date,From,To,' || CASE WHEN {_IS_ERROR} THEN 'Cc,' ELSE '' END || 'Subject,MIME-Version,Content-Type' AS keys,
  {_FROM} AS second, '"Doe, Jane" <ops@mail.test>, audit@mail.test' AS third
FROM events""",
    "meta_alias_cast": "SELECT CAST(event_id + 1 AS VARCHAR) AS id, event_type AS subject FROM events",
    "projection_no_content": """
SELECT event_id + 1 AS uid, event_type AS subject, CAST(user_id % 2 = 0 AS INTEGER) AS seen FROM events""",
    "row_layout": f"""
SELECT 'k,k2,uid,subject' AS layout, '{{"k":' || {_K} || ',"k2":null}}' AS content,
  '{{"uid":' || (event_id + 1) || ',"subject":"' || event_type || '"}}' AS metadata
FROM events""",
    "format_raw": f"SELECT role AS folder, uid, text AS content FROM {_CONV}",
    "format_json": f"SELECT event_id + 1 AS uid, {_K} AS k FROM events",
    "format_csv": "SELECT o_orderkey + 1 AS uid, o_orderkey, o_custkey, o_orderpriority FROM orders",
    "format_xml": "SELECT o_orderkey + 1 AS uid, o_orderkey, o_custkey, o_orderpriority FROM orders",
    "content_quoted_printable": "SELECT lang AS folder, doc_id + 1 AS uid, text AS content FROM documents",
    "format_bad_json": f"""
SELECT event_id + 1 AS uid, event_type AS subject, CASE WHEN event_id % 5 = 0 THEN -1 ELSE {_K} END AS k FROM events""",
    "content_base64_utf8": """
SELECT lang AS folder, doc_id + 1 AS uid, text AS content,
  'Größe ' || n_chars || ' — très élevé — ' || source || ' №' || doc_id || ' 日本語 ' || lang || '?=' AS subject
FROM documents""",
    "outbox_roundtrip": f"""
SELECT {_SUBJECT} AS subject, epoch_us(o_orderdate) // 1000000 AS sent, 'orders@shop.test' AS "from", c_name || ' <c' || o_custkey || '@mail.test>' AS "to",
  CASE WHEN {_IS_RUSH} THEN 'rush@shop.test' ELSE '-' END AS cc, '-' AS bcc, 'help@shop.test' AS "replyTo",
  o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS content
FROM {_ORDERS}""",
    "outbox_json": f"SELECT {_SUBJECT} AS subject, o_orderkey, o_custkey FROM {_ORDERS}",
    "outbox_csv": f"SELECT {_SUBJECT} AS subject, o_orderkey || ',' || o_custkey AS content FROM {_ORDERS}",
    "outbox_xml": f"SELECT {_SUBJECT} AS subject, o_orderkey, o_custkey FROM {_ORDERS}",
    "outbox_no_content": f"""
SELECT 'text/plain; charset=us-ascii' AS "contentType", count(*) AS messages, CAST(0 AS BIGINT) AS body_bytes
FROM {_ORDERS}""",
    "outbox_envelope": f"""
SELECT 'orders@shop.test' AS envelope_from,
  'c' || o_custkey || '@mail.test,' || CASE WHEN {_IS_RUSH} THEN 'rush@shop.test,' ELSE '' END
  || 'archive@shop.test' AS recipients,
  count(*) AS messages, count(*) AS ids
FROM {_ORDERS} GROUP BY 1, 2""",
    "outbox_stream": """
SELECT 'Event ' || event_id AS subject, 'u' || user_id || '@mail.test' AS "toFirst", props AS content
FROM events""",
    "decode_addresses": f"""
SELECT {_SUBJECT} AS subject, c_name || '|Doe, Jane|-' AS names,
  'c' || o_custkey || '@mail.test|ops@mail.test|' || CASE WHEN {_IS_RUSH} THEN 'rush@shop.test' ELSE '-' END AS addresses
FROM {_ORDERS}""",
    "catalog_folders": "SELECT DISTINCT 'conv_folders' AS database, role AS name FROM conversations",
    "catalog_exists": """
SELECT unnest([role, role || '/Sent', upper(role)]) AS name, unnest([true, false, false]) AS found
FROM (SELECT DISTINCT role FROM conversations)""",
    "catalog_table": f"SELECT {_CONV_DEFAULT} FROM {_CONV} WHERE role = 'user'",
    "catalog_view": f"SELECT role AS folder, {_CONV_DEFAULT} FROM {_CONV}",
    "catalog_hint": "SELECT event_id + 1 AS uid, event_type AS subject FROM events WHERE event_id + 1 >= 501",
}
