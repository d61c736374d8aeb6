"""The same results as plain SQL. Nothing here parses: faults are told by the key that picked them."""

from __future__ import annotations

from ledgerline.plans.queries import ENDPOINT, USER_SQL
from ledgerline.plans.views import BAD_AT, BAD_EVERY, FILE_LINES

AMOUNT = "CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE)"
DAY = "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)"

RECORDS = f"""
    SELECT o_orderkey AS rec_id, o_orderpriority AS rec_name, o_orderstatus AS rec_group,
           {AMOUNT} AS amount, {DAY} AS rec_date
    FROM orders
"""

PARSED = f"""
    SELECT o_orderkey AS rec_id, o_orderpriority AS rec_name,
           CASE WHEN o_orderkey % 50 <> 1 THEN o_orderstatus END AS rec_group,
           {AMOUNT} AS amount,
           CASE WHEN o_orderkey % 50 <> 0 THEN {DAY} END AS rec_date
    FROM orders WHERE o_orderkey % 50 NOT IN (2, 5, 6, 7, 8, 9)
"""

STOPPED = f"""
    WITH placed AS (
        SELECT *, min(CASE WHEN o_orderkey % {BAD_EVERY} = {BAD_AT} THEN o_orderkey END)
                  OVER (PARTITION BY o_orderkey // {FILE_LINES}) AS first_bad
        FROM orders
    )
    SELECT o_orderkey AS rec_id, o_orderpriority AS rec_name, o_orderstatus AS rec_group,
           {AMOUNT} AS amount, {DAY} AS rec_date
    FROM placed WHERE first_bad IS NULL OR o_orderkey < first_bad
"""

PROP = "CAST(json_extract_string(props, '$.k') AS BIGINT)"

ORACLES: dict[str, str] = {
    "records_end_to_end": """
        SELECT o_orderstatus AS rec_group,
               count(*) FILTER (o_orderkey % 50 <> 5) AS records,
               count(*) FILTER (o_orderkey % 50 NOT IN (2, 5, 6, 7, 8, 9)) AS published,
               count(*) FILTER (o_orderkey % 50 NOT IN (2, 5, 6, 7, 8, 9)) AS processed,
               count(s_suppkey) FILTER (o_orderkey % 50 NOT IN (2, 5, 6, 7, 8, 9)) AS matched
        FROM orders LEFT JOIN supplier ON o_orderkey = s_suppkey
        GROUP BY o_orderstatus
    """,
    "extract_ordered": RECORDS,
    "delimited_roundtrip": RECORDS,
    "delimited_ordered_files": """
        SELECT row_number() OVER (ORDER BY o_orderstatus, o_orderkey) AS place, o_orderkey AS rec_id FROM orders
    """,
    "delimited_text_roundtrip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "run_summary": "SELECT o_orderstatus AS rec_group, count(*) AS records FROM orders GROUP BY 1",
    "land_and_check": """
        SELECT o_orderstatus AS rec_group, count(*) AS records, count(s_suppkey) AS matched
        FROM orders LEFT JOIN supplier ON o_orderkey = s_suppkey GROUP BY 1
    """,
    "land_reordered": """
        SELECT o_totalprice, o_orderstatus, o_custkey, o_orderkey, s_suppkey IS NOT NULL AS "exists"
        FROM orders LEFT JOIN supplier ON o_orderkey = s_suppkey
    """,
    "split_extract": """
        SELECT o_orderkey, CASE WHEN o_orderkey % 10 < 9 THEN o_custkey ELSE o_orderkey * o_orderkey END AS k FROM orders
    """,
    "document_lines": r"""
        SELECT doc_id, CAST(len(string_split_regex(text, '\r\n|\r|\n')) AS BIGINT) AS n_lines,
               array_to_string(string_split_regex(text, '\r\n|\r|\n'), chr(10)) AS joined
        FROM documents
    """,
    "lines_roundtrip": RECORDS,
    "parse_records": PARSED,
    "parse_records_compat": f"""
        SELECT CAST(o_orderkey AS INTEGER) AS rec_id, o_orderpriority AS rec_name,
               CASE WHEN o_orderkey % 50 = 1 THEN '' ELSE o_orderstatus END AS rec_group,
               CASE WHEN o_orderkey % 50 = 9 THEN CAST(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR) || '9' AS DOUBLE)
                    ELSE {AMOUNT} END AS amount,
               CASE WHEN o_orderkey % 50 = 8 THEN {DAY} || 'Tjunk' ELSE {DAY} END AS rec_date
        FROM orders WHERE o_orderkey % 50 NOT IN (0, 2, 5, 6, 7)
    """,
    "parse_rejects": """
        SELECT CASE WHEN o_orderkey % 50 IN (2, 9) THEN 'bad_amount' WHEN o_orderkey % 50 = 6 THEN 'short'
                    WHEN o_orderkey % 50 = 8 THEN 'bad_rec_date' ELSE 'bad_rec_id' END AS reject_reason,
               count(*) AS records
        FROM orders WHERE o_orderkey % 50 IN (2, 6, 7, 8, 9) GROUP BY 1
    """,
    "parse_records_stop_file": STOPPED,
    "message_roundtrip": RECORDS,
    "message_field": f"SELECT event_id, {PROP} AS k FROM events",
    "message_rejects": """
        SELECT event_id, CASE event_id % 50 WHEN 1 THEN 'unknown_field' ELSE 'bad_json' END AS reject_reason
        FROM events WHERE event_id % 50 IN (0, 1, 2)
    """,
    "message_accepts": f"SELECT event_id, {PROP} AS k FROM events WHERE event_id % 50 NOT IN (0, 1, 2)",
    "published_result": """
        SELECT 'Published ' || count(*) || ' messages' AS result
        FROM orders WHERE o_orderkey % 50 NOT IN (2, 5, 6, 7, 8, 9)
    """,
    "processed_result": """
        SELECT count(*) AS records, count(s_suppkey) AS matched FROM orders LEFT JOIN supplier ON o_orderkey = s_suppkey
    """,
    "lookup_exists": """
        SELECT c_custkey, c_name, s_suppkey IS NOT NULL AS "exists", CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name,
               CAST(s_nationkey AS VARCHAR) AS s_nationkey
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
    """,
    "lookup_disabled": 'SELECT c_custkey, c_name, true AS "exists" FROM customer',
    "lookup_large_table": """
        SELECT o_orderkey, o_custkey, c_custkey IS NOT NULL AS "exists", c_name
        FROM orders LEFT JOIN customer ON o_orderkey = c_custkey
    """,
    "lookup_status": """
        SELECT c_custkey, coalesce(s_acctbal >= 0 AND s_nationkey < 20, false) AS "exists"
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
    """,
    "lookup_answer_text": f"""
        SELECT c_custkey, '{ENDPOINT}/employee/' || c_custkey AS url,
               c_custkey % 5 IN (0, 1) AS by_text, c_custkey % 5 IN (0, 1, 2) AS by_field,
               'Employee ' || c_custkey || ' (' || c_name || '): ' || CASE c_custkey % 5
                   WHEN 1 THEN '{{"exists":true}}' WHEN 2 THEN '{{"exists" : true}}'
                   WHEN 3 THEN '{{"exists": false}}' ELSE '{{"exists": true}}' END AS log_line
        FROM customer
    """,
    "lookup_address": f"SELECT c_custkey, '{ENDPOINT}/employee/' || c_custkey AS url FROM customer",
    "lookup_external": """
        SELECT c_custkey, c_nationkey, c_nationkey < 10 AS "exists",
               CASE WHEN c_nationkey < 15 THEN '200' WHEN c_nationkey < 20 THEN '404' END AS status,
               CASE WHEN c_nationkey < 10 THEN '{"exists": true}'
                    WHEN c_nationkey < 20 THEN '{"exists": false}' END AS answer,
               CASE WHEN c_nationkey >= 20 THEN 'no answer' END AS error
        FROM customer
    """,
    "lookup_request_count": """
        SELECT 'extract' AS stage, count(DISTINCT c_nationkey) AS records FROM customer
        UNION ALL
        SELECT 'message', count(DISTINCT c_nationkey) FROM customer
    """,
    "distinct_values": "SELECT DISTINCT c_mktsegment FROM customer",
    "first_record": f"{RECORDS} ORDER BY rec_id LIMIT 1",
    "top_n": f"{RECORDS} ORDER BY amount DESC, rec_id LIMIT 100",
    "message_batches": """
        SELECT event_id, event_type,
               (row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1) // 10 AS batch
        FROM events
    """,
    "unseen_files": """
        SELECT 'data/' || c_custkey || '.csv' AS path FROM customer
        WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)
    """,
    "unseen_index": """
        SELECT 'data/' || c_custkey || '.csv' AS path, way FROM customer, (VALUES ('segments'), ('merged')) AS ways(way)
        WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = c_custkey)
    """,
    "path_filter": """
        SELECT page_id, url FROM pages WHERE starts_with(url, 'https://') AND ends_with(url, '.html')
    """,
    "contract_check": """
        SELECT 'l_orderkey_unique' AS rule, count(l_orderkey) - count(DISTINCT l_orderkey) AS violations FROM lineitem
        UNION ALL SELECT 'l_orderkey_present', count(*) FILTER (l_orderkey IS NULL) FROM lineitem
        UNION ALL SELECT 'l_returnflag_present', count(*) FILTER (l_returnflag IS NULL) FROM lineitem
        UNION ALL SELECT 'l_shipdate_present', count(*) FILTER (l_shipdate IS NULL) FROM lineitem
        UNION ALL SELECT 'l_linestatus_length', count(*) FILTER (length(l_linestatus) > 1) FROM lineitem
        UNION ALL SELECT 'l_extendedprice_range', count(*) FILTER (abs(round(l_extendedprice, 2)) >= 10000) FROM lineitem
        UNION ALL SELECT 'l_quantity_range', count(*) FILTER (abs(round(l_quantity, 2)) >= 100) FROM lineitem
    """,
    "contract_check_text": """
        SELECT 'doc_id_unique' AS rule, count(doc_id) - count(DISTINCT doc_id) AS violations FROM documents
        UNION ALL SELECT 'doc_id_present', count(*) FILTER (doc_id IS NULL) FROM documents
        UNION ALL SELECT 'text_present', count(*) FILTER (text IS NULL) FROM documents
        UNION ALL SELECT 'lang_present', count(*) FILTER (lang IS NULL) FROM documents
        UNION ALL SELECT 'text_length', count(*) FILTER (length(text) > 1000) FROM documents
        UNION ALL SELECT 'source_length', count(*) FILTER (length(source) > 5) FROM documents
    """,
    "reload_table_dense_key": """
        SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS row_id, o_orderkey, o_totalprice FROM orders
    """,
    "reload_table_copies": """
        SELECT row_number() OVER (ORDER BY l_returnflag, l_linestatus) AS row_id, l_returnflag, l_linestatus
        FROM lineitem
    """,
    "catalog_table": RECORDS,
    "stream_files": PARSED,
    "stream_publish": PARSED,
    "stream_publish_stop_file": STOPPED,
    "stream_publish_rejects": """
        SELECT CASE WHEN o_orderkey % 50 IN (2, 9) THEN 'bad_amount' WHEN o_orderkey % 50 = 6 THEN 'short'
                    WHEN o_orderkey % 50 = 8 THEN 'bad_rec_date' WHEN o_orderkey % 50 = 7 THEN 'bad_rec_id'
                    ELSE 'none' END AS reject_reason,
               count(*) AS records
        FROM orders WHERE o_orderkey % 50 <> 5 GROUP BY 1
    """,
    "stream_files_stop_file": STOPPED,
    "nested_files": """
        SELECT o_orderkey AS rec_id, way FROM orders, (VALUES ('batch'), ('stream')) AS ways(way)
        WHERE o_orderkey % 50 NOT IN (2, 5, 6, 7, 8, 9)
    """,
    "stream_dedupe": """
        SELECT user_id % 10 AS g, 'keyed' AS kind, count(*) AS records
        FROM events WHERE event_id % 50 > 1 GROUP BY 1
        UNION ALL
        SELECT user_id % 10, 'no_key', 2 * count(*) FROM events WHERE event_id % 50 = 1 GROUP BY 1
        UNION ALL
        SELECT -1, 'bad_json', 2 * count(*) FROM events WHERE event_id % 50 = 0
    """,
    "stream_messages": f"""
        SELECT 'none' AS reject_reason, {PROP} AS k, count(*) AS records
        FROM events WHERE event_id % 50 NOT IN (0, 1, 2) GROUP BY 2
        UNION ALL
        SELECT CASE event_id % 50 WHEN 1 THEN 'unknown_field' ELSE 'bad_json' END, -1, count(*)
        FROM events WHERE event_id % 50 IN (0, 1, 2) GROUP BY 1
    """,
    "stream_lookup": """
        SELECT c_custkey, c_name, s_suppkey IS NOT NULL AS "exists", s_name
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey
    """,
    "stream_retry": """
        SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'given_up' ELSE 'acknowledged' END AS status,
               CASE event_id % 10 WHEN 0 THEN 3 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 1 END AS attempts,
               CASE event_id % 10 WHEN 0 THEN 'no answer' ELSE 'none' END AS error
        FROM events
    """,
    "stream_file_events": PARSED,
    "stream_receives": """
        WITH parts AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS part FROM events),
        placed AS (SELECT *, row_number() OVER (PARTITION BY part ORDER BY event_id) - 1 AS i FROM parts)
        SELECT part * (SELECT count(*) FROM parts WHERE part = 0) + i // 10 * 10 AS receive, count(*) AS records,
               min(event_id) AS first_event, max(event_id) AS last_event
        FROM placed GROUP BY 1
    """,
    "stream_lookup_large": """
        SELECT o_orderkey, o_custkey, c_custkey IS NOT NULL AS "exists", c_name
        FROM orders LEFT JOIN customer ON o_orderkey = c_custkey
    """,
    "stream_lookup_versions": """
        SELECT c_custkey, c_name, s_suppkey IS NOT NULL AS "exists", s_name, c_custkey % 2 + 1 AS version
        FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey AND (c_custkey % 2 = 1 OR s_acctbal > 0)
    """,
    "stream_progress": """
        WITH kinds AS (SELECT CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END AS batch_id, event_id % 50 <> 0 AS good FROM events)
        SELECT batch_id, 'received' AS stage, 'records' AS "count", count(*) AS "value" FROM kinds GROUP BY 1
        UNION ALL
        SELECT batch_id, 'received', 'handled', count(*) FILTER (good) FROM kinds GROUP BY 1
    """,
    "lookup_rules": """
        WITH fitting AS (
            SELECT c_custkey, s_nationkey % 8 AS priority, s_suppkey % 3 AS kind, s_acctbal > 0 AS found, s_name AS answer
            FROM customer JOIN supplier ON CASE s_suppkey % 3
                WHEN 0 THEN c_custkey = s_suppkey
                WHEN 1 THEN c_custkey BETWEEN s_suppkey * 7 AND s_suppkey * 7 + s_nationkey * 5
                ELSE starts_with(CAST(c_custkey AS VARCHAR), CAST(s_suppkey AS VARCHAR)) END
            UNION ALL SELECT c_custkey, 6, 3, false, 'nobody' FROM customer
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY c_custkey
                ORDER BY priority, CASE kind WHEN 0 THEN 0 WHEN 2 THEN 1 WHEN 1 THEN 2 ELSE 3 END, found, answer) AS place
            FROM fitting
        )
        SELECT c_custkey, found AS "exists", CASE kind WHEN 0 THEN 'exact' WHEN 1 THEN 'range' WHEN 2 THEN 'prefix' ELSE 'any' END AS rule,
               answer
        FROM ranked WHERE place = 1
    """,
    **USER_SQL,
    "sql_price_summary": """
        SELECT l_returnflag, l_linestatus, count(*) AS n_lines,
               CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS sum_qty, max(l_extendedprice) AS max_price
        FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02 00:00:00'
        GROUP BY l_returnflag, l_linestatus
    """,
}
