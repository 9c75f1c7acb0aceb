"""DuckDB SQL twins of the stand-in queries (same column names and types).

Written independently of the Spark code from the operator definitions; the
driver runs both at sf0.01 and compares row count, schema and values.
"""

from __future__ import annotations

EPOCH = "TIMESTAMP '2011-01-01 00:00:00'"


def _unnest_outer(src: str, keep: str, arr: str, idx: str, val: str) -> str:
    """Positional unnest that keeps NULL/empty arrays as one NULL row (outer flatten)."""
    return (f"SELECT {keep}, CAST(generate_subscripts({arr}, 1) - 1 AS INTEGER) AS {idx}, "
            f"unnest({arr}) AS {val} FROM {src} WHERE len({arr}) > 0 "
            f"UNION ALL SELECT {keep}, CAST(NULL AS INTEGER) AS {idx}, NULL AS {val} FROM {src} "
            f"WHERE {arr} IS NULL OR len({arr}) = 0")


_LAST_OF_DAY = """
SELECT user_id, event_type, date, event_id, ts, value FROM (
  SELECT user_id, event_type, CAST(ts AS DATE) AS date, event_id, ts, value,
         row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE)
                            ORDER BY CAST(ts AS DATE) DESC NULLS FIRST, ts DESC NULLS FIRST,
                                     event_id DESC NULLS FIRST) AS rn
  FROM events) WHERE rn = 1
"""

_CHECK_FAILURES = {
    "check_not_null": "SELECT o_orderkey, CAST(NULL AS VARCHAR) AS status FROM orders "
                      "WHERE nullif(o_orderstatus, 'P') IS NULL",
    "check_unique": "SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)) "
                    "AS line_key, count(*) AS n_records FROM lineitem GROUP BY 1 HAVING count(*) > 1",
    "check_accepted_values": "SELECT o_orderkey, o_orderstatus FROM orders "
                             "WHERE o_orderstatus IS NOT NULL AND o_orderstatus NOT IN ('F', 'O')",
    "check_relationships": "SELECT d.doc_id FROM documents d WHERE d.doc_id IS NOT NULL AND NOT EXISTS "
                           "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "check_expression": "SELECT l_orderkey, l_linenumber, l_discount FROM lineitem "
                        "WHERE NOT (l_discount <= 0.08)",
}


def _pairs(src: str, keep: str, arr: str, n_expr: str) -> str:
    return (f"SELECT {keep}, CAST(j AS INTEGER) AS pair_idx, {arr}[2*j+1] AS k, {arr}[2*j+2] AS v "
            f"FROM (SELECT {keep}, {arr}, unnest(range({n_expr})) AS j FROM {src})")


_POS = "(SELECT vec_id, list_filter(embedding, lambda x: x > 0) AS arr FROM embeddings)"


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["json_path_extract"] = "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
    q["variant_as_text"] = ("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, CAST(json(props) AS VARCHAR) AS doc, "
                            "'[' || event_id || ',null]' AS arr FROM events")
    q["ndjson_round_trip"] = ("SELECT event_id, ts, user_id, event_type, value, "
                              "CAST(json_extract(props, '$.k') AS BIGINT) AS k, "
                              "DATE '2024-02-01' AS ingest_dt FROM events")
    q["ndjson_bad_lines"] = ("SELECT 'JSON_PARSE_ERROR' AS reason_code, count(*) AS n_lines "
                             "FROM events WHERE event_type = 'error'")
    q["load_status"] = ("SELECT 'Loaded rows: ' || CAST(count(*) AS VARCHAR) AS status FROM events "
                        "WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)")
    q["flatten_inner"] = ("SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS idx, "
                          "unnest(embedding) AS value FROM embeddings")
    q["flatten_outer"] = (
        "WITH n AS (SELECT page_id, regexp_extract_all(array_to_string("
        "regexp_extract_all(html, '<title>([^<]*)</title>', 1), ' '), '[0-9]+') AS nums FROM pages) "
        + _unnest_outer("n", "page_id", "nums", "idx", "token"))
    q["flatten_nested_assets"] = (
        "WITH c AS (SELECT conv_id, turn, role, string_split(text, chr(10)) AS lines FROM conversations), "
        "l AS (" + _unnest_outer("c", "conv_id, turn, role", "lines", "line_idx", "line") + "), "
        "a AS (SELECT conv_id, turn, role, line_idx, string_split(line, ' ') AS words, "
        "regexp_extract_all(line, '[0-9]+') AS numbers FROM l), "
        "w AS (" + _unnest_outer("a", "conv_id, turn, role, line_idx", "words", "asset_idx", "token") + "), "
        "n AS (" + _unnest_outer("a", "conv_id, turn, role, line_idx", "numbers", "asset_idx", "token") + ") "
        "SELECT conv_id, turn, role, line_idx, 'word' AS asset_type, asset_idx, token FROM w "
        "UNION ALL SELECT conv_id, turn, role, line_idx, 'number' AS asset_type, asset_idx, token FROM n")
    q["pair_decode_full"] = _pairs(_POS, "vec_id", "arr", "(len(arr) + 1) // 2")
    q["pair_decode_strict"] = _pairs(_POS, "vec_id", "arr", "len(arr) // 2")
    q["pair_decode_groupby"] = q["pair_decode_full"]
    q["channel_decode"] = (
        "WITH c AS (SELECT vec_id, ch.channel, list_slice(embedding, 1 + (len(embedding) // 4) * ch.i, "
        "CASE WHEN ch.i = 3 THEN len(embedding) ELSE (len(embedding) // 4) * (ch.i + 1) END) AS s "
        "FROM embeddings, (VALUES ('A', 0), ('B', 1), ('C', 2), ('D', 3)) AS ch(channel, i)) "
        + _pairs("c", "vec_id, channel", "s", "len(s) // 2"))
    m = f"datediff('minute', {EPOCH}, l_shipdate)"
    q["text_series_decode"] = (
        f"SELECT l_orderkey, l_linenumber, 0 AS pair_idx, {EPOCH} + to_minutes({m}) AS snapshot_ts, "
        f"CAST(l_partkey AS DECIMAL(38,0)) AS value FROM lineitem "
        f"UNION ALL SELECT l_orderkey, l_linenumber, 1, {EPOCH} + to_minutes({m} + l_linenumber), "
        f"CAST(l_suppkey AS DECIMAL(38,0)) FROM lineitem "
        f"UNION ALL SELECT l_orderkey, l_linenumber, 2, "
        f"CASE WHEN TRY_CAST(l_linestatus AS DECIMAL(38,0)) IS NULL THEN NULL "
        f"ELSE {EPOCH} + to_minutes(CAST(TRY_CAST(l_linestatus AS DECIMAL(38,0)) AS BIGINT)) END, "
        f"CAST(l_orderkey AS DECIMAL(38,0)) FROM lineitem")
    em = f"datediff('minute', {EPOCH}, ts)"
    q["minutes_to_ts"] = (
        f"SELECT event_id, {em} AS minutes, {EPOCH} + to_minutes({em}) AS ts_minute, "
        f"CAST(date_trunc('month', {EPOCH} + to_minutes({em})) AS DATE) AS month, "
        f"CAST({EPOCH} + to_minutes({em}) AS DATE) AS day FROM events")
    q["sentinel_to_null"] = ("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN NULL "
                             "ELSE CAST(c_acctbal AS DECIMAL(18,2)) END AS acctbal, "
                             "CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END AS was_sentinel FROM customer")
    q["price_band_filter"] = ("SELECT c_custkey, c_acctbal FROM customer "
                              "WHERE c_acctbal < 0 OR (c_acctbal > 0 AND c_acctbal <= 400)")
    q["full_outer_series"] = ("SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.lang, d.n_chars, "
                              "l.quality, l.toxic FROM documents d FULL OUTER JOIN labels l "
                              "ON d.doc_id = l.doc_id")
    q["left_enrich_latest"] = (
        "WITH o AS (SELECT o_orderkey, o_custkey, o_orderstatus, row_number() OVER ("
        "PARTITION BY o_orderkey ORDER BY o_orderdate DESC NULLS FIRST, o_totalprice DESC NULLS FIRST) AS rn "
        "FROM orders) SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_quantity, o.o_custkey, "
        "o.o_orderstatus FROM lineitem l LEFT JOIN o ON l.l_orderkey = o.o_orderkey AND o.rn = 1")
    q["latest_per_key"] = (
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM ("
        "SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS FIRST, "
        "o_orderkey DESC NULLS FIRST) AS rn FROM orders) WHERE rn = 1")
    q["last_of_day"] = _LAST_OF_DAY
    q["first_by_value_of_day"] = ("SELECT user_id, CAST(ts AS DATE) AS date, min(event_type) AS event_type "
                                  "FROM events GROUP BY 1, 2")
    q["lag_parent"] = ("SELECT n_nationkey, n_name, n_regionkey, lag(n_nationkey) OVER ("
                       "PARTITION BY n_regionkey ORDER BY n_nationkey) AS parent_nationkey FROM nation")
    q["monthly_latest"] = (
        "SELECT o_custkey, order_month, o_orderkey, o_totalprice FROM ("
        "SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS order_month, o_orderkey, "
        "o_totalprice, row_number() OVER (PARTITION BY o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) "
        "ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey DESC NULLS FIRST) AS rn FROM orders) WHERE rn = 1")
    q["dim_distinct"] = "SELECT DISTINCT p_brand, p_type FROM part"
    q["distinct_sellers"] = "SELECT DISTINCT l_suppkey FROM lineitem WHERE l_suppkey IS NOT NULL"
    q["bridge_product_category"] = (
        "SELECT md5(CAST(l_partkey AS VARCHAR) || '|' || CAST(l_suppkey AS VARCHAR)) AS pk, "
        "l_partkey, l_suppkey FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem)")
    q["surrogate_key"] = (
        "SELECT o_orderkey, md5(CAST(o_orderkey AS VARCHAR) || '|' || CAST(o_custkey AS VARCHAR) || '|' || "
        "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%g')) AS key_plain, "
        "md5(CAST(o_orderkey AS VARCHAR) || '|' || nullif(o_orderstatus, 'P')) AS key_nullable, "
        "md5(CAST(o_orderkey AS VARCHAR) || '|' || coalesce(nullif(o_orderstatus, 'P'), 'NULL')) AS key_token "
        "FROM orders")
    q["fact_filtered"] = (
        "SELECT md5(CAST(event_id AS VARCHAR) || '|' || CAST(CAST(ts AS DATE) AS VARCHAR) || "
        "'|EVENT_VALUE_DAILY') AS pk, event_id, user_id, value FROM events "
        "WHERE value IS NOT NULL AND value >= 0")
    q["upsert_incremental"] = (
        "SELECT event_id, ts, user_id, event_type, "
        "CASE WHEN ts >= TIMESTAMP '2024-01-10 00:00:00' THEN value * 2 ELSE value END AS value, "
        "CASE WHEN ts >= TIMESTAMP '2024-01-10 00:00:00' THEN DATE '2024-01-31' ELSE DATE '2024-01-20' END "
        "AS ingest_ts FROM events")
    q["upsert_late_load"] = q["upsert_incremental"]
    keyed = ("SELECT event_id, ts, CASE WHEN event_id % 10 <> 0 THEN user_id END AS user_id, "
             "nullif(event_type, 'error') AS event_type, value FROM events")
    q["upsert_null_keys"] = f"SELECT * FROM ({keyed}) WHERE user_id IS NULL OR event_type IS NULL"
    q["upsert_null_safe"] = (
        f"SELECT event_id, ts, user_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_type "
        f"ORDER BY ts DESC NULLS FIRST, event_id DESC NULLS FIRST) AS rn FROM ({keyed})) WHERE rn = 1")
    q["full_refresh_replaces"] = ("SELECT event_id, ts, value, CAST(ts AS DATE) AS date FROM events WHERE day(ts) <= 5")
    q["upsert_moved_partition"] = (
        "SELECT event_id, value, CASE WHEN day(ts) = 7 OR event_id % 50 = 0 THEN CAST(ts AS DATE) + 400 "
        "ELSE CAST(ts AS DATE) END AS date FROM events")
    q["strict_event_date"] = (
        "WITH l1 AS (SELECT event_id, ts, value, DATE '2024-01-20' AS ingest_ts FROM events "
        "WHERE ts < TIMESTAMP '2024-01-20 00:00:00'), "
        "l2 AS (SELECT event_id, ts, value * 2 AS value, DATE '2024-01-31' AS ingest_ts FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-10 00:00:00') "
        "SELECT * FROM l1 UNION ALL SELECT * FROM l2 "
        "WHERE CAST(ts AS DATE) > (SELECT max(CAST(ts AS DATE)) FROM l1)")
    q["offset_self_join"] = q["pair_decode_strict"]
    q["lag_parent_hot"] = (
        "SELECT *, lag(l_orderkey) OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey) "
        "AS previous_order FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem)")
    q["load_lineage"] = ("SELECT DATE '2024-02-01' AS ingest_dt, count(*) AS n_rows, count(*) AS n_named, count(*) AS n_paths, "
                         "count(*) AS n_dated FROM events")
    q["json_array_load"] = "SELECT c_custkey, c_name, c_nationkey FROM customer"
    q["json_array_split"] = ("SELECT s_nationkey, l_orderkey, l_linenumber, l_suppkey, l_extendedprice, s_name, l_returnflag AS flag "
                             "FROM lineitem JOIN supplier ON l_suppkey = s_suppkey")
    bad = " UNION ALL ".join(f"SELECT count(*) > 0 AS f FROM ({sql})" for sql in _CHECK_FAILURES.values())
    q["run_monitoring_row"] = (
        f"SELECT 'histmart_daily' AS dag_id, 'run-1' AS run_id, CASE WHEN bool_or(f) THEN 'success_with_warnings' ELSE 'success' END "
        f"AS status, CAST(count(*) FILTER (NOT f) AS INTEGER) AS tests_passed, CAST(count(*) FILTER (f) AS INTEGER) AS tests_failed, "
        f"(SELECT count(*) FROM lineitem) AS rows_loaded_raw FROM ({bad})")
    q["view_materialised"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"
    q["empty_text_filter"] = "SELECT event_id, event_type AS t FROM events WHERE event_type <> 'error'"
    q["stored_failures"] = "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0"
    q["append_boundary"] = (
        "WITH l1 AS (SELECT event_id, ts, value, DATE '2024-01-20' AS ingest_ts FROM events "
        "WHERE ts < TIMESTAMP '2024-01-20 00:00:00'), "
        "l2 AS (SELECT event_id, ts, value * 2 AS value, DATE '2024-01-31' AS ingest_ts FROM events "
        "WHERE ts >= TIMESTAMP '2024-01-10 00:00:00') "
        "SELECT * FROM l1 UNION ALL SELECT * FROM l2 "
        "WHERE CAST(ts AS DATE) >= (SELECT max(CAST(ts AS DATE)) FROM l1)")
    li_rule = ("CASE WHEN l_discount > 0.08 THEN 'DISCOUNT_HIGH' WHEN l_tax = 0 THEN 'TAX_ZERO' "
               "WHEN l_returnflag = 'R' THEN 'RETURNED' END")
    li_id = ("md5(coalesce(CAST(l_orderkey AS VARCHAR), 'NULL') || '|' || "
             "coalesce(CAST(l_linenumber AS VARCHAR), 'NULL') || '|' || "
             "coalesce(CAST(l_partkey AS VARCHAR), 'NULL') || '|' || coalesce(CAST(l_suppkey AS VARCHAR), 'NULL'))")
    q["quarantine_split"] = (
        f"SELECT {li_id} AS bad_row_id, l_orderkey, l_linenumber, l_partkey, l_suppkey, "
        f"{li_rule} AS reason_code, 'line item rule failure' AS reason_detail FROM lineitem "
        f"WHERE {li_rule} IS NOT NULL")
    q["quarantine_good"] = (
        f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount, l_tax FROM lineitem "
        f"WHERE {li_rule} IS NULL")
    q["quarantine_union"] = (
        f"SELECT 'lineitem' AS table_name, {li_id} AS bad_row_id, CAST(l_orderkey AS VARCHAR) AS entity_key, "
        f"{li_rule} AS reason_code, 'line item rule failure' AS reason_detail, "
        f"CAST(l_linenumber AS INTEGER) AS l_linenumber FROM lineitem WHERE {li_rule} IS NOT NULL "
        "UNION ALL SELECT 'customer', md5(coalesce(CAST(c_custkey AS VARCHAR), 'NULL')), "
        "CAST(c_custkey AS VARCHAR), 'BALANCE_NEGATIVE', 'customer rule failure', NULL "
        "FROM customer WHERE c_acctbal < 0 "
        "UNION ALL SELECT 'labels', md5(coalesce(CAST(doc_id AS VARCHAR), 'NULL')), CAST(doc_id AS VARCHAR), "
        "CASE WHEN toxic = 1 THEN 'TOXIC' ELSE 'LOW_QUALITY' END, 'label rule failure', NULL "
        "FROM labels WHERE toxic = 1 OR quality = 0")
    q.update(_CHECK_FAILURES)
    q["run_metrics"] = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS failures, "
        f"CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status FROM ({sql})"
        for name, sql in _CHECK_FAILURES.items())
    q["stream_last_of_day"] = _LAST_OF_DAY
    q["stream_windowed_drop"] = _LAST_OF_DAY
    q["stream_dedup"] = "SELECT event_id, ts, user_id, event_type, value FROM events"
    q["load_once"] = ("SELECT CASE WHEN event_type IN ('purchase', 'error') THEN 1 ELSE 0 END AS load, event_id, value, "
                      "DATE '2024-02-01' AS ingest_dt FROM events")
    q["upsert_bucketed"] = q["upsert_late_load"]
    q["stored_failures_rerun"] = ("SELECT 'negative_balance' AS check_name, 'run-2' AS run_id, c_custkey FROM customer WHERE c_acctbal < 0")
    q["change_feed"] = (
        "WITH l1 AS (SELECT event_id, ts, user_id, event_type, value, DATE '2024-01-20' AS ingest_ts FROM events "
        "WHERE ts < TIMESTAMP '2024-01-20 00:00:00'), "
        "l2 AS (SELECT event_id, ts, user_id, event_type, CASE WHEN event_id % 4 = 0 THEN value * 2 / 2 ELSE value * 2 END AS value, "
        "DATE '2024-01-31' AS ingest_ts FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00'), "
        "a AS (SELECT * FROM l1 WHERE event_id % 9 <> 0 AND event_id NOT IN (SELECT event_id FROM l2) UNION ALL SELECT * FROM l2) "
        "SELECT CASE WHEN l1.event_id IS NULL THEN 'insert' WHEN a.event_id IS NULL THEN 'delete' ELSE 'update' END AS change, "
        "coalesce(a.event_id, l1.event_id) AS event_id, CASE WHEN a.event_id IS NULL THEN l1.ts ELSE a.ts END AS ts, "
        "CASE WHEN a.event_id IS NULL THEN l1.user_id ELSE a.user_id END AS user_id, "
        "CASE WHEN a.event_id IS NULL THEN l1.event_type ELSE a.event_type END AS event_type, "
        "CASE WHEN a.event_id IS NULL THEN l1.value ELSE a.value END AS value, "
        "CASE WHEN a.event_id IS NULL THEN l1.ingest_ts ELSE a.ingest_ts END AS ingest_ts "
        "FROM l1 FULL OUTER JOIN a ON a.event_id = l1.event_id WHERE l1.event_id IS NULL OR a.event_id IS NULL "
        "OR l1.ts IS DISTINCT FROM a.ts OR l1.user_id IS DISTINCT FROM a.user_id OR l1.event_type IS DISTINCT FROM a.event_type "
        "OR l1.value IS DISTINCT FROM a.value")
    one_scan = {
        "orders_key_unique": "SELECT 1 FROM orders WHERE o_orderkey IS NOT NULL GROUP BY o_orderkey HAVING count(*) > 1",
        "orders_customer_unique": "SELECT 1 FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey HAVING count(*) > 1",
        "orders_status_values": "SELECT 1 FROM orders WHERE o_orderstatus NOT IN ('F', 'O')",
        "orders_customer": "SELECT 1 FROM orders o WHERE o_custkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o.o_custkey)",
        "lineitem_order": "SELECT 1 FROM lineitem l WHERE l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l.l_orderkey)",
        "lineitem_discount": "SELECT 1 FROM lineitem WHERE NOT (l_discount <= 0.08)",
        "lineitem_negative_price": "SELECT 1 FROM lineitem WHERE l_extendedprice < 0",
        "events_type": "SELECT 1 FROM events WHERE nullif(event_type, 'error') IS NULL",
        "events_user": "SELECT 1 FROM events WHERE user_id IS NULL OR event_id % 10 = 0",
        "documents_label": "SELECT 1 FROM documents d WHERE doc_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM labels WHERE doc_id = d.doc_id)",
        "customer_balance": "SELECT 1 FROM customer WHERE c_acctbal < 0",
    }
    q["checks_one_scan"] = " UNION ALL ".join(
        f"SELECT '{name}' AS check_name, count(*) AS failures, CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS status FROM ({sql})"
        for name, sql in one_scan.items())
    q["stream_windowed_last_of_day"] = _LAST_OF_DAY
    return q
