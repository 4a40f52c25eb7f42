"""DuckDB SQL that says what each query must return."""

from sluice.synth import PRIME, STATUSES, between_sql, draw_sql

ORACLE: dict[str, str] = {}


def _add(**queries: str) -> None:
    ORACLE.update({name: " ".join(sql.split()) for name, sql in queries.items()})


_LABELLED = "documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"
_OLD = "SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
_NEW = """SELECT o_orderkey, 'U' AS o_orderstatus, o_totalprice + 1 AS o_totalprice, o_orderdate,
       o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'"""
_UPSERT = f"""WITH t AS ({_OLD}), s AS ({_NEW})
    SELECT o_orderkey, o_orderstatus, o_totalprice FROM s
    UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM t
    WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)"""
_LOG = """SELECT ts, 'user-' || user_id AS job_name,
    CASE WHEN event_type IN ('view', 'click') THEN 'FULL' ELSE 'INCREMENTAL' END AS ingestion_type,
    'SUCCESS' AS status, event_id AS source_count, value AS duration FROM events"""
_LATEST = """SELECT user_id, event_id, event_type FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""
_ORDERS = "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders"

_add(
    scan_parquet="SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
    scan_csv_inferred="SELECT * FROM customer",
    scan_csv_declared="SELECT * FROM orders",
    csv_bounded_by_timestamp="""SELECT event_id, ts, event_type, value, 'run-1' AS _ingestion_id
        FROM events WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    scan_json_pages="SELECT conv_id, turn, role, text FROM conversations",
    scan_nested_documents="""SELECT l_orderkey AS order_id, COUNT(*) AS n_lines,
        SUM(CAST(l_quantity AS BIGINT))::BIGINT AS qty FROM lineitem GROUP BY l_orderkey""",
    rest_page_scan="SELECT conv_id, turn, role, text FROM conversations",
    rest_cursor_scan="SELECT page_id, url, html FROM pages",
    extract_records_by_path="""SELECT event_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    extension_source="SELECT p_partkey, p_retailprice FROM part",
)
_add(
    incremental_numeric="SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 599",
    incremental_timestamp="""SELECT event_id, ts FROM events
        WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    incremental_string="SELECT c_custkey, c_name FROM customer WHERE c_name > 'Customer#000000090'",
    full_load="SELECT event_id, user_id FROM events",
    next_watermark="""SELECT 'events' AS job_name, MAX(ts) AS next_value FROM events
        WHERE ts > TIMESTAMP '2024-01-15 00:00:00'""",
    enrich_metadata="""SELECT o_orderkey, 'run-1' AS _ingestion_id, 'FULL' AS _ingestion_type,
        'parquet' AS _source_name, 'SUCCESS' AS _ingestion_status,
        TIMESTAMP '2025-06-01 00:00:00' AS _ingested_at FROM orders""",
    fill_na_numeric=f"""SELECT d.doc_id, COALESCE(quality, 0) AS quality,
        COALESCE(toxic, 0) AS toxic FROM {_LABELLED}""",
    fill_na_string=f"""SELECT d.doc_id, CASE quality WHEN 1 THEN 'good' WHEN 0 THEN 'poor'
        ELSE 'unknown' END AS label FROM {_LABELLED}""",
    upper_case="SELECT event_id, upper(event_type) AS event_type FROM events",
    cast_type="""SELECT event_id, CAST(user_id AS VARCHAR) AS user_id,
        CAST(trunc(value) AS INTEGER) AS value FROM events""",
    try_cast_nulls="""SELECT c_custkey, TRY_CAST(c_name AS BIGINT) AS c_name,
        TRY_CAST(split_part(c_name, '#', 2) AS BIGINT) AS c_number FROM customer""",
    add_ingestion_timestamp="""SELECT o_orderkey, TIMESTAMP '2025-06-01 00:00:00' AS ingested_at
        FROM orders""",
    rule_chain="""SELECT p_partkey, upper(p_name) AS p_name, upper(p_type) AS p_type,
        CAST(p_size AS DOUBLE) AS p_size FROM part""",
    ingest_date_partition="""SELECT CAST(ts AS DATE) AS _ingest_date, COUNT(*) AS n
        FROM events GROUP BY 1""",
    flatten_nested_key="""SELECT event_id AS data_id,
        CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""",
    array_to_strings="""SELECT doc_id, array_to_string(
        [CAST(length(w) AS VARCHAR) for w in string_split(text, ' ')], ',') AS images
        FROM documents""",
    struct_null_normalise=f"""SELECT d.doc_id, quality, quality IS NULL AS missing
        FROM {_LABELLED}""",
    project_nested="SELECT event_id, event_type AS kind, user_id AS author FROM events",
)
_add(
    append_write=f"{_ORDERS} UNION ALL {_ORDERS} WHERE o_orderstatus = 'F'",
    append_plain_files="""SELECT c_custkey, c_mktsegment, 'run-1' AS _ingestion_id FROM customer
        UNION ALL SELECT c_custkey, c_mktsegment, 'run-1' FROM customer""",
    overwrite_write=_ORDERS,
    schema_merge_append="""SELECT o_orderkey, o_orderdate,
        CASE WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    union_by_name="""SELECT c_name AS name, c_acctbal AS acctbal, c_mktsegment,
        NULL::INTEGER AS s_nationkey FROM customer
        UNION ALL SELECT s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
    merge_upsert=_UPSERT,
    merge_by_anti_union=_UPSERT,
    merge_repeated_keys=f"""WITH s AS ({_NEW})
        SELECT l_orderkey AS o_orderkey, l_linenumber,
        CASE WHEN s.o_orderkey IS NULL THEN l_linestatus ELSE 'U' END AS o_orderstatus
        FROM lineitem l LEFT JOIN s ON l.l_orderkey = s.o_orderkey
        UNION ALL SELECT s.o_orderkey, NULL, 'U' FROM s
        WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = s.o_orderkey)""",
    merge_schema_evolution=f"""WITH t AS ({_OLD}), s AS ({_NEW})
        SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
        CASE WHEN s.o_orderkey IS NULL THEN t.o_orderstatus
             WHEN s.o_orderpriority = '5-LOW' THEN NULL ELSE 'U' END AS o_orderstatus,
        t.o_totalprice, s.o_orderpriority AS extra
        FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",
    merge_null_key=f"""SELECT l.doc_id AS k, 'new-' || lang AS v FROM {_LABELLED}
        UNION ALL SELECT NULL AS k, 'old-' || lang AS v FROM {_LABELLED} WHERE l.doc_id IS NULL""",
    merge_first_load="SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    upsert_partitioned_table=f"""WITH t AS ({_OLD}), s AS ({_NEW})
        SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS y FROM s
        UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice,
        CAST(year(o_orderdate) AS INTEGER) FROM t
        WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.o_orderkey = t.o_orderkey)""",
    upsert_evolving_table=f"""WITH t AS ({_OLD}), s AS ({_NEW})
        SELECT COALESCE(s.o_orderkey, t.o_orderkey) AS o_orderkey,
        COALESCE(s.o_orderstatus, t.o_orderstatus) AS o_orderstatus,
        t.o_totalprice, s.o_orderpriority
        FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey""",
    dedupe_latest=_LATEST,
    compact_table="SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders",
    expire_snapshots=f"{_ORDERS} UNION ALL {_ORDERS} WHERE o_orderstatus = 'F'",
    stream_upsert=_LATEST,
)
_add(
    row_count="SELECT COUNT(*) AS total FROM lineitem",
    reconcile_counts="""SELECT 'match' AS scenario, COUNT(*) AS sc, COUNT(*) AS tc,
            'SUCCESS' AS status FROM events
        UNION ALL SELECT 'short', COUNT(*), COUNT(*) FILTER (WHERE event_type <> 'error'), 'FAILED'
            FROM events
        UNION ALL SELECT 'single_row', COUNT(*), COUNT(*), 'SUCCESS' FROM (SELECT MAX(ts) FROM events)
        UNION ALL SELECT 'no_target', COUNT(*), 0, 'FAILED' FROM events""",
    duplicate_keys="""SELECT l_orderkey, COUNT(*) AS n FROM lineitem
        GROUP BY l_orderkey HAVING COUNT(*) > 1""",
    duplicate_rate="""SELECT SUM(c)::BIGINT AS total,
        SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END)::BIGINT AS dups,
        round(SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END) / SUM(c) * 100, 2) AS rate
        FROM (SELECT l_orderkey, COUNT(*) AS c FROM lineitem GROUP BY 1)""",
    duplicate_texts="""SELECT length(text) AS n_chars, n, COUNT(*) AS texts FROM (
        SELECT text, COUNT(*) AS n FROM documents GROUP BY text HAVING COUNT(*) > 1) GROUP BY 1, 2""",
    duplicate_text_rate="""SELECT SUM(c)::BIGINT AS total,
        SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END)::BIGINT AS dups,
        round(SUM(CASE WHEN c > 1 THEN 1 ELSE 0 END) / SUM(c) * 100, 2) AS rate
        FROM (SELECT text, COUNT(*) AS c FROM documents GROUP BY 1)""",
    count_by_type="SELECT event_type, COUNT(*) AS n FROM events GROUP BY event_type",
    audit_append=f"""SELECT job_name, ingestion_type, source_count, NULL::BIGINT AS target_count, ts
        FROM ({_LOG})""",
    audit_throughput=f"""SELECT ts, job_name, status, source_count, duration,
        CASE WHEN duration > 0 THEN round(source_count / duration, 2) END AS speed_rec_per_sec
        FROM ({_LOG})""",
    compare_load_types=f"""SELECT full_avg, incr_avg, round(full_avg - incr_avg, 2) AS saved,
        round((full_avg - incr_avg) / full_avg * 100, 2) AS saved_pct FROM (
        SELECT round(avg(duration) FILTER (WHERE ingestion_type = 'FULL'), 2) AS full_avg,
        round(avg(duration) FILTER (WHERE ingestion_type = 'INCREMENTAL'), 2) AS incr_avg
        FROM ({_LOG}))""",
    scenario_timings=f"""SELECT job_name, COUNT(*) AS runs, MAX(source_count) AS source_count,
        round(avg(duration), 2) AS duration FROM ({_LOG}) GROUP BY job_name""",
    latest_n="SELECT event_id, ts FROM events ORDER BY ts DESC, event_id DESC LIMIT 10",
    describe_schema="""SELECT pos, name, type, (SELECT COUNT(*) FROM lineitem) AS total_records
        FROM (VALUES (0, 'l_orderkey', 'bigint'), (1, 'l_partkey', 'bigint'),
        (2, 'l_suppkey', 'bigint'), (3, 'l_linenumber', 'int'), (4, 'l_quantity', 'double'),
        (5, 'l_extendedprice', 'double'), (6, 'l_discount', 'double'), (7, 'l_tax', 'double'),
        (8, 'l_returnflag', 'string'), (9, 'l_linestatus', 'string'),
        (10, 'l_shipdate', 'timestamp_ntz')) v(pos, name, type)""",
    synth_bench_rows=f"""SELECT o_orderkey AS id, 'Product_' || (o_orderkey % 50) AS product,
        {draw_sql('o_orderkey', 0)} * 490 / {PRIME} + 10 AS price,
        'Category_' || (o_orderkey % 10) AS category,
        strftime(TIMESTAMP '2025-01-01' + o_orderkey * INTERVAL 1 SECOND, '%Y-%m-%d %H:%M:%S')
        AS "timestamp" FROM orders""",
    synth_orders=f"""SELECT CAST({between_sql(10000, 99999, 'o_orderkey', 0)} AS VARCHAR) AS order_id,
        {between_sql(1000, 100000, 'o_orderkey', 1)} / 100.0 AS amount,
        {list(STATUSES)}[{between_sql(1, len(STATUSES), 'o_orderkey', 2)}] AS status,
        o_orderdate AS updated_at FROM orders""",
    synth_users=f"""SELECT o_orderkey AS id, 'User_' || {between_sql(1000, 9999, 'o_orderkey', 0)} AS name,
        'user_' || {between_sql(1000, 9999, 'o_orderkey', 0)} || '@example.com' AS email FROM orders""",
    synth_products=f"""SELECT {between_sql(1, 1000, 'o_orderkey', 0)} AS id,
        'Product_' || {between_sql(1, 50, 'o_orderkey', 1)} AS product,
        {between_sql(10, 500, 'o_orderkey', 2)} AS price,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS "timestamp" FROM orders""",
    stream_reconciled="""SELECT 'events-' || batch AS ingestion_id, 'FULL' AS ingestion_type,
        'SUCCESS' AS status, COUNT(*) AS read_count, COUNT(DISTINCT user_id) AS source_count,
        COUNT(DISTINCT user_id) AS target_count, MAX(ts) AS next_value
        FROM (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 0
            WHEN ts < TIMESTAMP '2024-01-20' THEN 1 ELSE 2 END AS batch FROM events)
        GROUP BY batch""",
    job_end_to_end="""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
        upper(o_orderpriority) AS o_orderpriority,
        CASE WHEN o_totalprice > 250000 THEN 'run-1' ELSE 'run-0' END AS _ingestion_id,
        'INCREMENTAL' AS _ingestion_type, DATE '2025-06-01' AS _ingest_date,
        TIMESTAMP '2025-06-01 00:00:00' AS ingested_at
        FROM orders WHERE o_totalprice > 250000 OR o_orderdate > TIMESTAMP '1997-01-01'""",
    job_resumes_at_watermark="""SELECT event_id,
        CASE WHEN ts < TIMESTAMP '2024-01-20' THEN 'run-0' ELSE 'run-1' END AS _ingestion_id
        FROM events""",
    job_replays_without_key="""SELECT format, event_id,
        CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'run-0' ELSE 'run-2' END AS _ingestion_id,
        CASE WHEN ts < TIMESTAMP '2024-01-10' THEN DATE '2025-06-01' ELSE DATE '2025-06-03' END
        AS _ingest_date FROM events CROSS JOIN (VALUES ('snapshot'), ('parquet')) f(format)""",
    job_takes_late_rows="""SELECT format, event_id, date_trunc('day', ts)::TIMESTAMP AS day,
        CASE WHEN ts < TIMESTAMP '2024-01-10 12:00:00' THEN 'run-0' ELSE 'run-2' END AS _ingestion_id
        FROM (SELECT * FROM events UNION ALL SELECT * FROM events WHERE event_type = 'error')
        CROSS JOIN (VALUES ('snapshot'), ('parquet')) f(format)""",
    job_from_rest="""SELECT event_id AS data_id, event_type AS title, '{' || user_id || '}' AS log,
        CASE WHEN event_type <> 'error' THEN event_type END AS plate, 'api' AS _source_name
        FROM events""",
    run_all_report="""SELECT 'customer' AS job_name, COUNT(*) AS source_count,
        COUNT(*) AS target_count, 'SUCCESS' AS status FROM customer
        UNION ALL SELECT 'orders', COUNT(*), COUNT(*), 'SUCCESS' FROM orders
        UNION ALL SELECT 'events', COUNT(*), COUNT(*), 'SUCCESS' FROM events
        UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*), 'SUCCESS' FROM lineitem""",
)
