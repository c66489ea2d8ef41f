"""The desk queries as plain SQL, for checking results with another engine.

Written straight from the question, without regard to speed, so that they share no plan with ``desk``.
"""

ORACLE = {
    "category_item_counts": """
        SELECT r_name AS region_name, COUNT(*) AS row_count, COUNT(DISTINCT c_custkey) AS customer_count
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
        GROUP BY r_name
    """,
    "top10_by_demand": """
        SELECT s_suppkey, s_name, COUNT(*) AS demand
        FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) bridge
        JOIN lineitem fact ON fact.l_partkey = bridge.l_partkey
        JOIN supplier ON s_suppkey = bridge.l_suppkey
        GROUP BY s_suppkey, s_name
        ORDER BY demand DESC, s_suppkey
        LIMIT 10
    """,
    "revenue_by_category": """
        SELECT p_brand, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM lineitem JOIN part ON l_partkey = p_partkey
        GROUP BY p_brand
    """,
    "top_category_by_revenue": """
        SELECT p_brand, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN part ON l_partkey = p_partkey
        GROUP BY p_brand
        ORDER BY revenue DESC, p_brand
        LIMIT 1
    """,
    "items_without_stock": """
        SELECT p_partkey, p_name
        FROM part
        WHERE NOT EXISTS (
            SELECT 1 FROM lineitem
            WHERE l_partkey = p_partkey AND l_returnflag = 'R' AND l_quantity >= 45)
    """,
    "top3_in_category_with_ties": """
        SELECT s_suppkey, s_name, part_count, supplier_rank
        FROM (
            SELECT s_suppkey, s_name, COUNT(*) AS part_count,
                   RANK() OVER (ORDER BY COUNT(*) DESC) AS supplier_rank
            FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) bridge
            JOIN part ON p_partkey = l_partkey
            JOIN supplier ON s_suppkey = l_suppkey
            WHERE p_brand = 'Brand#7'
            GROUP BY s_suppkey, s_name) ranked
        WHERE supplier_rank <= 3
    """,
    "active_inactive_by_group": """
        SELECT lang,
               COUNT(DISTINCT CASE WHEN quality = 1 THEN d.doc_id END) AS active_docs,
               COUNT(DISTINCT CASE WHEN COALESCE(quality, 0) = 0 THEN d.doc_id END) AS inactive_docs
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        GROUP BY lang
    """,
    "bucket_membership": """
        SELECT n_nationkey, 'starts' AS bucket FROM nation WHERE n_name ILIKE 'nation!_1%' ESCAPE '!'
        UNION
        SELECT n_nationkey, 'ends' AS bucket FROM nation WHERE n_name LIKE '%1'
    """,
    "bucket_top_category_by_hours": """
        WITH buckets AS (
            SELECT n_nationkey, 'starts' AS bucket FROM nation WHERE n_name ILIKE 'nation!_1%' ESCAPE '!'
            UNION
            SELECT n_nationkey, 'ends' AS bucket FROM nation WHERE n_name LIKE '%1'),
        rentals AS (
            SELECT bucket, p_brand,
                   CASE WHEN l_linestatus = 'F' THEN l_shipdate END - o_orderdate AS gap
            FROM lineitem
            JOIN orders ON l_orderkey = o_orderkey
            JOIN part ON l_partkey = p_partkey
            JOIN customer ON o_custkey = c_custkey
            JOIN buckets ON c_nationkey = n_nationkey
            WHERE l_shipdate >= o_orderdate),
        sums AS (
            SELECT bucket, p_brand,
                   CAST(SUM(date_part('day', gap) * 24 + date_part('hour', gap)) AS BIGINT) AS hours
            FROM rentals GROUP BY bucket, p_brand)
        SELECT bucket, p_brand, hours
        FROM (
            SELECT *, ROW_NUMBER() OVER (PARTITION BY bucket ORDER BY hours DESC NULLS LAST, p_brand) AS place
            FROM sums) placed
        WHERE place = 1
    """,
    "elapsed_hours_by_type": """
        SELECT event_type,
               CAST(SUM(date_part('day', ts - TIMESTAMP '2024-01-01') * 24
                        + date_part('hour', ts - TIMESTAMP '2024-01-01')) AS BIGINT) AS hours
        FROM events GROUP BY event_type
    """,
    "full_name": """
        SELECT c_custkey, concat(c_name, ' ', c_mktsegment) AS full_name,
               concat(c_name, ' ', CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END) AS partial_name
        FROM customer
    """,
    "like_vs_ilike": """
        SELECT COUNT(*) FILTER (WHERE p_name LIKE 'R%') AS starts_same_case,
               COUNT(*) FILTER (WHERE p_name ILIKE 'R%') AS starts_any_case,
               COUNT(*) FILTER (WHERE p_name LIKE '%ge%') AS contains_same_case,
               COUNT(*) FILTER (WHERE p_name ILIKE '%GE%') AS contains_any_case
        FROM part
    """,
    "json_field_counts": """
        SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k, COUNT(*) AS row_count
        FROM events GROUP BY 1
    """,
    "json_records": """
        SELECT concat('{"c_custkey":', c_custkey, ',"c_name":"', c_name, '","c_nationkey":', c_nationkey,
                      ',"c_acctbal":', c_acctbal, ',"c_mktsegment":"', c_mktsegment, '"}') AS record,
               c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
        FROM customer
    """,
    "json_snapshot": """
        SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate) FROM orders
    """,
    "bronze_json_roundtrip": """
        SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props,
               strftime(ts, '%Y-%m-%d') AS load_date
        FROM events
    """,
    "bronze_csv_roundtrip": """
        SELECT *, '2024-01-15' AS load_date FROM customer
    """,
    "bronze_csv_documents": """
        SELECT doc_id, text, lang, source, n_chars FROM documents
    """,
    "bronze_partition_counts": """
        SELECT strftime(ts, '%Y-%m-%d') AS load_date, strftime(ts, '%Y_%m_%d') AS file_day,
               CAST(year(ts) AS INTEGER) AS load_year, CAST(month(ts) AS INTEGER) AS load_month,
               CAST(day(ts) AS INTEGER) AS load_day, COUNT(*) AS row_count
        FROM events GROUP BY ALL
    """,
    "incremental_overwrite": """
        SELECT strftime(ts, '%Y-%m-%d') AS load_date, COUNT(*) AS row_count,
               CAST(SUM(CAST(value + CASE WHEN CAST(ts AS DATE) = DATE '2024-01-15' THEN 1 ELSE 0 END
                             AS DECIMAL(18,2))) AS DOUBLE) AS value_sum
        FROM events GROUP BY 1
    """,
    "silver_dedupe": """
        SELECT user_id, event_type, load_date, event_id, value, props
        FROM (
            SELECT user_id, trim(event_type) AS event_type, strftime(ts, '%Y-%m-%d') AS load_date, event_id, value,
                   trim(props) AS props,
                   ROW_NUMBER() OVER (PARTITION BY user_id, trim(event_type), CAST(ts AS DATE)
                                      ORDER BY event_id) AS place
            FROM events
            WHERE user_id IS NOT NULL AND coalesce(trim(event_type), '') <> '' AND ts IS NOT NULL) placed
        WHERE place = 1
    """,
    "silver_from_dumps": """
        SELECT c_custkey, trim(c_name) AS c_name, c_nationkey, c_acctbal, trim(c_mktsegment) AS c_mktsegment,
               '2024-01-15' AS load_date
        FROM customer
        QUALIFY ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY c_name, c_nationkey, c_acctbal, c_mktsegment) = 1
    """,
    "load_audit": """
        WITH rows AS (
            SELECT strftime(ts, '%Y-%m-%d') AS load_date, user_id, trim(event_type) AS event_type,
                   ts IS NOT NULL AND user_id IS NOT NULL AND coalesce(trim(event_type), '') <> '' AS valid
            FROM events)
        SELECT load_date, COUNT(*) AS rows_in,
               COUNT(DISTINCT CASE WHEN valid THEN (user_id, event_type) END) AS rows_distinct,
               COUNT(*) FILTER (WHERE valid)
                   - COUNT(DISTINCT CASE WHEN valid THEN (user_id, event_type) END) AS rows_duplicate,
               COUNT(*) FILTER (WHERE NOT valid) AS rows_rejected
        FROM rows GROUP BY load_date
    """,
    "silver_write_audit": """
        WITH rows AS (
            SELECT strftime(ts, '%Y-%m-%d') AS load_date, user_id, trim(event_type) AS event_type,
                   ts IS NOT NULL AND user_id IS NOT NULL AND coalesce(trim(event_type), '') <> '' AS valid
            FROM events)
        SELECT load_date, COUNT(*) AS rows_in,
               COUNT(DISTINCT CASE WHEN valid THEN (user_id, event_type) END) AS rows_distinct,
               COUNT(*) FILTER (WHERE valid)
                   - COUNT(DISTINCT CASE WHEN valid THEN (user_id, event_type) END) AS rows_duplicate,
               COUNT(*) FILTER (WHERE NOT valid) AS rows_rejected
        FROM rows GROUP BY load_date
    """,
    "missing_load_days": """
        SELECT strftime(expected.day, '%Y-%m-%d') AS load_date
        FROM (SELECT unnest(generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-02-02', INTERVAL 1 DAY)) AS day)
             expected
        WHERE NOT EXISTS (SELECT 1 FROM events WHERE CAST(ts AS DATE) = CAST(expected.day AS DATE))
    """,
    "multi_source_union": """
        SELECT 'customer' AS source, COUNT(*) AS row_count,
               CAST(SUM(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance_sum
        FROM customer
        UNION ALL
        SELECT 'supplier', COUNT(*), CAST(SUM(CAST(s_acctbal AS DECIMAL(18,2))) AS DOUBLE)
        FROM supplier
    """,
}

# The stream must arrive at the same table as the batch.
ORACLE["stream_silver_dedupe"] = ORACLE["silver_dedupe"]



def _sizes(names: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{name}' AS table_name, COUNT(*) AS row_count FROM {name}" for name in names.split()
    )


ORACLE["table_catalog"] = _sizes(
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
)
ORACLE["landed_tables"] = ORACLE["table_catalog"]


def _profile(table: str, names: str) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, ROUND(AVG({c}), 2) AS mean,"
        f" ROUND(STDDEV_SAMP({c}), 2) AS stddev, CAST(MIN({c}) AS DOUBLE) AS min, CAST(MAX({c}) AS DOUBLE) AS max"
        f" FROM {table}"
        for c in names.split()
    )


ORACLE["profile_numeric"] = "\nUNION ALL\n".join(
    [
        _profile("orders", "o_orderkey o_custkey o_totalprice"),
        _profile(
            "lineitem",
            "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax",
        ),
    ]
)
