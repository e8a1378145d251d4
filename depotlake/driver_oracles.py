"""The driver queries as plain SQL over the same tables, for checking results."""

from __future__ import annotations

# Each fragment is one common table expression; it may use the ones before it.
FRAGMENTS = {
    "inventory_raw": """
        SELECT concat('wh', l_suppkey + 1) AS warehouse_id,
               concat('prd', l_partkey) AS product_id,
               CASE WHEN l_partkey % 50 <> 0 THEN concat(' ', p_name, ' ') END AS product_name,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity * 4 AS INTEGER) END AS quantity_in_stock,
               CAST(l_shipdate AS DATE) AS last_restock_date,
               l_orderkey, l_linenumber
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "inventory_kept": """
        SELECT upper(trim(warehouse_id)) AS warehouse_id, upper(trim(product_id)) AS product_id,
               trim(product_name) AS product_name, coalesce(quantity_in_stock, 0) AS quantity_in_stock,
               last_restock_date, l_linenumber
        FROM inventory_raw WHERE product_id IS NOT NULL AND product_name IS NOT NULL""",
    "inventory": """
        SELECT warehouse_id, product_id, product_name, quantity_in_stock, last_restock_date
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY warehouse_id, product_id
                  ORDER BY last_restock_date DESC NULLS LAST, product_name DESC NULLS LAST,
                           quantity_in_stock DESC NULLS LAST) AS rn
              FROM inventory_kept)
        WHERE rn = 1""",
    "sales_raw": """
        SELECT CASE WHEN l_orderkey % 97 <> 0 THEN concat('ord', l_orderkey) END AS order_id,
               concat('prd', l_partkey % 10) AS product_id,
               CASE WHEN l_linenumber <> 7 THEN CAST(l_quantity AS INTEGER) END AS quantity_sold,
               CASE WHEN l_partkey % 211 <> 0 THEN CAST(l_shipdate AS DATE) END AS sale_date,
               concat('wh', l_suppkey % 5 + 1) AS warehouse_id
        FROM lineitem""",
    "sales_kept": """
        SELECT upper(trim(order_id)) AS order_id, upper(trim(product_id)) AS product_id,
               coalesce(quantity_sold, 0) AS quantity_sold, sale_date,
               upper(trim(warehouse_id)) AS warehouse_id
        FROM sales_raw
        WHERE order_id IS NOT NULL AND product_id IS NOT NULL AND warehouse_id IS NOT NULL""",
    "sales": """
        SELECT order_id, product_id, quantity_sold, sale_date, warehouse_id
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY order_id, product_id, warehouse_id
                  ORDER BY sale_date DESC NULLS LAST, quantity_sold DESC NULLS LAST) AS rn
              FROM sales_kept)
        WHERE rn = 1""",
    "daily": """
        SELECT warehouse_id, product_id, sale_date, CAST(sum(quantity_sold) AS BIGINT) AS qty_sold
        FROM sales WHERE sale_date IS NOT NULL GROUP BY warehouse_id, product_id, sale_date""",
    "shipments_raw": """
        SELECT concat(' sh', event_id - event_id % 4) AS shipment_id,
               CASE WHEN user_id % 37 = 0 THEN 'X9' ELSE concat('wh', user_id + 1) END AS warehouse_id,
               CASE event_type WHEN 'view' THEN ' In Transit ' WHEN 'click' THEN 'IN TRANSIT'
                    WHEN 'error' THEN 'Delayed' WHEN 'purchase' THEN 'delivered' ELSE 'lost' END AS status,
               CASE WHEN event_id % 5 = 0
                    THEN concat(event_id % 16 + 12, '.5,', event_id % 16 + 72, '.25')
                    WHEN event_id % 5 = 1 THEN ' new delhi ' ELSE 'mumbai' END AS location,
               ts AS "timestamp",
               CASE WHEN event_type = 'error' AND event_id % 3 <> 0 THEN ' Weather ' END AS delay_reason,
               ts AS ingestion_time
        FROM events""",
    "bronze": """
        SELECT upper(trim(shipment_id)) AS shipment_id, upper(trim(warehouse_id)) AS warehouse_id,
               lower(trim(status)) AS status, location, "timestamp", trim(delay_reason) AS delay_reason,
               ingestion_time, 'TMS_live' AS source_system
        FROM shipments_raw""",
    "described": """
        SELECT shipment_id, warehouse_id, "timestamp", delay_reason, ingestion_time, source_system,
               CASE WHEN status LIKE '%transit%' THEN 'In Transit' WHEN status LIKE '%delayed%' THEN 'Delayed'
                    WHEN status LIKE '%delivered%' THEN 'Delivered' ELSE 'Unknown' END AS status,
               status LIKE '%delayed%' AS is_delayed,
               "timestamp" >= TIMESTAMP '2024-01-30 00:00:00' AS is_recent,
               CASE WHEN regexp_matches(trim(location), '^[0-9.+-]+,[0-9.+-]+$')
                    THEN TRY_CAST(string_split(trim(location), ',')[1] AS DOUBLE) END AS latitude,
               CASE WHEN regexp_matches(trim(location), '^[0-9.+-]+,[0-9.+-]+$')
                    THEN TRY_CAST(string_split(trim(location), ',')[2] AS DOUBLE) END AS longitude,
               CASE WHEN NOT regexp_matches(trim(location), '^[0-9.+-]+,[0-9.+-]+$')
                    THEN array_to_string(list_transform(string_split(lower(trim(location)), ' '),
                         lambda w: concat(upper(w[1]), w[2:])), ' ') END AS city
        FROM bronze""",
    "valid": """
        SELECT * FROM described
        WHERE shipment_id IS NOT NULL AND regexp_matches(warehouse_id, '^WH[0-9]+$')""",
    "shipment_facts": """
        SELECT shipment_id, warehouse_id, status, "timestamp" AS event_ts,
               CAST("timestamp" AS DATE) AS event_date, city, delay_reason, is_delayed, is_recent,
               latitude, longitude
        FROM (SELECT *, row_number() OVER (
                  PARTITION BY shipment_id ORDER BY ingestion_time DESC NULLS LAST) AS rn FROM valid)
        WHERE rn = 1 AND "timestamp" >= DATE '2024-04-15' - 90""",
    "per_day": """
        SELECT shipment_id, warehouse_id, status, "timestamp" AS event_ts, day AS event_date, city,
               delay_reason, is_delayed, is_recent, latitude, longitude
        FROM (SELECT *, CAST("timestamp" AS DATE) AS day, row_number() OVER (
                  PARTITION BY shipment_id, CAST("timestamp" AS DATE)
                  ORDER BY "timestamp" DESC NULLS LAST) AS rn FROM valid)
        WHERE rn = 1""",
}

INVENTORY = ("inventory_raw", "inventory_kept", "inventory")
SALES = ("sales_raw", "sales_kept", "sales")
EVENTS = ("shipments_raw", "bronze", "described")
SHIPMENTS = (*EVENTS, "valid")

AUDIT = "TIMESTAMP '2024-01-31 00:00:00' AS ingestion_timestamp, 'aws-s3' AS source_system"

STATUS_OF_STOCK = "CASE WHEN quantity_in_stock < {below} THEN 'Low Stock' ELSE 'OK' END AS stock_status"

STOCK_FACT = (
    "SELECT warehouse_id, product_id, quantity_in_stock, last_restock_date,"
    " {day} AS snapshot_date, " + STATUS_OF_STOCK + " FROM inventory"
)

LATEST_PRODUCT = """
    SELECT product_id, product_name
    FROM (SELECT *, row_number() OVER (
              PARTITION BY product_id
              ORDER BY last_restock_date DESC NULLS LAST, warehouse_id DESC NULLS LAST) AS rn
          FROM {stock})
    WHERE rn = 1"""

LATEST_SHIPMENT = """
    SELECT shipment_id, warehouse_id, status, "timestamp", delay_reason, ingestion_time, source_system,
           is_delayed, is_recent, latitude, longitude, city
    FROM (SELECT *, row_number() OVER (
              PARTITION BY shipment_id
              ORDER BY "timestamp" DESC NULLS LAST, ingestion_time DESC NULLS LAST) AS rn
          FROM {events})
    WHERE rn = 1"""


def using(fragments: tuple[str, ...], body: str, **extra: str) -> str:
    parts = [(name, FRAGMENTS[name]) for name in fragments] + list(extra.items())
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in parts) + f" {body}"


FACT_SHIPMENTS = using((*SHIPMENTS, "shipment_facts"), "SELECT * FROM shipment_facts")


def oracle_sql() -> dict[str, str]:
    found = {
        "silver_inventory": using(INVENTORY, f"SELECT *, {AUDIT} FROM inventory"),
        "silver_inventory_text_dates": using(
            ("inventory_raw", "inventory_kept"),
            f"""SELECT warehouse_id, product_id, product_name, quantity_in_stock, last_restock_date, {AUDIT}
                FROM (SELECT *, row_number() OVER (
                          PARTITION BY warehouse_id, product_id
                          ORDER BY last_restock_date DESC NULLS LAST, product_name DESC NULLS LAST,
                                   quantity_in_stock DESC NULLS LAST) AS rn
                      FROM readable)
                WHERE rn = 1""",
            readable="""
                SELECT warehouse_id, product_id, product_name, quantity_in_stock,
                       CASE WHEN l_linenumber <> 6 THEN last_restock_date END AS last_restock_date
                FROM inventory_kept""",
        ),
        "silver_job": using(
            ("inventory_raw", "inventory_kept", *SALES),
            """SELECT CAST(NULL AS VARCHAR) AS order_id, product_id, warehouse_id, quantity_in_stock AS quantity, last_restock_date AS day
               FROM (SELECT *, row_number() OVER (
                         PARTITION BY warehouse_id, product_id
                         ORDER BY last_restock_date DESC NULLS LAST, product_name DESC NULLS LAST,
                                  quantity_in_stock DESC NULLS LAST) AS rn
                     FROM readable)
               WHERE rn = 1
               UNION ALL SELECT order_id, product_id, warehouse_id, quantity_sold, sale_date FROM sales""",
            readable="""
                SELECT warehouse_id, product_id, product_name, quantity_in_stock,
                       CASE WHEN l_linenumber <> 6 THEN last_restock_date END AS last_restock_date
                FROM inventory_kept""",
        ),
        "sales_by_city": using(
            SALES,
            """SELECT city, CAST(sum(quantity_sold) AS BIGINT) AS units, count(*) AS lines
               FROM sales JOIN (VALUES ('WH1', 'Mumbai'), ('WH2', 'Delhi'), ('WH3', 'Bangalore'), ('WH4', 'Chennai'),
                                       ('WH5', 'Hyderabad')) AS m(warehouse_id, city) USING (warehouse_id)
               GROUP BY city""",
        ),
        "silver_sales": using(SALES, f"SELECT *, {AUDIT} FROM sales"),
        "quarantine": using(
            ("inventory_raw", "sales_raw"),
            """SELECT 'inventory' AS entity, CAST(NULL AS VARCHAR) AS order_id, product_id, warehouse_id,
                      raw_date, CASE WHEN product_name IS NULL THEN 'missing product_name'
                                     ELSE 'unparsed date' END AS reject_reason,
                      product_name IS NULL AS dropped
               FROM dated WHERE product_name IS NULL OR l_linenumber = 6
               UNION ALL
               SELECT 'sales', order_id, product_id, warehouse_id, CAST(sale_date AS VARCHAR),
                      'missing order_id', true
               FROM sales_raw WHERE order_id IS NULL""",
            dated="""
                SELECT *, CASE WHEN l_linenumber = 6 THEN '13/45/2025'
                               WHEN l_orderkey % 2 = 0 THEN strftime(last_restock_date, '%-m/%-d/%Y')
                               ELSE strftime(last_restock_date, '%Y-%m-%d') END AS raw_date
                FROM inventory_raw""",
        ),
        "shipment_standardise": using(("shipments_raw", "bronze"), "SELECT * FROM bronze"),
        "shipment_status": using(EVENTS, 'SELECT shipment_id, "timestamp", status, is_delayed FROM described'),
        "shipment_location": using(
            EVENTS, 'SELECT shipment_id, "timestamp", latitude, longitude, city FROM described'
        ),
        "shipment_recent": using(EVENTS, 'SELECT shipment_id, "timestamp", is_recent FROM described'),
        "silver_shipments": using(SHIPMENTS, LATEST_SHIPMENT.format(events="valid")),
        "silver_shipments_parity": using(
            EVENTS,
            "SELECT * FROM chosen WHERE regexp_matches(warehouse_id, '^WH[0-9]+$')",
            chosen=LATEST_SHIPMENT.format(events="described"),
        ),
        "fact_inventory_daily": using(INVENTORY, STOCK_FACT.format(day="DATE '2024-04-15'", below=50)),
        "low_stock_topk": using(
            INVENTORY,
            """SELECT * FROM facts
               ORDER BY snapshot_date DESC, quantity_in_stock, warehouse_id, product_id LIMIT 10""",
            facts=STOCK_FACT.format(day="DATE '2024-04-15'", below=50),
        ),
        "fact_sales_daily": using((*SALES, "daily"), "SELECT * FROM daily"),
        "sales_upsert": using(
            (*SALES, "daily"),
            """SELECT coalesce(t.warehouse_id, s.warehouse_id) AS warehouse_id,
                      coalesce(t.product_id, s.product_id) AS product_id,
                      coalesce(t.sale_date, s.sale_date) AS sale_date,
                      coalesce(s.qty_sold, t.qty_sold) AS qty_sold
               FROM (SELECT * FROM daily WHERE sale_date < DATE '1999-01-01') t
               FULL OUTER JOIN (SELECT warehouse_id, product_id, sale_date, qty_sold + 1 AS qty_sold
                                FROM daily WHERE sale_date >= DATE '1998-01-01') s
               ON t.warehouse_id = s.warehouse_id AND t.product_id = s.product_id
                  AND t.sale_date = s.sale_date""",
        ),
        "sales_incremental": using(
            SALES,
            """SELECT warehouse_id, product_id, sale_date, CAST(sum(quantity_sold) AS BIGINT) AS qty_sold
               FROM (SELECT *, row_number() OVER (
                         PARTITION BY order_id, product_id, warehouse_id
                         ORDER BY sale_date DESC NULLS LAST, quantity_sold DESC NULLS LAST) AS rn
                     FROM (SELECT order_id, product_id, warehouse_id, sale_date, quantity_sold FROM folded
                           UNION ALL
                           SELECT order_id, product_id, warehouse_id, sale_date, quantity_sold + 7 FROM folded
                           WHERE CAST(substr(order_id, 4) AS BIGINT) % 5 = 0
                           UNION ALL
                           SELECT order_id, product_id, warehouse_id, sale_date + 3, quantity_sold FROM folded
                           WHERE CAST(substr(order_id, 4) AS BIGINT) % 7 = 0))
               WHERE rn = 1 AND sale_date IS NOT NULL GROUP BY warehouse_id, product_id, sale_date""",
            folded="""
                SELECT order_id, product_id, warehouse_id, quantity_sold,
                       DATE '1998-01-01' + CAST(dayofyear(sale_date) % 21 AS INTEGER) AS sale_date
                FROM sales""",
        ),
        "dim_product_scd1": using(
            INVENTORY,
            """SELECT coalesce(t.product_id, s.product_id) AS product_id,
                      CASE WHEN t.product_id IS NULL OR t.product_name <> s.product_name
                           THEN s.product_name ELSE t.product_name END AS product_name,
                      CASE WHEN t.product_id IS NULL OR t.product_name <> s.product_name
                           THEN DATE '2024-04-15' ELSE DATE '2024-01-01' END AS effective_date,
                      'inventory_silver' AS source
               FROM known t FULL OUTER JOIN present s ON t.product_id = s.product_id""",
            renamed="""
                SELECT warehouse_id, product_id, last_restock_date,
                       CASE WHEN product_name LIKE '%ring' THEN concat(product_name, ' v2')
                            ELSE product_name END AS product_name
                FROM inventory""",
            early="SELECT * FROM inventory WHERE last_restock_date < DATE '1995-03-01'",
            known=LATEST_PRODUCT.format(stock="early"),
            present=LATEST_PRODUCT.format(stock="renamed"),
        ),
        "dim_warehouse_scd1": """
            WITH mapping AS (
                SELECT concat('WH', s_suppkey + 1) AS warehouse_id, n_name AS city
                FROM supplier JOIN nation ON s_nationkey = n_nationkey),
            known AS (
                SELECT warehouse_id,
                       CASE WHEN city < 'NATION_2' THEN concat('Old ', city) ELSE city END AS city
                FROM mapping WHERE warehouse_id < 'WH5')
            SELECT s.warehouse_id, s.city,
                   CASE WHEN t.warehouse_id IS NULL OR t.city <> s.city
                        THEN DATE '2024-04-15' ELSE DATE '2024-01-01' END AS effective_date,
                   'static_mapping' AS source
            FROM mapping s LEFT JOIN known t ON t.warehouse_id = s.warehouse_id""",
        "fact_shipments": FACT_SHIPMENTS,
        "fact_shipments_upsert": using(
            (*SHIPMENTS, "per_day"),
            """SELECT coalesce(t.shipment_id, s.shipment_id) AS shipment_id,
                      coalesce(s.warehouse_id, t.warehouse_id) AS warehouse_id,
                      coalesce(s.status, t.status) AS status, coalesce(s.event_ts, t.event_ts) AS event_ts,
                      coalesce(t.event_date, s.event_date) AS event_date,
                      CASE WHEN s.shipment_id IS NULL THEN t.city ELSE s.city END AS city,
                      CASE WHEN s.shipment_id IS NULL THEN t.delay_reason ELSE 'Restated' END AS delay_reason,
                      coalesce(s.is_delayed, t.is_delayed) AS is_delayed,
                      coalesce(s.is_recent, t.is_recent) AS is_recent,
                      CASE WHEN s.shipment_id IS NULL THEN t.latitude ELSE s.latitude END AS latitude,
                      CASE WHEN s.shipment_id IS NULL THEN t.longitude ELSE s.longitude END AS longitude
               FROM (SELECT * FROM per_day WHERE event_date < DATE '2024-01-20') t
               FULL OUTER JOIN (SELECT * FROM per_day WHERE event_date >= DATE '2024-01-10') s
               ON t.shipment_id = s.shipment_id AND t.event_date = s.event_date""",
        ),
        "supplychain_snapshot": using(
            (*INVENTORY, *SHIPMENTS, "shipment_facts"),
            """SELECT i.warehouse_id, i.product_id, p.product_name, i.quantity_in_stock, i.stock_status,
                      f.shipment_id, f.status, f.city AS location, f.event_ts AS "timestamp",
                      f.delay_reason, i.snapshot_date
               FROM facts i JOIN products p ON i.product_id = p.product_id
               JOIN shipment_facts f ON i.warehouse_id = f.warehouse_id
               WHERE f.status IN ('In Transit', 'Delayed')""",
            facts=STOCK_FACT.format(day="DATE '2024-04-15'", below=50),
            products=LATEST_PRODUCT.format(stock="inventory"),
        ),
        "supplychain_snapshot_hot": using(
            (*INVENTORY, *SHIPMENTS, "shipment_facts"),
            """SELECT i.warehouse_id, i.product_id, p.product_name, i.quantity_in_stock, i.stock_status,
                      f.shipment_id, f.status, f.city AS location, f.event_ts AS "timestamp",
                      f.delay_reason, i.snapshot_date
               FROM facts i JOIN products p ON i.product_id = p.product_id
               JOIN shipment_facts f ON i.warehouse_id = f.warehouse_id
               WHERE f.status IN ('In Transit', 'Delayed')""",
            facts=STOCK_FACT.format(day="DATE '2024-04-15'", below=50),
            products=LATEST_PRODUCT.format(stock="inventory"),
        ),
        "quarantine_shipments": using(
            ("shipments_raw", "bronze"),
            """SELECT * FROM (
                 SELECT shipment_id, warehouse_id, status,
                        CASE WHEN minute("timestamp") <> 7 THEN "timestamp" END AS "timestamp", ingestion_time,
                        CASE WHEN NOT regexp_matches(warehouse_id, '^WH[0-9]+$') THEN 'invalid shipment key'
                             WHEN minute("timestamp") = 7 THEN 'no readable event time' END AS reject_reason
                 FROM bronze) WHERE reject_reason IS NOT NULL""",
        ),
        "alerts_shipments": using(
            (*SHIPMENTS, "shipment_facts"),
            """SELECT shipment_id, warehouse_id, city AS location,
                      coalesce(delay_reason, 'Traffic') AS delay_reason, event_ts AS "timestamp", event_date
               FROM shipment_facts WHERE status = 'Delayed'""",
        ),
        "retention_purge": using(
            (*SHIPMENTS, "per_day"), "SELECT * FROM per_day WHERE event_date >= DATE '2024-04-15' - 90"
        ),
        "partition_overwrite": using(
            INVENTORY,
            STOCK_FACT.format(day="DATE '2024-04-14'", below=50)
            + " UNION ALL "
            + STOCK_FACT.format(day="DATE '2024-04-15'", below=100),
        ),
        "stream_bronze": using(
            ("shipments_raw", "bronze"),
            """SELECT shipment_id, warehouse_id, status, location, "timestamp", delay_reason,
                      CASE WHEN location = 'mumbai' THEN '{"carrier":"road"}' END AS _rescued_data,
                      TIMESTAMP '2024-01-31 00:00:00' AS ingestion_time, source_system
               FROM bronze""",
        ),
        "stream_dedup_first": using(SHIPMENTS, "SELECT DISTINCT shipment_id FROM valid"),
        "stream_dedup_within_watermark": using(SHIPMENTS, "SELECT DISTINCT shipment_id FROM valid"),
        "stream_latest_state": using(SHIPMENTS, LATEST_SHIPMENT.format(events="valid")),
        "stream_latest_table": using(SHIPMENTS, LATEST_SHIPMENT.format(events="valid")),
        "stream_late_rows": """
            WITH valid AS (
                SELECT concat('SH', 4 * event_id) AS shipment_id, ts, event_id % 3 AS step FROM events WHERE user_id % 37 <> 0),
            marks AS (
                SELECT s.step, max(date_trunc('millisecond', ts)) - INTERVAL 5 MINUTE AS watermark
                FROM (VALUES (0), (1), (2)) AS s(step) LEFT JOIN valid ON valid.step < s.step GROUP BY s.step)
            SELECT shipment_id, ts AS "timestamp", coalesce(ts <= watermark, false) AS is_late
            FROM valid JOIN marks USING (step)""",
        "stream_dedup_returning": """
            WITH came AS (
                SELECT concat('SH', event_id - event_id % 4) AS shipment_id, (event_id // 4) % 20 AS hour,
                       bool_or(event_id % 4 = 0 AND user_id % 37 <> 0) AS v0,
                       bool_or(event_id % 4 = 1 AND user_id % 37 <> 0) AS v1,
                       bool_or(event_id % 4 >= 2 AND user_id % 37 <> 0) AS v2
                FROM events GROUP BY ALL),
            -- The watermark passes all but the last hour of a day before the next day comes.
            kept AS (
                SELECT shipment_id, v0 AS e0, v1 AND (hour < 19 OR NOT v0) AS e1,
                       v2 AND (hour < 19 OR NOT (v1 AND NOT v0)) AS e2, v0, v1, v2
                FROM came)
            SELECT 'first' AS mode, shipment_id, CASE WHEN v0 THEN 0 WHEN v1 THEN 1 ELSE 2 END AS step
            FROM kept WHERE v0 OR v1 OR v2
            UNION ALL SELECT 'within_watermark', shipment_id, 0 FROM kept WHERE e0
            UNION ALL SELECT 'within_watermark', shipment_id, 1 FROM kept WHERE e1
            UNION ALL SELECT 'within_watermark', shipment_id, 2 FROM kept WHERE e2""",
        "stream_progress_totals": """
            SELECT 'bronze_in_steps' AS name, count(*) AS input_rows, CAST(0 AS BIGINT) AS rows_dropped_late,
                   true AS beyond_memory
            FROM events""",
        "bronze_lineage": using(
            ("shipments_raw", "bronze"),
            """SELECT shipment_id, "timestamp", strftime("timestamp", '%Y%m%d') AS source_day FROM bronze""",
        ),
        "stream_report": """
            SELECT 'shipments_bronze' AS name, false AS is_active, count(*) AS recent_input_rows,
                   CAST(0 AS BIGINT) AS recent_rows_dropped_late
            FROM events""",
        "file_completeness": """
            WITH days AS (
                SELECT concat('wh', user_id + 1, '_', strftime(ts, '%Y%m%d'), '.csv') AS file_name, event_type
                FROM events)
            SELECT file_name, file_name IN (SELECT file_name FROM days WHERE event_type = 'purchase') AS is_present
            FROM (SELECT DISTINCT file_name FROM days)""",
        "file_completeness_counts": """
            WITH days AS (
                SELECT CAST(ts AS DATE) AS day, user_id,
                       sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) > 0 AS is_present
                FROM events GROUP BY CAST(ts AS DATE), user_id)
            SELECT day, count(*) AS expected_files,
                   CAST(sum(CASE WHEN is_present THEN 1 ELSE 0 END) AS BIGINT) AS present_files,
                   count(*) = sum(CASE WHEN is_present THEN 1 ELSE 0 END) AS is_complete
            FROM days GROUP BY day""",
        "ingest_roundtrip": using(
            ("sales_raw",),
            """SELECT order_id, product_id, CAST(quantity_sold AS VARCHAR) AS quantity_sold,
                      CAST(sale_date AS VARCHAR) AS sale_date, warehouse_id
               FROM sales_raw""",
        ),
        "ingest_by_header": using(
            ("sales_raw",),
            """SELECT order_id, product_id, CAST(quantity_sold AS VARCHAR) AS quantity_sold,
                      CAST(sale_date AS VARCHAR) AS sale_date, warehouse_id
               FROM sales_raw""",
        ),
        "ingest_quoted_breaks": using(
            ("sales_raw",),
            """SELECT order_id, product_id, CAST(quantity_sold AS VARCHAR) AS quantity_sold,
                      CAST(sale_date AS VARCHAR) AS sale_date, warehouse_id,
                      'said "' || product_id || '",' || chr(10) || 'then' || chr(10) || chr(10)
                          || coalesce(order_id, '"') AS note
               FROM sales_raw""",
        ),
        "archive_batch": using(
            ("sales_raw",),
            """SELECT order_id, product_id, CAST(quantity_sold AS VARCHAR) AS quantity_sold,
                      CAST(sale_date AS VARCHAR) AS sale_date, warehouse_id,
                      CASE WHEN quantity_sold % 2 = 0 THEN 'salesorder' ELSE 'returns' END AS folder,
                      0 AS left_in_landing
               FROM sales_raw""",
        ),
        "publish_counts": using(
            (*SHIPMENTS, "per_day"),
            """SELECT layer, (SELECT count(*) FROM per_day) AS row_count
               FROM (VALUES ('fact_shipments'), ('fact_shipments csv'), ('fact_shipments parquet')) AS t(layer)
               UNION ALL SELECT 'acknowledged', 1""",
        ),
        "publish_incremental": using(
            (*SHIPMENTS, "per_day"),
            """SELECT 'publication ' || k || ' fact_shipments' || copy AS what,
                      count(*) FILTER (WHERE k < 2 OR event_date <> DATE '2024-01-05') AS row_count,
                      CASE k WHEN 0 THEN count(DISTINCT event_date) WHEN 1 THEN 0
                           ELSE count(DISTINCT CASE WHEN event_date = DATE '2024-01-12' THEN event_date END) END AS parts_written
               FROM per_day, (VALUES (0), (1), (2)) AS t(k), (VALUES (''), (' csv'), (' parquet')) AS c(copy) GROUP BY k, copy
               UNION ALL
               SELECT fmt || ' ' || event_date, count(*), CAST(sum(CASE WHEN event_date = DATE '2024-01-12' THEN 1 ELSE 0 END) AS BIGINT)
               FROM per_day, (VALUES ('csv'), ('parquet')) AS t(fmt)
               WHERE event_date <> DATE '2024-01-05' GROUP BY fmt, event_date""",
        ),
        "archive_events": """
            SELECT CAST(ts AS DATE) AS ingest_date, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time
            FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-15' - 3""",
        "export_roundtrip_csv": FACT_SHIPMENTS,
        "export_roundtrip_parquet": FACT_SHIPMENTS,
        "serving_load": FACT_SHIPMENTS,
        "reconcile": using(
            (*INVENTORY, *SALES),
            """SELECT 'inventory' AS entity, (SELECT count(*) FROM inventory_raw) AS rows_in,
                      (SELECT count(*) FROM inventory) AS rows_out,
                      (SELECT count(*) FROM inventory_raw WHERE product_name IS NULL) AS rows_rejected,
                      (SELECT count(*) FROM inventory_kept)
                          - (SELECT count(*) FROM (SELECT DISTINCT warehouse_id, product_id FROM inventory_kept))
                          AS rows_duplicate,
                      true AS is_balanced
               UNION ALL
               SELECT 'sales', (SELECT count(*) FROM sales_raw), (SELECT count(*) FROM sales),
                      (SELECT count(*) FROM sales_raw WHERE order_id IS NULL),
                      (SELECT count(*) FROM sales_kept)
                          - (SELECT count(*)
                             FROM (SELECT DISTINCT order_id, product_id, warehouse_id FROM sales_kept)),
                      true""",
        ),
    }
    found["dim_product_bucketed"] = found["dim_product_scd1"]
    found["reconcile_recount"] = found["reconcile"]
    # The same rows, kept up by micro-batches.
    found["stream_snapshot"] = found["supplychain_snapshot"]
    return found
