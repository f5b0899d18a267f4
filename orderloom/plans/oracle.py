"""The registered queries as plain SQL over the same tables, for an independent check.

The statements follow the definitions of the results step by step, joins repeated and nothing reduced
early, so that they share no shortcut with the Spark plans.
"""

from __future__ import annotations

_CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "shop_orders": ((), """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_number, CAST(o_custkey AS VARCHAR) AS user_email,
               o_orderdate AS order_datetime, o_orderdate + INTERVAL 9 HOUR AS placed,
               CASE o_orderstatus WHEN 'P' THEN '900' WHEN 'O' THEN '300' ELSE '700' END AS order_status,
               o_totalprice AS total_price
        FROM orders"""),
    "shop_items": ((), """
        SELECT CAST(l_orderkey AS VARCHAR) AS order_number, CAST(l_suppkey AS VARCHAR) AS basket_id,
               p_brand AS manage_number, p_name AS item_name, CAST(l_partkey AS VARCHAR) AS variant_id,
               CAST(l_quantity AS BIGINT) AS quantity, p_retailprice AS price_tax_incl,
               CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS BIGINT) AS DOUBLE) AS subtotal
        FROM lineitem JOIN part ON l_partkey = p_partkey"""),
    "shop_master": ((), """
        SELECT p_brand AS manage_number, p_name AS product_name, p_type AS category_name,
               CAST(p_size AS VARCHAR) AS brand_name
        FROM part WHERE p_brand NOT IN ('Brand#24', 'Brand#25')"""),
    "names": (("shop_master",), """
        SELECT manage_number,
               (list(product_name ORDER BY length(product_name) DESC, product_name DESC)
                    FILTER (WHERE product_name <> ''))[1] AS product_name,
               (list(category_name ORDER BY length(category_name) DESC, category_name DESC)
                    FILTER (WHERE category_name <> ''))[1] AS category_name,
               (list(brand_name ORDER BY length(brand_name) DESC, brand_name DESC)
                    FILTER (WHERE brand_name <> ''))[1] AS brand_name
        FROM shop_master GROUP BY manage_number"""),
    "counted": (("shop_orders",), """
        SELECT order_number, user_email, order_datetime, total_price, CAST(placed AS DATE) AS order_date,
               CAST(date_trunc('month', placed) AS DATE) AS order_month
        FROM shop_orders WHERE order_status <> '900'"""),
    "first_order": (("counted",), """
        SELECT user_email, order_number AS first_order_number, order_date AS first_order_date,
               order_month AS first_order_month
        FROM counted
        QUALIFY row_number() OVER (PARTITION BY user_email ORDER BY order_datetime, order_number) = 1"""),
    "entry": (("first_order", "shop_items", "names"), """
        SELECT f.*, i.manage_number AS entry_manage_number,
               coalesce(n.product_name, i.item_name) AS entry_item_name, n.category_name, n.brand_name
        FROM first_order f
        JOIN shop_items i ON i.order_number = f.first_order_number
        LEFT JOIN names n ON n.manage_number = i.manage_number
        WHERE i.manage_number IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY f.user_email
            ORDER BY i.subtotal DESC NULLS LAST, i.manage_number, i.item_name NULLS FIRST) = 1"""),
    "first_purchase": (("entry",), """
        SELECT user_email, first_order_number, first_order_date, first_order_month,
               entry_manage_number, entry_item_name FROM entry"""),
    "monthly_sales": (("counted",), """
        SELECT user_email, order_month, SUM(CAST(total_price AS DECIMAL(18,2))) AS monthly_sales
        FROM counted GROUP BY user_email, order_month"""),
    "older_names": ((), """
        SELECT p_brand AS manage_number,
               (list(p_name ORDER BY length(p_name) DESC, p_name DESC))[1] AS product_name,
               (list(p_type ORDER BY length(p_type) DESC, p_type DESC))[1] AS category_name,
               (list(CAST(p_size AS VARCHAR) ORDER BY length(CAST(p_size AS VARCHAR)) DESC,
                     CAST(p_size AS VARCHAR) DESC))[1] AS brand_name
        FROM part WHERE p_brand NOT IN ('Brand#24', 'Brand#25') AND p_size <= 25 GROUP BY p_brand"""),
    "order_ranges": (("shop_orders",), """
        SELECT CAST(m AS DATE) AS month, CAST(m AS TIMESTAMP) AS range_start,
               least(m + INTERVAL 1 MONTH, e) AS range_end
        FROM (SELECT unnest(generate_series(date_trunc('month', s), e - INTERVAL 1 MICROSECOND, INTERVAL 1 MONTH)) AS m, e
              FROM (SELECT CAST(min(CAST(placed AS DATE)) AS TIMESTAMP) AS s,
                           CAST(max(CAST(placed AS DATE)) + 1 AS TIMESTAMP) AS e FROM shop_orders))"""),
    "range_counts": (("order_ranges", "shop_orders"), """
        SELECT month, range_start, range_end, CAST(count(DISTINCT order_number) AS BIGINT) AS order_numbers
        FROM order_ranges LEFT JOIN shop_orders ON placed >= range_start AND placed < range_end
        GROUP BY month, range_start, range_end"""),
}


_CTE["listings"] = ((), """
    SELECT CAST(l_orderkey AS VARCHAR) AS order_number, CAST(date_trunc('week', l_shipdate) AS DATE) AS first_chunk,
           CAST(l_linenumber AS BIGINT) AS first_page, CAST(0 AS BIGINT) AS first_place
    FROM lineitem WHERE l_returnflag <> 'R'
    QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY date_trunc('week', l_shipdate), l_linenumber) = 1""")


def _cohort_ctes(first: str, names: str, suffix: str = "") -> dict[str, tuple[tuple[str, ...], str]]:
    """The cohort steps over a first-purchase relation and a name relation."""
    return {
        f"cohort_sales{suffix}": ((first, names, "monthly_sales"), f"""
            SELECT f.entry_manage_number, coalesce(n.product_name, f.entry_item_name) AS entry_item_name,
                   n.category_name, n.brand_name, f.first_order_month,
                   CAST(date_diff('month', f.first_order_month, s.order_month) AS BIGINT) AS month_offset,
                   s.user_email, s.monthly_sales
            FROM {first} f
            LEFT JOIN {names} n ON n.manage_number = f.entry_manage_number
            JOIN monthly_sales s ON s.user_email = f.user_email
            WHERE date_diff('month', f.first_order_month, s.order_month) >= 0"""),
        f"cohort_sizes{suffix}": ((first, names), f"""
            SELECT f.entry_manage_number, coalesce(n.product_name, f.entry_item_name) AS entry_item_name,
                   n.category_name, n.brand_name, f.first_order_month,
                   CAST(count(DISTINCT f.user_email) AS BIGINT) AS cohort_users
            FROM {first} f LEFT JOIN {names} n ON n.manage_number = f.entry_manage_number
            GROUP BY ALL"""),
        f"cohort_months{suffix}": ((f"cohort_sales{suffix}", f"cohort_sizes{suffix}"), f"""
            SELECT s.entry_manage_number, s.entry_item_name, s.category_name, s.brand_name,
                   s.first_order_month, s.month_offset, c.cohort_users,
                   CAST(count(DISTINCT s.user_email) AS BIGINT) AS active_buyers,
                   SUM(s.monthly_sales) AS revenue
            FROM cohort_sales{suffix} s JOIN cohort_sizes{suffix} c
              ON c.entry_manage_number = s.entry_manage_number AND c.first_order_month = s.first_order_month
            GROUP BY ALL"""),
        f"ltv{suffix}": ((f"cohort_months{suffix}",), f"""
            SELECT entry_manage_number, entry_item_name, category_name, brand_name, first_order_month,
                   month_offset, cohort_users, active_buyers, CAST(revenue AS DOUBLE) AS revenue_in_month,
                   CAST(running AS DOUBLE) AS cumulative_revenue,
                   CAST(running AS DOUBLE) / cohort_users AS ltv_per_user,
                   CAST(revenue AS DOUBLE) / nullif(active_buyers, 0) AS aov_in_month
            FROM (SELECT *, SUM(revenue) OVER (PARTITION BY entry_manage_number, first_order_month
                                               ORDER BY month_offset) AS running
                  FROM cohort_months{suffix} WHERE active_buyers > 0 OR revenue > 0)"""),
    }


_CTE.update(_cohort_ctes("first_purchase", "names"))
_CTE.update(_cohort_ctes("first_purchase", "older_names", "_older"))
_CTE["one_name"] = (("first_purchase", "names"), """
    SELECT f.entry_manage_number AS manage_number,
           coalesce(any_value(n.product_name),
                    (list(f.entry_item_name ORDER BY length(f.entry_item_name) DESC, f.entry_item_name DESC))[1]
           ) AS product_name,
           any_value(n.category_name) AS category_name, any_value(n.brand_name) AS brand_name
    FROM first_purchase f LEFT JOIN names n ON n.manage_number = f.entry_manage_number
    GROUP BY f.entry_manage_number""")
_CTE.update(_cohort_ctes("first_purchase", "one_name", "_one"))


def _with(body: str, *needs: str) -> str:
    done: dict[str, str] = {}

    def add(name: str) -> None:
        if name not in done:
            before, sql = _CTE[name]
            for other in before:
                add(other)
            done[name] = sql

    for name in needs:
        add(name)
    steps = ",\n".join(f"{name} AS ({sql})" for name, sql in done.items())
    joint = "" if body.lstrip().startswith(",") else "\n"  # a body may open with steps of its own
    return f"WITH {steps}{joint}{body.strip() if not joint else body}"


_LTV_SHOWN = "SELECT * REPLACE (CAST(first_order_month AS VARCHAR) AS first_order_month) FROM "
_STAMP = "strftime({}, '%Y-%m-%d %H:%M:%S')"

ORACLE: dict[str, str] = {
    "base_orders": _with(f"""
        SELECT order_number, user_email, {_STAMP.format('order_datetime')} AS order_datetime, total_price,
               CAST(order_date AS VARCHAR) AS order_date, CAST(order_month AS VARCHAR) AS order_month
        FROM counted""", "counted"),
    "product_master_best": _with("SELECT * FROM names", "names"),
    "user_monthly_sales": _with("""
        SELECT user_email, CAST(order_month AS VARCHAR) AS order_month, CAST(monthly_sales AS DOUBLE) AS monthly_sales
        FROM monthly_sales""", "monthly_sales"),
    "user_first_order": _with("""
        SELECT * REPLACE (CAST(first_order_date AS VARCHAR) AS first_order_date,
                          CAST(first_order_month AS VARCHAR) AS first_order_month) FROM first_order""", "first_order"),
    "entry_products": _with("""
        SELECT * REPLACE (CAST(first_order_date AS VARCHAR) AS first_order_date,
                          CAST(first_order_month AS VARCHAR) AS first_order_month) FROM entry""", "entry"),
    "first_purchase_full": _with("""
        SELECT * REPLACE (CAST(first_order_date AS VARCHAR) AS first_order_date,
                          CAST(first_order_month AS VARCHAR) AS first_order_month) FROM first_purchase""",
        "first_purchase"),
    "first_purchase_merge": _with("""
        , early AS (
            SELECT user_email, order_number AS first_order_number, CAST(placed AS DATE) AS first_order_date,
                   CAST(date_trunc('month', placed) AS DATE) AS first_order_month
            FROM shop_orders WHERE order_status = '700' AND placed < TIMESTAMP '1995-07-01'
            QUALIFY row_number() OVER (PARTITION BY user_email ORDER BY order_datetime, order_number) = 1),
        known AS (
            SELECT f.*, i.manage_number AS entry_manage_number,
                   coalesce(n.product_name, i.item_name) AS entry_item_name
            FROM early f JOIN shop_items i ON i.order_number = f.first_order_number
            LEFT JOIN names n ON n.manage_number = i.manage_number
            QUALIFY row_number() OVER (PARTITION BY f.user_email
                ORDER BY i.subtotal DESC NULLS LAST, i.manage_number, i.item_name) = 1),
        merged AS (
            SELECT *, false AS inserted FROM known
            UNION ALL
            SELECT f.*, true FROM first_purchase f
            WHERE first_order_month = DATE '1995-06-01' AND user_email NOT IN (SELECT user_email FROM known))
        SELECT * REPLACE (CAST(first_order_date AS VARCHAR) AS first_order_date,
                          CAST(first_order_month AS VARCHAR) AS first_order_month) FROM merged""",
        "first_purchase", "names"),
    "user_cohort_sales": _with("""
        SELECT * REPLACE (CAST(first_order_month AS VARCHAR) AS first_order_month,
                          CAST(monthly_sales AS DOUBLE) AS monthly_sales) FROM cohort_sales""", "cohort_sales"),
    "cohort_counts": _with(_LTV_SHOWN + "cohort_sizes", "cohort_sizes"),
    "ltv_monthly_aggregated": _with("""
        SELECT * EXCLUDE (revenue) REPLACE (CAST(first_order_month AS VARCHAR) AS first_order_month),
               CAST(revenue AS DOUBLE) AS revenue_in_month FROM cohort_months""", "cohort_months"),
    "ltv_by_month_offset": _with(_LTV_SHOWN + "ltv", "ltv"),
    "ltv_canonical": _with(_LTV_SHOWN + "ltv_one", "ltv_one"),
    "ltv_name_refresh": _with("""
        SELECT l.entry_manage_number,
               CASE WHEN hit THEN product_name ELSE entry_item_name END AS entry_item_name,
               CASE WHEN hit THEN new_category ELSE l.category_name END AS category_name,
               CASE WHEN hit THEN new_brand ELSE l.brand_name END AS brand_name,
               CAST(first_order_month AS VARCHAR) AS first_order_month, month_offset, cohort_users, active_buyers,
               revenue_in_month, cumulative_revenue, ltv_per_user, aov_in_month, hit AS name_changed
        FROM (SELECT t.*, n.product_name, n.category_name AS new_category, n.brand_name AS new_brand,
                     n.manage_number IS NOT NULL AND coalesce(t.entry_item_name <> n.product_name
                       OR coalesce(t.category_name, '') <> coalesce(n.category_name, '')
                       OR coalesce(t.brand_name, '') <> coalesce(n.brand_name, ''), false) AS hit
              FROM ltv_older t
              LEFT JOIN (SELECT * FROM names WHERE manage_number IN (SELECT manage_number FROM shop_items)) n
                ON n.manage_number = t.entry_manage_number) l""", "ltv_older", "names", "shop_items"),
    "normalize_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_number, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS order_datetime,
               CASE o_orderstatus WHEN 'P' THEN '900' WHEN 'O' THEN '300' ELSE '700' END AS order_status,
               CAST(CAST(o_orderdate AS DATE) - 1 AS VARCHAR) AS cancel_due_date,
               o_totalprice AS total_price, o_totalprice AS goods_price,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(500 AS DOUBLE) END AS postage_price,
               CASE WHEN o_orderpriority = '1-URGENT' THEN CAST(330 AS DOUBLE) END AS payment_fee,
               CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS DOUBLE) END AS used_point,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderpriority END AS payment_method,
               CASE WHEN o_orderpriority <> '1-URGENT' THEN 'CARD' END AS card_name,
               o_orderpriority AS delivery_name,
               CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS delivery_date,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority = '1-URGENT' END AS rakuten_member_flag,
               CAST(o_custkey AS VARCHAR) AS user_email, o_orderstatus AS prefecture, o_orderpriority AS city,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus || '-0094' END AS zip_code,
               CASE WHEN o_orderpriority = '5-LOW' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS order_update_datetime,
               '2024-02-01 00:00:00' AS inserted_at
        FROM orders""",
    "normalize_order_items": """
        WITH copies AS (SELECT unnest([1, 2]) AS copy)
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS order_number, CAST(l_suppkey AS VARCHAR) AS basket_id,
               CAST(l_partkey AS VARCHAR) AS item_id, p_name AS item_name, p_brand AS manage_number,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_partkey AS VARCHAR) END AS variant_id,
               CASE WHEN l_linestatus = 'F' THEN l_linestatus END AS sku_info, p_retailprice AS price,
               CASE WHEN l_returnflag <> 'N' THEN p_retailprice END AS price_tax_incl,
               CAST(l_quantity AS BIGINT) AS quantity,
               CASE l_returnflag WHEN 'R' THEN l_extendedprice
                    WHEN 'A' THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(l_quantity AS BIGINT) AS DOUBLE)
               END AS subtotal,
               CASE WHEN l_returnflag <> 'R' THEN l_tax END AS tax_rate, l_linestatus AS delivery_company,
               '2024-02-01 00:00:00' AS inserted_at, strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS order_datetime
        FROM lineitem JOIN part ON l_partkey = p_partkey, copies
        UNION ALL
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')), CAST(l_suppkey AS VARCHAR),
               'x' || CAST(l_partkey AS VARCHAR), 'bare', NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, l_linestatus,
               '2024-02-01 00:00:00', strftime(l_shipdate, '%Y-%m-%d %H:%M:%S')
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "items_with_order_datetime": _with("""
        SELECT i.*, strftime(o.order_datetime, '%Y-%m-%d %H:%M:%S') AS order_datetime
        FROM shop_items i LEFT JOIN counted o ON o.order_number = i.order_number""", "shop_items", "counted"),
    "reject_report": """
        SELECT 'order_number_missing' AS rule, (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem) AS checked,
               (SELECT count(*) FROM orders WHERE o_orderpriority = '1-URGENT') AS rejected
        UNION ALL
        SELECT 'order_datetime_missing', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem),
               (SELECT count(*) FROM orders WHERE o_orderpriority = '5-LOW')
        UNION ALL
        SELECT 'order_datetime_unreadable', (SELECT count(*) FROM orders) + (SELECT count(*) FROM lineitem),
               (SELECT count(*) FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED')
        UNION ALL
        SELECT 'item_id_missing', 3 * (SELECT count(*) FROM lineitem), 2 * (SELECT count(*) FROM lineitem WHERE l_returnflag = 'R')""",
    "missing_orders": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_number FROM orders
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
    "raw_orders_scan": """
        SELECT CAST(o_orderkey AS VARCHAR) AS order_number,
               CASE o_orderstatus WHEN 'P' THEN '900' WHEN 'O' THEN '300' ELSE '700' END AS order_progress,
               CAST(o_custkey AS VARCHAR) AS user_email, 0 AS packages, CAST(NULL AS VARCHAR) AS item_name
        FROM orders
        UNION ALL
        SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')), NULL, NULL, 3, p_name FROM lineitem JOIN part ON l_partkey = p_partkey""",
    "order_numbers_dedup": _with("""
        SELECT order_number, CAST(first_chunk AS VARCHAR) AS first_chunk, first_page, first_place FROM listings""", "listings"),
    "detail_batches": _with("""
        SELECT order_number, n AS position, CAST(n // 100 AS BIGINT) AS batch
        FROM (SELECT order_number, row_number() OVER (ORDER BY first_chunk, first_page, first_place, order_number) - 1 AS n
              FROM listings)""", "listings"),
    "product_master_clean": """
        SELECT DISTINCT p_brand AS manage_number, p_name AS product_name,
               CASE WHEN p_type <> 'PROMO' THEN p_type END AS category_name, CAST(NULL AS VARCHAR) AS brand_name
        FROM part WHERE p_size <> 1""",
    "product_master_grid": """
        SELECT DISTINCT p_brand AS manage_number, CASE WHEN p_size >= 10 THEN p_name END AS product_name,
               CASE WHEN p_size >= 20 THEN p_type END AS category_name, CAST(p_size AS VARCHAR) AS brand_name
        FROM part""",
    "load_files": """
        SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
               unnest(['NDJSON', 'CSV', 'CSV with notes', 'CSV detected']) AS source_format
        FROM events""",
    "upsert_table": _with("""
        SELECT order_number, CASE WHEN order_status = '900' THEN '950' ELSE order_status END AS order_status, total_price,
               CAST(CAST(date_trunc('month', placed) AS DATE) AS VARCHAR) AS order_month
        FROM shop_orders
        UNION ALL
        SELECT 'new-' || order_number, '100', NULL, CAST(CAST(date_trunc('month', placed) AS DATE) AS VARCHAR)
        FROM shop_orders
        WHERE order_number IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT')""", "shop_orders"),
    "latest_documents": _with("""
        SELECT order_number, CASE WHEN order_status = '300' THEN '100' ELSE order_status END AS order_progress
        FROM shop_orders""", "shop_orders"),
    "job_load_span": """
        WITH lines AS (
            SELECT DISTINCT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, strftime(l_shipdate, '%Y%m%d')) AS order_number, CAST(l_partkey AS VARCHAR) AS part,
                   CAST(CAST(date_trunc('month', l_shipdate + INTERVAL 9 HOUR) AS DATE) AS VARCHAR) AS order_month
            FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT 'orders' AS table_name, order_number, CAST(NULL AS VARCHAR) AS item_id, order_month FROM lines
        UNION ALL
        SELECT 'order_items', order_number, unnest([part, part, 'x' || part]), order_month FROM lines""",
    "job_initial_load": _with(_LTV_SHOWN + "ltv", "ltv"),
    "job_refresh_cohorts": _with(_LTV_SHOWN + "ltv", "ltv"),
    "job_follow_landings": _with("""
        SELECT order_number, CASE WHEN order_status = '300' THEN '100' ELSE order_status END AS order_status, total_price,
               CAST(CAST(date_trunc('month', placed) AS DATE) AS VARCHAR) AS order_month
        FROM shop_orders""", "shop_orders"),
    "job_merge_month": _with("""
        SELECT * REPLACE (CAST(first_order_date AS VARCHAR) AS first_order_date, CAST(first_order_month AS VARCHAR) AS first_order_month)
        FROM first_purchase WHERE first_order_month = DATE '1995-06-01'""", "first_purchase"),
    "job_dry_run": _with("""
        , spans(mode, s, e) AS (
            VALUES ('MONTHLY', TIMESTAMP '1997-02-01', TIMESTAMP '1997-03-01'),
                   ('HISTORICAL', TIMESTAMP '1995-03-16 12:00:00', TIMESTAMP '1997-03-15 12:00:00'),
                   ('CUSTOM', TIMESTAMP '1995-01-15', TIMESTAMP '1995-06-10')),
        cut AS (
            SELECT mode, m AS a, least(m + INTERVAL 1 MONTH, e) AS b
            FROM (SELECT mode, e, unnest(generate_series(date_trunc('month', s), e - INTERVAL 1 MICROSECOND, INTERVAL 1 MONTH)) AS m FROM spans))
        SELECT mode, strftime(a, '%Y-%m-%dT%H:%M:%S') || '+0900' AS range_start, strftime(b, '%Y-%m-%dT%H:%M:%S') || '+0900' AS range_end,
               CAST(count(DISTINCT order_number) AS BIGINT) AS order_numbers
        FROM cut LEFT JOIN shop_orders ON placed >= a AND placed < b GROUP BY ALL""", "shop_orders"),
    "job_refresh_names": _with("""
        SELECT l.entry_manage_number, CAST(first_order_month AS VARCHAR) AS first_order_month, month_offset, cohort_users,
               coalesce(n.product_name, entry_item_name) AS entry_item_name,
               CASE WHEN n.manage_number IS NULL THEN l.category_name ELSE n.category_name END AS category_name,
               CASE WHEN n.manage_number IS NULL THEN l.brand_name ELSE n.brand_name END AS brand_name
        FROM ltv_older l LEFT JOIN names n ON n.manage_number = l.entry_manage_number""", "ltv_older", "names"),
    "append_batch": _with("""
        SELECT order_number, strftime(order_datetime, '%Y-%m-%d %H:%M:%S') AS order_datetime, order_status, total_price,
               CAST(CAST(date_trunc('month', placed) AS DATE) AS VARCHAR) AS order_month FROM shop_orders""",
        "shop_orders"),
    "delete_between": """
        SELECT event_id, event_type FROM events
        WHERE event_type = 'error'
           OR NOT (ts >= TIMESTAMP '2024-01-07 15:00:00' AND ts < TIMESTAMP '2024-01-15 03:00:00')""",
    "replace_month": _with("""
        , timed AS (
            SELECT i.*, o.placed FROM shop_items i JOIN shop_orders o ON o.order_number = i.order_number)
        SELECT 'orders' AS table_name, order_number,
               CASE WHEN placed >= TIMESTAMP '1997-03-01' AND placed < TIMESTAMP '1997-04-11'
                      OR placed >= TIMESTAMP '1997-05-01' AND placed < TIMESTAMP '1997-05-03'
                    THEN total_price + 1 ELSE total_price END AS amount,
               CAST(CAST(date_trunc('month', placed) AS DATE) AS VARCHAR) AS order_month
        FROM shop_orders
        WHERE NOT (placed >= TIMESTAMP '1997-03-01' AND placed < TIMESTAMP '1997-04-11' AND order_status = '900')
        UNION ALL
        SELECT 'order_items', order_number, subtotal, CAST(CAST(date_trunc('month', placed) AS DATE) AS VARCHAR)
        FROM timed
        WHERE NOT (placed >= TIMESTAMP '1997-03-01' AND placed < TIMESTAMP '1997-04-11' AND quantity <= 10)""",
        "shop_orders", "shop_items"),
    "upsert_by_keys": _with("""
        SELECT order_number, CASE WHEN order_status = '900' THEN '950' ELSE order_status END AS order_status, total_price
        FROM shop_orders
        UNION ALL
        SELECT 'new-' || CAST(o_orderkey AS VARCHAR), '100', NULL FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT NULL, o_orderstatus, NULL FROM orders WHERE o_orderpriority = '5-LOW'""", "shop_orders"),
    "business_calendar": """
        SELECT event_id, CAST(CAST(local AS DATE) AS VARCHAR) AS business_day,
               CAST(CAST(date_trunc('month', local) AS DATE) AS VARCHAR) AS month_start,
               CAST(CAST(date_trunc('month', local) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS next_month,
               CAST(CAST(date_trunc('month', local) - INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS prev_month,
               strftime(local, '%Y-%m-%dT%H:%M:%S') || '+0900' AS iso_plain,
               strftime(local, '%Y-%m-%dT%H:%M:%S') || '+09:00' AS iso_colon
        FROM (SELECT event_id, ts + INTERVAL 9 HOUR AS local FROM events)""",
    "month_ranges": _with("""
        SELECT user_email, CAST(CAST(m AS DATE) AS VARCHAR) AS month, strftime(m, '%Y-%m-%d %H:%M:%S') AS range_start,
               strftime(least(m + INTERVAL 1 MONTH, e), '%Y-%m-%d %H:%M:%S') AS range_end
        FROM (SELECT user_email, e,
                     unnest(generate_series(date_trunc('month', s), e - INTERVAL 1 MICROSECOND, INTERVAL 1 MONTH)) AS m
              FROM (SELECT user_email, CAST(CAST(min(placed) AS DATE) AS TIMESTAMP) AS s,
                           CAST(CAST(max(placed) AS DATE) + 1 AS TIMESTAMP) AS e
                    FROM shop_orders GROUP BY user_email))""", "shop_orders"),
    "range_order_counts": _with("""
        SELECT CAST(month AS VARCHAR) AS month, strftime(range_start, '%Y-%m-%d %H:%M:%S') AS range_start,
               strftime(range_end, '%Y-%m-%d %H:%M:%S') AS range_end, order_numbers FROM range_counts""", "range_counts"),
    "chunk_counts": _with("""
        , chunks AS (
            SELECT month, c AS chunk_start, least(c + INTERVAL 7 DAY, range_end) AS chunk_end
            FROM (SELECT month, range_end, unnest(generate_series(range_start, range_end - INTERVAL 1 MICROSECOND,
                                                                  INTERVAL 7 DAY)) AS c FROM order_ranges))
        SELECT CAST(month AS VARCHAR) AS month, strftime(chunk_start, '%Y-%m-%d %H:%M:%S') AS chunk_start,
               strftime(chunk_end, '%Y-%m-%d %H:%M:%S') AS chunk_end,
               CAST(count(DISTINCT order_number) AS BIGINT) AS order_numbers,
               count(DISTINCT order_number) > 15000 AS over_cap
        FROM chunks LEFT JOIN shop_orders ON placed >= chunk_start AND placed < chunk_end
        GROUP BY ALL""", "order_ranges", "shop_orders"),
    "backfill_plan": _with("""
        SELECT strftime(month, '%Y-%m') AS month, CAST(CAST(range_start AS DATE) AS VARCHAR) AS start_day,
               CAST(CAST(range_end AS DATE) - 1 AS VARCHAR) AS end_day, order_numbers,
               CAST(ceil(order_numbers / 100.0) AS BIGINT) AS detail_calls FROM range_counts""", "range_counts"),
    "run_summary": _with("""
        SELECT count(*) AS ranges_count, CAST(sum(order_numbers) AS BIGINT) AS order_numbers FROM range_counts""",
        "range_counts"),
    "orders_by_month": _with("""
        SELECT strftime(placed, '%Y-%m') AS month, count(*) AS order_count FROM shop_orders GROUP BY 1 ORDER BY 1""",
        "shop_orders"),
    "table_freshness": """
        SELECT 'orders' AS table_name, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_written,
               count(*) AS total_rows FROM orders
        UNION ALL
        SELECT 'order_items', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S'), count(*) FROM lineitem""",
    "product_sales": _with("""
        SELECT i.manage_number,
               coalesce(any_value(n.product_name),
                        (list(i.item_name ORDER BY length(i.item_name) DESC, i.item_name DESC))[1]) AS item_name,
               any_value(n.category_name) AS category_name, any_value(n.brand_name) AS brand_name,
               CAST(sum(i.quantity) AS BIGINT) AS quantity,
               CAST(sum(CAST(i.subtotal AS DECIMAL(18,2))) AS DOUBLE) AS sales,
               CAST(count(DISTINCT i.order_number) AS BIGINT) AS orders
        FROM shop_items i LEFT JOIN names n ON n.manage_number = i.manage_number
        GROUP BY i.manage_number""", "shop_items", "names"),
}
