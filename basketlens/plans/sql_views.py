"""S6 in SQL: the metric views (V1, V2, V4) as temporary views and the ten cards (C1-C10) as table functions
over them, so that ``spark.sql("SELECT * FROM card_revenue_30d(TIMESTAMP_NTZ'2024-01-31')")`` is a dashboard
tile. Base tables are registered as ``shop_<table>``. Functions and views are plans by name: Spark inlines
them, so filters and column pruning reach the scans as in the DataFrame forms, and nothing is stored.

Every function with a window takes its clock ``as_of``; left out, it is the local time of the query.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Fixed length of the top products card.
TOP_PRODUCTS = 20

VIEWS = {
    "customer_lifetime_value": """
        WITH bought AS (
            SELECT user_id, count(DISTINCT id) AS total_orders, sum(total_amount) AS total_spent,
                   count(total_amount) AS amounts, min(created_at) AS opened, max(created_at) AS newest
            FROM shop_orders WHERE status = 'completed' GROUP BY user_id),
        spans AS (SELECT *, CAST(extract(DAY FROM newest - opened) AS BIGINT) AS days FROM bought)
        SELECT u.id AS customer_id, u.email, u.created_at AS first_purchase_date, s.total_orders, s.total_spent,
               CAST(s.total_spent AS DOUBLE) / nullif(CAST(s.amounts AS DOUBLE), 0) AS avg_order_value,
               s.newest AS last_purchase_date, s.days AS customer_lifespan_days,
               CAST(s.total_spent AS DOUBLE) * IF(s.days > 0, 365D / nullif(CAST(s.days AS DOUBLE), 0), 1D)
                   AS estimated_annual_value,
               CASE WHEN s.total_orders > 5 THEN 'Loyal customer' WHEN s.total_orders > 1 THEN 'Regular customer'
                    WHEN s.total_orders = 1 THEN 'One-time buyer' END AS customer_segment
        FROM spans s JOIN shop_users u ON u.id = s.user_id""",
    # Items without an order count as kept and meet no join, so they are no hot join key.
    "product_performance": """
        WITH pairs AS (
            SELECT order_id, product_id, count(*) AS item_rows, sum(quantity) AS units,
                   sum(quantity * price) AS amount, sum(price) AS prices, count(price) AS priced
            FROM shop_order_items GROUP BY order_id, product_id),
        judged AS (
            SELECT p.*, coalesce(o.status = 'completed', TRUE) AS kept
            FROM (SELECT * FROM pairs WHERE order_id IS NOT NULL) p LEFT JOIN shop_orders o ON o.id = p.order_id
            UNION ALL SELECT *, TRUE FROM pairs WHERE order_id IS NULL),
        sold AS (
            SELECT product_id, count_if(kept) AS kept_pairs,
                   count(DISTINCT IF(kept, order_id, NULL)) AS orders,
                   sum(units) FILTER (WHERE kept) AS units, sum(amount) FILTER (WHERE kept) AS amount,
                   sum(prices) FILTER (WHERE kept) AS prices, sum(priced) FILTER (WHERE kept) AS priced
            FROM judged GROUP BY product_id)
        SELECT g.id AS product_id, g.name AS product_name, g.sku, c.name AS category_name,
               g.price AS current_price, coalesce(s.orders, 0L) AS total_orders,
               CAST(s.units AS BIGINT) AS total_quantity_sold, s.amount AS total_revenue,
               CAST(s.prices AS DOUBLE) / nullif(CAST(s.priced AS DOUBLE), 0) AS avg_selling_price,
               g.stock_quantity AS current_stock,
               CASE WHEN g.stock_quantity = 0 THEN 'Out of Stock' WHEN g.stock_quantity < 10 THEN 'Low Stock'
                    ELSE 'In Stock' END AS stock_status
        FROM shop_products g LEFT JOIN shop_categories c ON c.id = g.category_id
             LEFT JOIN sold s ON s.product_id = g.id
        WHERE s.product_id IS NULL OR s.kept_pairs > 0""",
    "sales_funnel": """
        WITH in_carts AS (
            SELECT cart_id, to_date(created_at) AS day, count(*) AS n
            FROM shop_cart_items WHERE cart_id IS NOT NULL GROUP BY cart_id, to_date(created_at)),
        counted AS (
            SELECT to_date(created_at) AS day, 'page_views' AS step, count(*) AS n
            FROM shop_user_sessions GROUP BY ALL
            UNION ALL
            SELECT day, 'cart_additions', sum(n) FROM in_carts LEFT SEMI JOIN shop_carts c ON c.id = cart_id
            GROUP BY day
            UNION ALL
            SELECT to_date(created_at), 'checkouts_started', count(DISTINCT user_id) FROM shop_orders
            WHERE status <> 'pending' GROUP BY to_date(created_at)
            UNION ALL
            SELECT to_date(created_at), 'orders_completed', count(*) FROM shop_orders
            WHERE status = 'completed' GROUP BY to_date(created_at)),
        wide AS (
            SELECT * FROM counted
            PIVOT (sum(n) FOR step IN ('page_views', 'cart_additions', 'checkouts_started', 'orders_completed')))
        SELECT day AS metric_date, page_views, cart_additions, checkouts_started, orders_completed,
               CAST((20000 * cart_additions + page_views) DIV nullif(2 * page_views, 0) AS DOUBLE) / 100D
                   AS cart_conversion_rate,
               CAST((20000 * orders_completed + checkouts_started) DIV nullif(2 * checkouts_started, 0) AS DOUBLE)
                   / 100D AS checkout_conversion_rate
        FROM wide ORDER BY metric_date ASC NULLS LAST""",
}

_CLOCK = "as_of TIMESTAMP_NTZ DEFAULT localtimestamp()"
_PRODUCT = ("product_id BIGINT, product_name STRING, sku STRING, category_name STRING, "
            "current_price DECIMAL(10,2), total_orders BIGINT, total_quantity_sold BIGINT, "
            "total_revenue DECIMAL(31,2), avg_selling_price DOUBLE, current_stock INT, stock_status STRING")
_RECENT = "FROM shop_orders WHERE status = 'completed' AND created_at >= card.as_of - INTERVAL {} DAYS"

# Name: parameters, columns, query. "card.as_of" stands for the parameter of the function at hand.
CARDS = {
    "card_revenue_30d": (_CLOCK, "revenue DECIMAL(20,2)", f"SELECT sum(total_amount) {_RECENT.format(30)}"),
    "card_new_customers_30d": (
        _CLOCK, "new_customers BIGINT",
        "SELECT count(*) FROM shop_users WHERE created_at >= card.as_of - INTERVAL 30 DAYS"),
    "card_avg_order_value": (
        _CLOCK, "avg_order_value DOUBLE",
        "SELECT CAST(sum(total_amount) AS DOUBLE) / nullif(CAST(count(total_amount) AS DOUBLE), 0) "
        + _RECENT.format(30)),
    "card_daily_revenue_trend": (
        _CLOCK, "date DATE, revenue DECIMAL(20,2)",
        f"SELECT to_date(created_at) AS date, sum(total_amount) {_RECENT.format(90)} "
        "GROUP BY to_date(created_at) ORDER BY date ASC NULLS LAST"),
    "card_top_products": (
        "", _PRODUCT, "SELECT * FROM product_performance "
        f"ORDER BY total_revenue DESC NULLS FIRST, product_id LIMIT {TOP_PRODUCTS}"),
    "card_low_stock": (
        "", "product_name STRING, current_stock INT, stock_status STRING",
        "SELECT product_name, current_stock, stock_status FROM product_performance "
        "WHERE stock_status IN ('Low Stock', 'Out of Stock')"),
    "card_category_performance": (
        "", "category_name STRING, revenue DECIMAL(38,2)",
        "SELECT category_name, sum(total_revenue) AS revenue FROM product_performance GROUP BY category_name "
        "ORDER BY revenue DESC NULLS FIRST, category_name ASC NULLS LAST"),
    "card_clv_values": (
        "", "estimated_annual_value DOUBLE",
        "SELECT estimated_annual_value FROM customer_lifetime_value WHERE total_orders > 0"),
    "card_customer_segments": (
        "", "customer_segment STRING, count BIGINT",
        "SELECT customer_segment, count(*) FROM customer_lifetime_value GROUP BY customer_segment"),
    "card_sales_funnel_30d": (
        _CLOCK, "metric_date DATE, page_views BIGINT, cart_additions BIGINT, checkouts_started BIGINT, "
        "orders_completed BIGINT, cart_conversion_rate DOUBLE, checkout_conversion_rate DOUBLE",
        "SELECT * FROM sales_funnel WHERE metric_date >= date_sub(to_date(card.as_of), 30)"),
}


def register_tables(spark: SparkSession, tables: dict[str, DataFrame]) -> None:
    """Base tables as ``shop_<name>``. The views need users, categories, products, orders, order_items, carts,
    cart_items and user_sessions."""
    for name, df in tables.items():
        df.createOrReplaceTempView(f"shop_{name}")


def create_views(spark: SparkSession, names=tuple(VIEWS)) -> None:
    """V1, V2 and V4 over the registered tables, in this session."""
    for name in names:
        spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {VIEWS[name]}")


def create_cards(spark: SparkSession, names=tuple(CARDS)) -> None:
    """The cards as table functions over the views, in this session."""
    for name in names:
        parameters, columns, query = CARDS[name]
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS TABLE ({columns}) "
                  f"RETURN {query.replace('card.as_of', f'{name}.as_of')}")


def card(spark: SparkSession, name: str, as_of=None) -> DataFrame:
    """One card as SQL text."""
    clock = f"TIMESTAMP_NTZ'{as_of}'" if as_of is not None and CARDS[name][0] else ""
    return spark.sql(f"SELECT * FROM {name}({clock})")
