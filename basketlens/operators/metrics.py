"""The three metric views: customer lifetime value (V1), product performance
(V2) and the daily sales funnel (V3 long form, V4 wide form).

Scale notes
-----------
* Every view aggregates the large fact table (orders, order items, cart items)
  *before* it meets a dimension. The aggregate shuffles on (key, distinct
  column) first, so one customer or product holding a third of all rows is
  spread over many tasks; the join then sees at most one row per key.
* Joins against dimensions are left to AQE: broadcast when the runtime size is
  under ``spark.sql.autoBroadcastJoinThreshold``, shuffled otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import pct_round2, ratio, whole_days

SEGMENT_ONE_TIME = "One-time buyer"
SEGMENT_REGULAR = "Regular customer"
SEGMENT_LOYAL = "Loyal customer"

STOCK_OUT = "Out of Stock"
STOCK_LOW = "Low Stock"
STOCK_IN = "In Stock"
LOW_STOCK_BELOW = 10

FUNNEL_TYPES = ["page_views", "cart_additions", "checkouts_started", "orders_completed"]


def customer_lifetime_value(users: DataFrame, orders: DataFrame) -> DataFrame:
    """V1. One row per user with at least one completed order.

    The reference writes ``users LEFT JOIN orders ... WHERE o.status =
    'completed'``; the filter on the right side makes it an inner join (J2).
    ``first_purchase_date`` is the sign-up time, as in the reference (F5).
    Orders are aggregated per user first; ``users.id`` is a primary key, so
    joining the per-user rows afterwards gives the same groups.
    """
    completed = orders.filter(F.col("status") == "completed")
    per_user = (completed
                .groupBy("user_id")
                .agg(F.count_distinct("id").alias("total_orders"),
                     F.sum("total_amount").alias("total_spent"),
                     F.count("total_amount").alias("_n_amounts"),
                     F.max("created_at").alias("last_purchase_date"),
                     F.min("created_at").alias("_first_order_at")))
    u = users.select(F.col("id").alias("customer_id"), "email",
                     F.col("created_at").alias("first_purchase_date"))
    stats = u.join(per_user, u["customer_id"] == per_user["user_id"], "inner")
    days = whole_days(F.col("last_purchase_date"), F.col("_first_order_at"))
    spent = F.col("total_spent").cast("double")
    n = F.col("total_orders")
    return stats.select(
        "customer_id", "email", "first_purchase_date", "total_orders", "total_spent",
        ratio(F.col("total_spent"), F.col("_n_amounts")).alias("avg_order_value"),
        "last_purchase_date",
        days.alias("customer_lifespan_days"),
        F.when(days > 0, spent * (F.lit(365.0) / days.cast("double")))
         .otherwise(spent).alias("estimated_annual_value"),
        F.when(n == 1, SEGMENT_ONE_TIME)
         .when(n.between(2, 5), SEGMENT_REGULAR)
         .when(n > 5, SEGMENT_LOYAL).alias("customer_segment"),
    )


def item_pairs(order_items: DataFrame) -> DataFrame:
    """Sums of the items of one order and product."""
    return order_items.groupBy("order_id", "product_id").agg(
        F.count(F.lit(1)).alias("_rows"), F.sum("quantity").alias("_quantity"),
        F.sum(F.col("quantity") * F.col("price")).alias("_amount"),
        F.sum("price").alias("_price"), F.count("price").alias("_prices"))


def _pairs_with_status(order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """order_items summed per (order, product), LEFT JOIN orders for the status.

    The sums fold repeated pairs in the map tasks, so a pair that holds a third of
    all items is one row per task, and the join moves one row per pair. A plain
    hash shuffle would still send all pairs with a NULL order id to one task. The
    join key is therefore the struct (order_id IS NULL, coalesce(order_id, hash of
    the product)): an order's key is (false, id), so a NULL key still never
    matches, and it is spread over as many keys as there are products.
    """
    pairs = item_pairs(order_items).withColumn(
        "_jk", F.struct(F.col("order_id").isNull().alias("n"),
                        F.coalesce(F.col("order_id"), F.xxhash64("product_id")).alias("k")))
    o = orders.select(F.struct(F.lit(False).alias("n"), F.col("id").alias("k")).alias("_jk"),
                      "status")
    return pairs.join(o, "_jk", "left").drop("_jk")


def stock_status(stock: F.Column) -> F.Column:
    """NULL stock falls through to 'In Stock'; negative stock is 'Low Stock'."""
    return (F.when(stock == 0, STOCK_OUT)
             .when(stock < LOW_STOCK_BELOW, STOCK_LOW)
             .otherwise(STOCK_IN))


def product_performance(products: DataFrame, categories: DataFrame,
                        order_items: DataFrame, orders: DataFrame) -> DataFrame:
    """V2. Sales per product over completed orders.

    The reference filters ``o.status = 'completed' OR o.status IS NULL`` after
    three left joins (J3, W4). So a product with no items stays (with 0 /
    NULL), items on orphan or NULL-status orders count, and a product whose
    items all sit on non-completed orders disappears. Per product we count all
    item rows and the kept ones, aggregate the kept ones, and keep a product
    when it has no items or at least one kept item.
    """
    return product_performance_of(_pairs_with_status(order_items, orders), products, categories)


def product_performance_of(pairs: DataFrame, products: DataFrame, categories: DataFrame) -> DataFrame:
    """V2 from the items per (order, product) with the order's status."""
    kept = (F.col("status") == "completed") | F.col("status").isNull()
    of_kept = lambda c: F.sum(F.when(kept, F.col(c)))
    per_product = (pairs
                   .groupBy("product_id")
                   .agg(F.sum("_rows").alias("_n_rows"),
                        F.count_if(kept).alias("_n_kept"),
                        F.count_distinct(F.when(kept, F.col("order_id"))).alias("_orders"),
                        of_kept("_quantity").alias("total_quantity_sold"),
                        of_kept("_amount").alias("total_revenue"),
                        of_kept("_price").alias("_price_sum"),
                        of_kept("_prices").alias("_price_n")))
    cats = categories.select(F.col("id").alias("_cid"), F.col("name").alias("category_name"))
    p = products.join(cats, products["category_id"] == cats["_cid"], "left")
    joined = p.join(per_product, p["id"] == per_product["product_id"], "left")
    joined = joined.filter(F.col("_n_rows").isNull() | (F.col("_n_kept") > 0))
    return joined.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("product_name"),
        "sku",
        "category_name",
        F.col("price").alias("current_price"),
        F.coalesce(F.col("_orders"), F.lit(0)).cast("bigint").alias("total_orders"),
        F.col("total_quantity_sold").cast("bigint").alias("total_quantity_sold"),
        "total_revenue",
        ratio(F.col("_price_sum"), F.col("_price_n")).alias("avg_selling_price"),
        F.col("stock_quantity").alias("current_stock"),
        stock_status(F.col("stock_quantity")).alias("stock_status"),
    )


def _metric(df: DataFrame, metric_type: str, value: F.Column) -> DataFrame:
    return (df.groupBy(F.to_date("created_at").alias("metric_date"))
              .agg(value.alias("metric_value"))
              .select("metric_date", F.lit(metric_type).alias("metric_type"),
                      F.col("metric_value").cast("bigint").alias("metric_value")))


def funnel_page_views(user_sessions: DataFrame) -> DataFrame:
    return _metric(user_sessions, "page_views", F.count(F.lit(1)))


def funnel_cart_additions(cart_items: DataFrame, carts: DataFrame) -> DataFrame:
    """Cart items per day whose cart exists (J4; a NULL cart drops the item).

    Items are first counted per (cart, day), so a hot cart is one row per map
    task when it meets ``carts``; ``carts.id`` is a primary key, so a semi
    join counts the same rows as the reference's inner join.
    """
    per_cart_day = (cart_items
                    .filter(F.col("cart_id").isNotNull())
                    .groupBy("cart_id", F.to_date("created_at").alias("metric_date"))
                    .agg(F.count(F.lit(1)).alias("_n")))
    present = per_cart_day.join(carts.select(F.col("id").alias("cart_id")), "cart_id", "left_semi")
    return (present.groupBy("metric_date").agg(F.sum("_n").alias("metric_value"))
                   .select("metric_date", F.lit("cart_additions").alias("metric_type"),
                           F.col("metric_value").cast("bigint").alias("metric_value")))


def funnel_checkouts(orders: DataFrame) -> DataFrame:
    """Distinct users per day with a non-pending order (NULL status excluded)."""
    return _metric(orders.filter(F.col("status") != "pending"), "checkouts_started",
                   F.count_distinct("user_id"))


def funnel_orders_completed(orders: DataFrame) -> DataFrame:
    return _metric(orders.filter(F.col("status") == "completed"), "orders_completed",
                   F.count(F.lit(1)))


def funnel_order_metrics(orders: DataFrame) -> DataFrame:
    """The two order branches of V3 from one pass over ``orders``.

    Per day: distinct users with a non-pending order, and completed orders.
    A day gets a row for a metric only when at least one order qualified, as
    in the reference's two filtered GROUP BYs (absent, not 0)."""
    checkout = F.col("status") != "pending"          # NULL status: not counted
    completed = F.col("status") == "completed"
    per_day = (orders.filter(checkout | completed)
               .groupBy(F.to_date("created_at").alias("metric_date"))
               .agg(F.count_distinct(F.when(checkout, F.col("user_id"))).alias("_users"),
                    F.count_if(checkout).alias("_checkout_rows"),
                    F.count_if(completed).alias("_completed")))
    rows = F.array(
        F.struct(F.lit("checkouts_started").alias("metric_type"),
                 F.col("_users").alias("metric_value"),
                 (F.col("_checkout_rows") > 0).alias("_present")),
        F.struct(F.lit("orders_completed").alias("metric_type"),
                 F.col("_completed").alias("metric_value"),
                 (F.col("_completed") > 0).alias("_present")))
    return (per_day.select("metric_date", F.explode(rows).alias("m"))
            .filter(F.col("m._present"))
            .select("metric_date", F.col("m.metric_type").alias("metric_type"),
                    F.col("m.metric_value").cast("bigint").alias("metric_value")))


def funnel_daily_metrics(user_sessions: DataFrame, cart_items: DataFrame, carts: DataFrame,
                         orders: DataFrame) -> DataFrame:
    """V3: long form (metric_date, metric_type, metric_value), UNION ALL of the
    four branches; the two order branches share one scan of ``orders``."""
    return (funnel_page_views(user_sessions)
            .unionByName(funnel_cart_additions(cart_items, carts))
            .unionByName(funnel_order_metrics(orders)))


def sales_funnel(user_sessions: DataFrame, cart_items: DataFrame, carts: DataFrame,
                 orders: DataFrame) -> DataFrame:
    """V4: one row per day, absent metrics NULL (not 0), plus two rates.

    The checkout rate divides completed orders by distinct users, so it can
    pass 100, as in the reference. Sorted by day, NULLs last (PostgreSQL).
    """
    long = funnel_daily_metrics(user_sessions, cart_items, carts, orders)
    sums = [F.sum(F.when(F.col("metric_type") == t, F.col("metric_value"))).alias(t)
            for t in FUNNEL_TYPES]
    wide = long.groupBy("metric_date").agg(*sums)
    return (wide.select(
                "metric_date", *FUNNEL_TYPES,
                pct_round2(F.col("cart_additions"), F.col("page_views")).alias("cart_conversion_rate"),
                pct_round2(F.col("orders_completed"), F.col("checkouts_started"))
                .alias("checkout_conversion_rate"))
            .orderBy(F.asc_nulls_last("metric_date")))
