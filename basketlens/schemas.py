"""Pinned schemas and the constraint lists declared by the shop's DDL.

Spark enforces none of the DDL constraints, so they are kept here as data and
turned into audit and upkeep jobs (``operators.quality``, ``operators.upkeep``).
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- driver tables (read with these schemas, never inferred) ---------------

CUSTOMER = T.StructType([
    T.StructField("c_custkey", T.LongType()),
    T.StructField("c_name", T.StringType()),
    T.StructField("c_nationkey", T.IntegerType()),
    T.StructField("c_acctbal", T.DoubleType()),
    T.StructField("c_mktsegment", T.StringType()),
])

PART = T.StructType([
    T.StructField("p_partkey", T.LongType()),
    T.StructField("p_name", T.StringType()),
    T.StructField("p_brand", T.StringType()),
    T.StructField("p_type", T.StringType()),
    T.StructField("p_size", T.IntegerType()),
    T.StructField("p_retailprice", T.DoubleType()),
])

ORDERS = T.StructType([
    T.StructField("o_orderkey", T.LongType()),
    T.StructField("o_custkey", T.LongType()),
    T.StructField("o_orderstatus", T.StringType()),
    T.StructField("o_totalprice", T.DoubleType()),
    T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()),
])

LINEITEM = T.StructType([
    T.StructField("l_orderkey", T.LongType()),
    T.StructField("l_partkey", T.LongType()),
    T.StructField("l_suppkey", T.LongType()),
    T.StructField("l_linenumber", T.IntegerType()),
    T.StructField("l_quantity", T.DoubleType()),
    T.StructField("l_extendedprice", T.DoubleType()),
    T.StructField("l_discount", T.DoubleType()),
    T.StructField("l_tax", T.DoubleType()),
    T.StructField("l_returnflag", T.StringType()),
    T.StructField("l_linestatus", T.StringType()),
    T.StructField("l_shipdate", T.TimestampNTZType()),
])

EVENTS = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("props", T.StringType()),
])

DRIVER_TABLES = {
    "customer": CUSTOMER,
    "part": PART,
    "orders": ORDERS,
    "lineitem": LINEITEM,
    "events": EVENTS,
}

# --- operational tables (the shapes the metrics read) ----------------------

MONEY = T.DecimalType(10, 2)
# Sums of money: decimal(10,2) stops at 99,999,999.99, too narrow for totals.
MONEY_SUM = T.DecimalType(20, 2)

USERS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("email", T.StringType(), False),
    T.StructField("first_name", T.StringType(), False),
    T.StructField("last_name", T.StringType(), False),
    T.StructField("created_at", T.TimestampNTZType()),
])

CATEGORIES = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
])

PRODUCTS = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("name", T.StringType(), False),
    T.StructField("sku", T.StringType(), False),
    T.StructField("price", MONEY, False),
    T.StructField("stock_quantity", T.IntegerType()),
    T.StructField("category_id", T.LongType()),
    T.StructField("updated_at", T.TimestampNTZType()),
])

ORDERS_OP = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("user_id", T.LongType()),
    T.StructField("status", T.StringType()),
    T.StructField("total_amount", MONEY, False),
    T.StructField("subtotal", MONEY, False),
    T.StructField("tax_amount", MONEY),
    T.StructField("shipping_amount", MONEY),
    T.StructField("created_at", T.TimestampNTZType()),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("price", MONEY, False),
])

OPERATIONAL = {
    "users": USERS,
    "categories": CATEGORIES,
    "products": PRODUCTS,
    "orders": ORDERS_OP,
    "order_items": ORDER_ITEMS,
}

# --- declared constraints (fixed values, from the shop's DDL) --------------

# Primary keys and UNIQUE columns, as (table, key columns).
UNIQUE_KEYS = [
    ("users", ("id",)),
    ("users", ("email",)),
    ("categories", ("id",)),
    ("categories", ("slug",)),
    ("products", ("id",)),
    ("products", ("slug",)),
    ("products", ("sku",)),
    ("product_variants", ("id",)),
    ("product_variants", ("sku",)),
    ("carts", ("id",)),
    ("cart_items", ("id",)),
    ("orders", ("id",)),
    ("orders", ("order_number",)),
    ("order_items", ("id",)),
    ("addresses", ("id",)),
]

# NOT NULL columns per table (primary keys included).
NOT_NULL = {
    "users": ["id", "email", "password_hash", "first_name", "last_name"],
    "categories": ["id", "name", "slug"],
    "products": ["id", "name", "slug", "sku", "price"],
    "product_variants": ["id", "sku", "price"],
    "carts": ["id"],
    "cart_items": ["id", "quantity", "price"],
    "orders": ["id", "order_number", "total_amount", "subtotal"],
    "order_items": ["id", "quantity", "price"],
    "addresses": ["id", "first_name", "last_name", "address_line_1", "city", "state",
                  "postal_code", "country"],
}

# Foreign keys: (child table, child column, parent table, parent column, on delete cascade).
FOREIGN_KEYS = [
    ("categories", "parent_id", "categories", "id", False),
    ("products", "category_id", "categories", "id", False),
    ("product_variants", "product_id", "products", "id", True),
    ("carts", "user_id", "users", "id", True),
    ("cart_items", "cart_id", "carts", "id", True),
    ("cart_items", "product_id", "products", "id", False),
    ("cart_items", "variant_id", "product_variants", "id", False),
    ("orders", "user_id", "users", "id", False),
    ("order_items", "order_id", "orders", "id", True),
    ("order_items", "product_id", "products", "id", False),
    ("order_items", "variant_id", "product_variants", "id", False),
    ("addresses", "user_id", "users", "id", True),
]

# Column defaults for columns an input may lack: table -> [(column, SQL literal, type)].
# An explicit NULL in the input stays NULL; only absent columns are filled.
DEFAULTS = {
    "users": [("role", "'customer'", "string"), ("is_verified", "false", "boolean"),
              ("created_at", "localtimestamp()", "timestamp_ntz"),
              ("updated_at", "localtimestamp()", "timestamp_ntz")],
    "categories": [("is_active", "true", "boolean"),
                   ("created_at", "localtimestamp()", "timestamp_ntz")],
    "products": [("stock_quantity", "0", "int"), ("track_quantity", "true", "boolean"),
                 ("is_active", "true", "boolean"),
                 ("created_at", "localtimestamp()", "timestamp_ntz"),
                 ("updated_at", "localtimestamp()", "timestamp_ntz")],
    "product_variants": [("stock_quantity", "0", "int"), ("is_active", "true", "boolean"),
                         ("created_at", "localtimestamp()", "timestamp_ntz")],
    "carts": [("created_at", "localtimestamp()", "timestamp_ntz"),
              ("updated_at", "localtimestamp()", "timestamp_ntz")],
    "cart_items": [("quantity", "1", "int"),
                   ("created_at", "localtimestamp()", "timestamp_ntz")],
    "orders": [("status", "'pending'", "string"), ("tax_amount", "0", "decimal(10,2)"),
               ("shipping_amount", "0", "decimal(10,2)"),
               ("discount_amount", "0", "decimal(10,2)"),
               ("payment_status", "'pending'", "string"),
               ("created_at", "localtimestamp()", "timestamp_ntz"),
               ("updated_at", "localtimestamp()", "timestamp_ntz")],
    "order_items": [("created_at", "localtimestamp()", "timestamp_ntz")],
    "addresses": [("type", "'shipping'", "string"), ("is_default", "false", "boolean"),
                  ("created_at", "localtimestamp()", "timestamp_ntz")],
}

# --- event tables -----------------------------------------------------------

RAW_EVENT = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

USER_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("page", T.StringType(), False),
    T.StructField("session_id", T.StringType()),
    T.StructField("user_agent", T.StringType()),
    T.StructField("ip_address", T.StringType()),
    T.StructField("metadata", T.StringType(), False),
])

PRODUCT_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("product_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("quantity", T.IntegerType(), False),
    T.StructField("price", T.DoubleType()),
    T.StructField("category_id", T.StringType()),
    T.StructField("metadata", T.StringType(), False),
])

ORDER_EVENTS = T.StructType([
    T.StructField("event_id", T.StringType(), False),
    T.StructField("timestamp", T.TimestampNTZType(), False),
    T.StructField("order_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("user_id", T.StringType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("items", T.StringType(), False),
    T.StructField("payment_method", T.StringType()),
    T.StructField("metadata", T.StringType(), False),
])

DEAD_LETTER = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("value", T.StringType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("reason", T.StringType(), False),
])

# Topic -> (entity key field, table schema, physical sort keys).
TOPICS = {
    "user_events": ("user_id", USER_EVENTS, ("timestamp", "user_id")),
    "product_events": ("product_id", PRODUCT_EVENTS, ("timestamp", "product_id")),
    "order_events": ("order_id", ORDER_EVENTS, ("timestamp", "order_id")),
}

# --- daily job targets --------------------------------------------------------

DAILY_SALES_SUMMARY = T.StructType([
    T.StructField("order_date", T.DateType()),
    T.StructField("category_name", T.StringType()),
    T.StructField("total_orders", T.LongType()),
    T.StructField("unique_customers", T.LongType()),
    T.StructField("total_revenue", MONEY_SUM),
    T.StructField("total_items_sold", T.LongType()),
    T.StructField("created_at", T.TimestampNTZType()),
])

HOURLY_SALES_SUMMARY = T.StructType([
    T.StructField("order_date", T.DateType()),
    T.StructField("order_hour", T.IntegerType()),
    T.StructField("hourly_orders", T.LongType()),
    T.StructField("hourly_revenue", MONEY_SUM),
    T.StructField("created_at", T.TimestampNTZType()),
])
