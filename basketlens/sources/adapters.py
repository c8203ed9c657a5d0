"""Build the shop's operational tables from the driver's TPC-H-like tables.

The driver's tables hold no NULL, no orphan, and every customer and part has
orders, so these adapters plant the awkward rows by key arithmetic. Traps are
planted in columns or by ADDING rows; every given row reaches the queries. Each
adapter is a projection over one scan of its table (``order_items`` adds a slice
of ``orders``), so it adds no shuffle beyond what the metric needs.
The DuckDB oracles (``plans.oracle``) use the same rules.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import literal_rows, ntz
from .tables import read_table

# Fixed values of the fixture rules.
USER_SIGNUP_BASE = "2023-06-01 00:00:00"
PRODUCT_UPDATE_BASE = "2024-01-01 00:00:00"
ORDER_DAY_SHIFT = 8217          # orders move from 1995-2001 onto the events' clock
ORPHAN_ORDER_OFFSET = 1_000_000_000
ORPHAN_CATEGORY_ID = 99
ADDED_CART_ID = 1_000_000_000   # added cart items: this plus the event id,
ADDED_CART_DAYS = 400           # so many days later than any session
ADDED_SESSION_DAYS = -400       # added sessions: so many days before any cart
UNSOLD_OFFSET = 10_000_000      # added products that no item names
OPEN_ONLY_OFFSET = 20_000_000   # added products sold only through open orders
OPEN_ONLY_PRODUCTS = 50
OPEN_ITEM_ID = 4_000_000_000    # their items: this plus the order id
# The six categories, one per p_type value: id, name, slug, parent (one has an absent parent).
CATEGORY_ROWS = [
    (1, "ECONOMY", "economy", None),
    (2, "LARGE", "large", 1),
    (3, "MEDIUM", "medium", 1),
    (4, "PROMO", "promo", None),
    (5, "SMALL", "small", 42),
    (6, "STANDARD", "standard", 4),
]
CATEGORY_SCHEMA = "id bigint, name string, slug string, parent_id bigint"
ORDER_STATUS_BY_CODE = {"F": "completed", "O": "pending", "P": "shipped"}

def _null(type_name: str):
    return F.lit(None).cast(type_name)


def users(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("id"),
        F.col("c_name").alias("email"),
        F.when(k % 71 != 0, F.concat(F.lit("hash-"), k.cast("string"))).alias("password_hash"),
        F.when(k % 31 == 0, _null("string")).otherwise(F.col("c_mktsegment")).alias("first_name"),
        F.col("c_name").alias("last_name"),
        (ntz(USER_SIGNUP_BASE) + F.make_dt_interval((k % 240).cast("int"))).alias("created_at"),
    )


def categories(spark: SparkSession) -> DataFrame:
    """A six-row literal table; joins against it broadcast a bounded side."""
    return literal_rows(spark, CATEGORY_ROWS, CATEGORY_SCHEMA)


def _copies(*offsets):
    """One output row per offset that is not NULL."""
    return F.explode(F.filter(F.array(*[o.cast("bigint") for o in offsets]), lambda x: x.isNotNull()))


def products(part: DataFrame, cats: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    lookup = F.broadcast(cats.select(F.col("id").alias("_cat_id"), F.col("name").alias("_cat_name")))
    joined = part.join(lookup, part["p_type"] == lookup["_cat_name"], "left").withColumn(
        "_offset", _copies(F.lit(0), F.when(k % 17 == 0, UNSOLD_OFFSET),
                           F.when(k < OPEN_ONLY_PRODUCTS, OPEN_ONLY_OFFSET)))
    own = k + F.col("_offset")
    return joined.select(
        own.alias("id"),
        F.col("p_name").alias("name"),
        F.when(k % 73 != 0, F.concat(F.lit("slug-"), own.cast("string"))).alias("slug"),
        F.concat(F.lit("SKU-"), own.cast("string")).alias("sku"),
        F.col("p_retailprice").cast(schemas.MONEY).alias("price"),
        F.when(k % 37 == 0, _null("int"))
         .when(k % 41 == 0, F.lit(-1))
         .otherwise(F.col("p_size") - 1).cast("int").alias("stock_quantity"),
        F.when(k % 23 == 0, _null("bigint"))
         .when(k % 211 == 0, F.lit(ORPHAN_CATEGORY_ID).cast("bigint"))
         .otherwise(F.col("_cat_id")).alias("category_id"),
        (ntz(PRODUCT_UPDATE_BASE) + F.make_dt_interval((k % 30).cast("int"))).alias("updated_at"),
    )


def _order_status(code: str = "o_orderstatus", key: str = "o_orderkey"):
    k = F.col(key)
    status = F.when(k % 53 == 0, _null("string")).when(k % 50 == 0, F.lit("cancelled"))
    for letter, name in ORDER_STATUS_BY_CODE.items():
        status = status.when(F.col(code) == letter, F.lit(name))
    return status


def orders(orders_raw: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    total = F.col("o_totalprice").cast(schemas.MONEY)
    subtotal = F.round(total * F.lit(0.90).cast("decimal(3,2)"), 2).cast(schemas.MONEY)
    tax = F.round(total * F.lit(0.08).cast("decimal(3,2)"), 2).cast(schemas.MONEY)
    return orders_raw.select(
        k.alias("id"),
        F.when(k % 43 == 0, _null("bigint"))
         .when(k % 997 == 0, F.lit(-1).cast("bigint"))
         .when(F.col("o_custkey") % 29 == 0, _null("bigint"))
         .otherwise(F.col("o_custkey")).alias("user_id"),
        F.when(k % 89 != 0, F.concat(F.lit("ORD-"), k.cast("string"))).alias("order_number"),
        _order_status().alias("status"),
        total.alias("total_amount"),
        subtotal.alias("subtotal"),
        tax.alias("tax_amount"),
        (total - subtotal - tax).cast(schemas.MONEY).alias("shipping_amount"),
        (F.col("o_orderdate")
         + F.make_dt_interval(F.lit(ORDER_DAY_SHIFT), (k % 24).cast("int"))).alias("created_at"),
    )


def order_items(lineitem: DataFrame, orders_raw: DataFrame) -> DataFrame:
    """Every line item as an order item, with orphans, NULL order ids and items that name a
    variant but no product; plus one item of an added product on every 97th open order."""
    lk, pk = F.col("l_orderkey"), F.col("l_partkey")
    items = lineitem.select(
        (lk * 8 + F.col("l_linenumber")).alias("id"),
        F.when(lk % 499 == 0, lk + F.lit(ORPHAN_ORDER_OFFSET))
         .when(lk % 503 == 0, _null("bigint"))
         .otherwise(lk).alias("order_id"),
        F.when(lk % 613 != 0, pk).alias("product_id"),
        F.when((lk % 5 == 0) | (lk % 613 == 0), pk).alias("variant_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").cast(schemas.MONEY).alias("price"),
    )
    ok = F.col("o_orderkey")
    open_orders = orders_raw.filter((F.col("o_orderstatus") == "O") & (ok % 97 == 0)
                                    & (ok % 53 != 0) & (ok % 50 != 0))
    return items.unionByName(open_orders.select(
        (ok + F.lit(OPEN_ITEM_ID)).alias("id"), ok.alias("order_id"),
        (F.lit(OPEN_ONLY_OFFSET) + ok % OPEN_ONLY_PRODUCTS).alias("product_id"),
        _null("bigint").alias("variant_id"), (F.lit(1) + ok % 5).cast("int").alias("quantity"),
        F.col("o_totalprice").cast(schemas.MONEY).alias("price")))


def _days_later(ts: str, days: str):
    return F.col(ts) + F.make_dt_interval(F.col(days).cast("int"))


def user_sessions(events: DataFrame) -> DataFrame:
    """Every view and click, plus added sessions on days without carts."""
    e = F.col("event_id")
    return (events.withColumn("_days", _copies(
                F.when(F.col("event_type").isin("view", "click"), 0),
                F.when(e % 103 == 0, ADDED_SESSION_DAYS)))
            .select(_days_later("ts", "_days").alias("created_at")))


def carts(events: DataFrame) -> DataFrame:
    """One cart per distinct user (an aggregate with map-side combine)."""
    return (events.select("user_id").distinct()
            .select(F.col("user_id").alias("id"), F.col("user_id")))


def cart_items(events: DataFrame) -> DataFrame:
    """Every click as a cart addition, plus added ones on days without sessions."""
    e = F.col("event_id")
    added = F.col("_days") > 0
    return (events.withColumn("_days", _copies(F.when(F.col("event_type") == "click", 0),
                                               F.when(e % 101 == 0, ADDED_CART_DAYS)))
            .select(F.when(added, e + ADDED_CART_ID).otherwise(e).alias("id"),
                    F.when(e % 47 == 0, _null("bigint")).otherwise(F.col("user_id")).alias("cart_id"),
                    F.when(e % 17 != 0, e % 180).alias("product_id"),
                    F.when(e % 6 == 0, e % 180).alias("variant_id"),
                    F.when(e % 59 != 0, F.lit(1) + e % 5).cast("int").alias("quantity"),
                    F.col("value").cast(schemas.MONEY).alias("price"),
                    _days_later("ts", "_days").alias("created_at")))


def product_variants(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("id"),
        k.alias("product_id"),
        F.concat(F.lit("VAR-"), k.cast("string")).alias("sku"),
        F.col("p_retailprice").cast(schemas.MONEY).alias("price"),
    )


def addresses(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        k.alias("id"),
        k.alias("user_id"),
        F.col("c_mktsegment").alias("first_name"),
        F.col("c_name").alias("last_name"),
        F.concat(F.lit("Street "), k.cast("string")).alias("address_line_1"),
        F.concat(F.lit("City "), F.col("c_nationkey").cast("string")).alias("city"),
        F.lit("ST").alias("state"),
        F.lpad(k.cast("string"), 5, "0").alias("postal_code"),
        F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string")).alias("country"),
    )


class ShopTables:
    """Lazy bundle of the operational tables built from one driver folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def raw(self, name: str) -> DataFrame:
        return read_table(self.spark, self.sf_dir, name)

    @cached_property
    def users(self) -> DataFrame:
        return users(self.raw("customer"))

    @cached_property
    def categories(self) -> DataFrame:
        return categories(self.spark)

    @cached_property
    def products(self) -> DataFrame:
        return products(self.raw("part"), self.categories)

    @cached_property
    def orders(self) -> DataFrame:
        return orders(self.raw("orders"))

    @cached_property
    def order_items(self) -> DataFrame:
        return order_items(self.raw("lineitem"), self.raw("orders"))

    @cached_property
    def user_sessions(self) -> DataFrame:
        return user_sessions(self.raw("events"))

    @cached_property
    def carts(self) -> DataFrame:
        return carts(self.raw("events"))

    @cached_property
    def cart_items(self) -> DataFrame:
        return cart_items(self.raw("events"))

    @cached_property
    def product_variants(self) -> DataFrame:
        return product_variants(self.raw("part"))

    @cached_property
    def addresses(self) -> DataFrame:
        return addresses(self.raw("customer"))

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def all_tables(self) -> dict[str, DataFrame]:
        names = ["users", "categories", "products", "orders", "order_items",
                 "carts", "cart_items", "product_variants", "addresses"]
        return {n: self.table(n) for n in names}
