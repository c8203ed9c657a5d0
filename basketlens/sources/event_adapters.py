"""Raw event messages built from the driver's tables (the producer's input).

user events   <- events (signup, error): key user_id, page '/<type>', metadata = props
product events<- events (view, click -> add_to_cart, purchase): product = event_id % 200,
                 price = value, quantity = 1 + event_id % 5; the key is left out when
                 event_id % 7 = 0 and sent as an explicit null when event_id % 11 = 0
order events  <- shop orders + lineitem: one 'created' event per order, items in line order
bad messages  <- a few literal rows, one per rejection path

Every row of the driver's tables becomes a message, so the stream grows with
the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import literal_rows
from ..streaming import events as ev

PRODUCT_TYPES = {"view": "view", "click": "add_to_cart", "purchase": "purchase"}
USER_TYPES = ["signup", "error"]
PRODUCT_ID_MODULUS = 200

# Bad messages (fixed values): topic, key, value, expected reason.
BAD_MESSAGES = [
    ("user_events", "u-bad-1", "not json{", "malformed_json"),
    ("user_events", "7",
     '{"timestamp": "2024-01-15T10:00:00", "user_id": "7", "event_type": "signup", '
     '"page": "/signup"}', "missing_field:event_id"),
    ("user_events", None,
     '{"event_id": "bad-3", "timestamp": "2024-01-15T10:00:00", "user_id": null, '
     '"event_type": "signup", "page": "/signup"}', "null_field:user_id"),
    ("product_events", "5",
     '{"event_id": "bad-4", "timestamp": "2024-01-15T10:00:00", "product_id": "5", '
     '"event_type": "view", "quantity": "x"}', "bad_quantity"),
    ("order_events", "9",
     '{"event_id": "bad-6", "timestamp": "yesterday", "order_id": "9", '
     '"event_type": "created"}', "bad_timestamp"),
    ("audit_events", "1", '{"event_id": "bad-5"}', "unknown_topic"),
    ("user_events", "8",
     '{"event_id": "bad-8", "timestamp": "2024-01-15T10:00:00", "user_id": "8", '
     '"event_type": "signup", "page": "/signup"} and more', "malformed_json"),
    ("product_events", "9",
     '{"event_id": "bad-9", "timestamp": "2024-01-15T10:00:00", "product_id": "9", '
     '"event_type": "view", "product_id": "10"}', "malformed_json"),
    ("user_events", "10",
     '{"event_id": "bad-10", "timestamp": "2024-01-15T10:00:00", "user_id": "10", '
     '"event_type": "signup", "page": {"a": 1}}', "bad_type:page"),
    ("product_events", "11",
     '{"event_id": "bad-11", "timestamp": "2024-01-15T10:00:00", "product_id": "11", '
     '"event_type": "view", "quantity": "3"}', "bad_quantity"),
]
# A good message whose time has a zone: it is stored as the same moment in UTC.
ZONED_MESSAGE = ("user_events", "12",
                 '{"event_id": "zoned-12", "timestamp": "2024-01-15T10:00:00+05:00", "user_id": "12", '
                 '"event_type": "signup", "page": "/signup"}')
BAD_MESSAGE_TIME = "2024-01-15 10:00:00"


def user_event_rows(events: DataFrame) -> DataFrame:
    return (events.filter(F.col("event_type").isin(*USER_TYPES))
            .select("event_id", F.col("ts").alias("timestamp"), "user_id", "event_type",
                    F.concat(F.lit("/"), F.col("event_type")).alias("page"),
                    F.col("props").alias("metadata")))


def product_event_rows(events: DataFrame) -> DataFrame:
    e = F.col("event_id")
    mapped = F.when(F.lit(False), F.lit(None))
    for src, dst in PRODUCT_TYPES.items():
        mapped = mapped.when(F.col("event_type") == src, F.lit(dst))
    return (events.filter(F.col("event_type").isin(*PRODUCT_TYPES))
            .select("event_id", F.col("ts").alias("timestamp"),
                    (e % PRODUCT_ID_MODULUS).alias("product_id"),
                    mapped.alias("event_type"), "user_id",
                    F.when(e % 11 == 0, F.lit(None).cast("int"))
                     .otherwise((F.lit(1) + e % 5).cast("int")).alias("quantity"),
                    F.col("value").alias("price"),
                    F.col("props").alias("metadata"),
                    (e % 7 == 0).alias("_omit_quantity")))


def order_event_rows(shop_orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One row per order with all its lines in one list, as the producer sends one
    message per order. The list is one order's lines, the size of one message."""
    per_order = (lineitem.groupBy(F.col("l_orderkey").alias("_oid"))
                 .agg(F.sort_array(F.collect_list(F.struct(
                     F.col("l_linenumber").alias("n"),
                     F.col("l_partkey").alias("product_id"),
                     F.col("l_quantity").cast("int").alias("quantity"),
                     F.col("l_extendedprice").alias("price")))).alias("_lines")))
    o = shop_orders.select("id", "user_id", "total_amount", "created_at")
    joined = o.join(per_order, o["id"] == per_order["_oid"], "left")
    items = F.coalesce(
        F.transform("_lines", lambda x: F.struct(x["product_id"].alias("product_id"),
                                                 x["quantity"].alias("quantity"),
                                                 x["price"].alias("price"))),
        F.array().cast("array<struct<product_id:bigint,quantity:int,price:double>>"))
    return joined.select(F.concat(F.lit("order-"), F.col("id").cast("string")).alias("event_id"),
                         F.col("created_at").alias("timestamp"),
                         F.col("id").alias("order_id"), F.lit("created").alias("event_type"),
                         "user_id", F.col("total_amount").cast("double").alias("total_amount"),
                         items.alias("items"))


def envelopes(events: DataFrame, shop_orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """E1-E3 over the driver's tables: (topic, key, value, event_time)."""
    users = ev.user_event_envelopes(user_event_rows(events))
    products = ev.product_event_envelopes(product_event_rows(events),
                                          omit_quantity=F.col("_omit_quantity"))
    orders = ev.order_event_envelopes(order_event_rows(shop_orders, lineitem))
    return users.unionByName(products).unionByName(orders)


def bad_messages(spark: SparkSession) -> DataFrame:
    rows = [(t, k, v) for t, k, v, _ in BAD_MESSAGES] + [ZONED_MESSAGE]
    df = literal_rows(spark, rows, "topic string, key string, value string")
    return df.withColumn("timestamp", F.lit(BAD_MESSAGE_TIME).cast("timestamp_ntz"))


def raw_stream_rows(spark: SparkSession, events: DataFrame, shop_orders: DataFrame,
                    lineitem: DataFrame) -> DataFrame:
    """The raw stream as a batch frame with the RAW_EVENT schema."""
    good = envelopes(events, shop_orders, lineitem).withColumnRenamed("event_time", "timestamp")
    out = good.unionByName(bad_messages(spark))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                        for f in schemas.RAW_EVENT.fields])
