"""Orders and order items stored in buckets of the order id.

Both tables are hashed into the same number of buckets on write, once; every later join or grouping by order
reads bucket against bucket and shuffles neither side. Items without an order id cannot match an order. They
would all hash into one bucket, so they lie in a part of their own (``has_order = false``) that is read as
plain files.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import metrics


ROWS_PER_BUCKET, MIN_BUCKETS = 1 << 19, 8


@dataclass
class FactTables:
    """Names of the two stored tables in the session's catalog."""

    spark: SparkSession
    orders_name: str
    items_name: str

    @property
    def orders(self) -> DataFrame:
        return self.spark.table(self.orders_name)

    @property
    def items(self) -> DataFrame:
        """All items, as they were given."""
        return self.spark.table(self.items_name).drop("has_order")

    @property
    def ordered_items(self) -> DataFrame:
        return self.spark.table(self.items_name).filter("has_order").drop("has_order")

    @property
    def loose_items(self) -> DataFrame:
        return self.spark.table(self.items_name).filter("NOT has_order").drop("has_order")


def write_fact_tables(orders: DataFrame, order_items: DataFrame, name: str, path: str,
                      buckets: int | None = None) -> FactTables:
    """Store both tables as ``<name>_orders`` and ``<name>_order_items`` under ``path``. Without ``buckets``
    their number follows the rows of the larger table, so that a bucket stays as small as ROWS_PER_BUCKET
    whatever the tables' size. Rows are shuffled by the key first, so a bucket is one file, whatever the number
    of input tasks."""
    if buckets is None:
        buckets = max(MIN_BUCKETS, -(-max(orders.count(), order_items.count()) // ROWS_PER_BUCKET))

    def write(df: DataFrame, key: str, table: str, parts: list[str]) -> str:
        writer = df.write.mode("overwrite").format("parquet").option("path", f"{path.rstrip('/')}/{table}")
        writer = writer.partitionBy(*parts) if parts else writer
        writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
        return table
    keyed = order_items.withColumn("has_order", F.col("order_id").isNotNull())
    # Items without an order are dealt out by their own id, not to one task.
    spread = F.coalesce(F.col("order_id"), F.xxhash64(*order_items.columns))
    return FactTables(orders.sparkSession,
                      write(orders.repartition(buckets, "id"), "id", f"{name}_orders", []),
                      write(keyed.repartition(buckets, spread), "order_id", f"{name}_order_items",
                            ["has_order"]))


def pairs_with_status(facts: FactTables) -> DataFrame:
    """V2's items per (order, product) with the order's status, from the buckets: neither the sums nor the
    join shuffle."""
    joined = metrics.item_pairs(facts.ordered_items).join(
        facts.orders.select(F.col("id").alias("order_id"), "status"), "order_id", "left")
    loose = metrics.item_pairs(facts.loose_items).withColumn("status", F.lit(None).cast("string"))
    return joined.unionByName(loose)
