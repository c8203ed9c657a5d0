"""The ten dashboard cards (C1-C10), composed from the metric views.

Each card takes an explicit ``as_of`` clock (``None`` = now); Catalyst folds
``as_of - interval`` into a constant and pushes the window filter to the scan.
Because the cards are functions over lazy views, pruning reaches through both
layers (the low-stock card reads three columns of product_performance, so the
unused aggregates are dropped from the plan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import as_of_ts, days_before, ratio
from ..operators import metrics


def _completed_since(orders: DataFrame, as_of, days: int) -> DataFrame:
    return orders.filter((F.col("status") == "completed")
                         & (F.col("created_at") >= days_before(as_of, days)))


def card_revenue_30d(orders: DataFrame, as_of=None) -> DataFrame:
    """Revenue of completed orders in the last 30 days (NULL when none)."""
    return _completed_since(orders, as_of, 30).agg(F.sum("total_amount").alias("revenue"))


def card_new_customers_30d(users: DataFrame, as_of=None) -> DataFrame:
    """Users created in the last 30 days."""
    return (users.filter(F.col("created_at") >= days_before(as_of, 30))
                 .agg(F.count(F.lit(1)).alias("new_customers")))


def card_avg_order_value(orders: DataFrame, as_of=None) -> DataFrame:
    """Average completed order value, last 30 days (double, NULL when none)."""
    return (_completed_since(orders, as_of, 30)
            .agg(ratio(F.sum("total_amount"), F.count("total_amount")).alias("avg_order_value")))


def card_daily_revenue_trend(orders: DataFrame, as_of=None) -> DataFrame:
    """C4: completed revenue per day over 90 days, oldest first."""
    return (_completed_since(orders, as_of, 90)
            .groupBy(F.to_date("created_at").alias("date"))
            .agg(F.sum("total_amount").alias("revenue"))
            .orderBy(F.asc_nulls_last("date")))


def card_top_products(product_perf: DataFrame, k: int = 20) -> DataFrame:
    """Top ``k`` products by revenue. PostgreSQL sorts NULLs first on DESC,
    so unsold products lead (F6); the product id makes ties deterministic.
    Plans as TakeOrderedAndProject: a per-task top-k, never a full sort."""
    return (product_perf
            .orderBy(F.desc_nulls_first("total_revenue"), F.asc("product_id"))
            .limit(k))


def card_low_stock(product_perf: DataFrame) -> DataFrame:
    """Products low on or out of stock."""
    return (product_perf
            .filter(F.col("stock_status").isin(metrics.STOCK_LOW, metrics.STOCK_OUT))
            .select("product_name", "current_stock", "stock_status"))


def card_category_performance(product_perf: DataFrame) -> DataFrame:
    """Revenue per category, largest first, NULL revenue first."""
    return (product_perf.groupBy("category_name")
            .agg(F.sum("total_revenue").alias("revenue"))
            .orderBy(F.desc_nulls_first("revenue"), F.asc_nulls_last("category_name")))


def card_clv_values(clv: DataFrame) -> DataFrame:
    """The raw lifetime values behind the histogram."""
    return clv.filter(F.col("total_orders") > 0).select("estimated_annual_value")


def clv_histogram(clv: DataFrame, bins: int, lo: float | None = None,
                  hi: float | None = None) -> DataFrame:
    """C8 binned on the cluster, so raw values never travel to the chart.

    Without bounds the range is the values' own, from a one-row aggregate, and the
    largest value falls into the last bucket. With bounds, bucket 0 holds values below ``lo``, bucket ``bins + 1`` values at or above
    ``hi`` (``width_bucket`` semantics), so no value is dropped. One partial
    count per bucket per task is shuffled.
    """
    v = F.col("estimated_annual_value")
    last = bins + 1
    if lo is None or hi is None:
        own = card_clv_values(clv).agg(F.min(v), F.max(v)).first()
        lo, hi = (0.0, 1.0) if own[0] is None else own
        hi = hi if hi > lo else lo + 1.0
        last = bins
    if not (hi > lo) or bins < 1:
        raise ValueError("need hi > lo and bins >= 1")
    width = (hi - lo) / bins
    bucket = (F.when(v < F.lit(lo), F.lit(0))
               .when(v >= F.lit(hi), F.lit(last))
               .otherwise(F.floor((v - F.lit(lo)) / F.lit(width)).cast("int") + 1))
    counted = (card_clv_values(clv).filter(v.isNotNull())
               .groupBy(bucket.cast("int").alias("bucket"))
               .agg(F.count(F.lit(1)).alias("customers")))
    b = F.col("bucket")
    return counted.select(
        "bucket",
        F.when(b == 0, F.lit(None).cast("double"))
         .otherwise(F.lit(lo) + (b - 1).cast("double") * F.lit(width)).alias("bucket_low"),
        F.when(b == bins + 1, F.lit(None).cast("double"))
         .otherwise(F.lit(lo) + b.cast("double") * F.lit(width)).alias("bucket_high"),
        "customers",
    ).orderBy("bucket")


def card_customer_segments(clv: DataFrame) -> DataFrame:
    """Customers per segment."""
    return clv.groupBy("customer_segment").agg(F.count(F.lit(1)).alias("count"))


def card_sales_funnel_30d(funnel: DataFrame, as_of=None) -> DataFrame:
    """The funnel rows of the last 30 days (``CURRENT_DATE - 30 days``)."""
    since = F.date_sub(F.to_date(as_of_ts(as_of)), 30)
    return funnel.filter(F.col("metric_date") >= since)
