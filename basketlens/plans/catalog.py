"""The checked queries: one callable per operator key, each ``(spark, sf_dir)
-> DataFrame``. Every query reads the driver's tables (through the adapters)
in full; the only limit is the top-20 card, where the limit is the feature.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import literal_rows, portable
from ..operators import metrics, monitor, quality, reach, sales, upkeep
from ..session import follow_size, scratch_path
from ..sinks import bucketed, versions
from ..sinks import tables as sink_tables
from ..sources import event_adapters
from ..sources.adapters import ShopTables
from ..sources.tables import read_csv_staging
from ..streaming import events, ingest
from . import cards, sql_views

# Fixed clocks of the checked queries (the fixtures' "now").
AS_OF = dt.datetime(2024, 1, 31, 0, 0, 0)

FUNNEL_COUNTS = ("page_views", "cart_additions", "checkouts_started", "orders_completed")

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str, doubles: tuple[str, ...] = ()):
    """Register ``fn(tables) -> DataFrame`` under ``name``; ``doubles`` are the
    integer columns that may hold NULL (exported as double, see ``portable``)."""
    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            follow_size(spark)
            return portable(fn(ShopTables(spark, sf_dir)), doubles)
        run.__name__ = name
        run.__doc__ = fn.__doc__
        _REGISTRY[name] = run
        return fn
    return wrap


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)


# --- V1-V4 --------------------------------------------------------------------

@register("customer_lifetime_value")
def _clv(t: ShopTables) -> DataFrame:
    return metrics.customer_lifetime_value(t.users, t.orders)


@register("product_performance", doubles=("total_quantity_sold", "current_stock"))
def _pp(t: ShopTables) -> DataFrame:
    return metrics.product_performance(t.products, t.categories, t.order_items, t.orders)


@register("funnel_page_views")
def _fpv(t: ShopTables) -> DataFrame:
    return metrics.funnel_page_views(t.user_sessions)


@register("funnel_cart_additions")
def _fca(t: ShopTables) -> DataFrame:
    return metrics.funnel_cart_additions(t.cart_items, t.carts)


@register("funnel_checkouts")
def _fco(t: ShopTables) -> DataFrame:
    return metrics.funnel_checkouts(t.orders)


@register("funnel_orders_completed")
def _foc(t: ShopTables) -> DataFrame:
    return metrics.funnel_orders_completed(t.orders)


@register("funnel_daily_metrics")
def _fdm(t: ShopTables) -> DataFrame:
    return metrics.funnel_daily_metrics(t.user_sessions, t.cart_items, t.carts, t.orders)


@register("sales_funnel", doubles=FUNNEL_COUNTS)
def _sf(t: ShopTables) -> DataFrame:
    return metrics.sales_funnel(t.user_sessions, t.cart_items, t.carts, t.orders)


# --- C1-C10 -------------------------------------------------------------------

CLV_BINS = 50


def _pp_of(t: ShopTables) -> DataFrame:
    return metrics.product_performance(t.products, t.categories, t.order_items, t.orders)


def _clv_of(t: ShopTables) -> DataFrame:
    return metrics.customer_lifetime_value(t.users, t.orders)


@register("card_revenue_30d")
def _c1(t: ShopTables) -> DataFrame:
    return cards.card_revenue_30d(t.orders, AS_OF)


@register("card_new_customers_30d")
def _c2(t: ShopTables) -> DataFrame:
    return cards.card_new_customers_30d(t.users, AS_OF)


@register("card_avg_order_value")
def _c3(t: ShopTables) -> DataFrame:
    return cards.card_avg_order_value(t.orders, AS_OF)


@register("card_daily_revenue_trend")
def _c4(t: ShopTables) -> DataFrame:
    return cards.card_daily_revenue_trend(t.orders, AS_OF)


@register("card_top_products", doubles=("total_quantity_sold", "current_stock"))
def _c5(t: ShopTables) -> DataFrame:
    return cards.card_top_products(_pp_of(t), 20)


@register("card_low_stock", doubles=("current_stock",))
def _c6(t: ShopTables) -> DataFrame:
    return cards.card_low_stock(_pp_of(t))


@register("card_category_performance")
def _c7(t: ShopTables) -> DataFrame:
    return cards.card_category_performance(_pp_of(t))


@register("card_clv_values")
def _c8(t: ShopTables) -> DataFrame:
    return cards.card_clv_values(_clv_of(t))


@register("card_clv_histogram")
def _c8h(t: ShopTables) -> DataFrame:
    return cards.clv_histogram(_clv_of(t), CLV_BINS)


@register("card_customer_segments")
def _c9(t: ShopTables) -> DataFrame:
    return cards.card_customer_segments(_clv_of(t))


@register("card_sales_funnel_30d", doubles=FUNNEL_COUNTS)
def _c10(t: ShopTables) -> DataFrame:
    return cards.card_sales_funnel_30d(
        metrics.sales_funnel(t.user_sessions, t.cart_items, t.carts, t.orders), AS_OF)


# --- S6: views and cards as SQL -------------------------------------------------

SHOP_TABLES = ("users", "categories", "products", "orders", "order_items", "carts", "cart_items",
               "user_sessions")


def _sql(t: ShopTables) -> SparkSession:
    sql_views.register_tables(t.spark, {name: getattr(t, name) for name in SHOP_TABLES})
    sql_views.create_views(t.spark)
    sql_views.create_cards(t.spark)
    return t.spark


@register("sql_customer_lifetime_value")
def _v1_sql(t: ShopTables) -> DataFrame:
    return _sql(t).sql("SELECT * FROM customer_lifetime_value")


@register("sql_product_performance", doubles=("total_quantity_sold", "current_stock"))
def _v2_sql(t: ShopTables) -> DataFrame:
    return _sql(t).sql("SELECT * FROM product_performance")


@register("sql_sales_funnel", doubles=FUNNEL_COUNTS)
def _v4_sql(t: ShopTables) -> DataFrame:
    return _sql(t).sql("SELECT * FROM sales_funnel")


# Per card: the text that names a row, and its figure.
CARD_CELLS = {
    "card_revenue_30d": ("'all'", "revenue"), "card_new_customers_30d": ("'all'", "new_customers"),
    "card_avg_order_value": ("'all'", "avg_order_value"),
    "card_daily_revenue_trend": ("CAST(date AS STRING)", "revenue"),
    "card_top_products": ("CAST(product_id AS STRING)", "total_revenue"),
    "card_low_stock": ("concat(product_name, ' ', stock_status)", "current_stock"),
    "card_category_performance": ("category_name", "revenue"),
    "card_clv_values": ("'each'", "estimated_annual_value"),
    "card_customer_segments": ("customer_segment", "count"),
    "card_sales_funnel_30d": ("CAST(metric_date AS STRING)", "checkouts_started"),
}


@register("sql_cards")
def _cards_sql(t: ShopTables) -> DataFrame:
    """C1-C10 as one SQL text over the table functions: a row per card and cell."""
    clock = f"TIMESTAMP_NTZ'{AS_OF}'"
    return _sql(t).sql(" UNION ALL ".join(
        f"SELECT '{name}' AS card, {label} AS cell, CAST({value} AS DOUBLE) AS value "
        f"FROM {name}({clock if sql_views.CARDS[name][0] else ''})"
        for name, (label, value) in CARD_CELLS.items()))


# --- T1-T4, K1-K3, K7 ---------------------------------------------------------

RUN_DATE = dt.date(2024, 1, 30)   # the day a 02:00 run on the as_of day loads


def _extract_of(t: ShopTables, run_date=None) -> DataFrame:
    return sales.daily_sales_extract(t.orders, t.order_items, t.products, t.categories,
                                     t.users, run_date)


@register("daily_sales_extract")
def _t1(t: ShopTables) -> DataFrame:
    """T1 over all days (the backfill form)."""
    return _extract_of(t)


@register("daily_sales_extract_day")
def _t1d(t: ShopTables) -> DataFrame:
    """T1 for one run date, as the daily job runs it."""
    return _extract_of(t, RUN_DATE)


@register("daily_sales_summary")
def _t2(t: ShopTables) -> DataFrame:
    return sales.daily_sales_summary(_extract_of(t))


@register("hourly_sales_summary")
def _t3(t: ShopTables) -> DataFrame:
    return sales.hourly_sales_summary(_extract_of(t))


@register("pipeline_row_counts")
def _k7(t: ShopTables) -> DataFrame:
    return sales.pipeline_row_counts(_extract_of(t))


@register("daily_sales_backfill")
def _t4(t: ShopTables) -> DataFrame:
    """T4: run the job over all days into a fresh target under the session's
    shared checkpoint folder, then read both loaded tables back."""
    target = scratch_path(t.spark, "daily_pipeline")
    sales.run_daily_pipeline(t.spark, t, target, run_date=None)
    return _both_summaries(*(sink_tables.read_summary(t.spark, path(target)).drop("created_at")
                             for path in (sink_tables.daily_path, sink_tables.hourly_path)))


def _both_summaries(daily: DataFrame, hourly: DataFrame) -> DataFrame:
    return daily.select(F.lit("daily").alias("summary"), "order_date", "category_name",
                        F.lit(-1).alias("order_hour"), F.col("total_orders").alias("orders"),
                        F.col("unique_customers").alias("customers"),
                        F.col("total_revenue").alias("revenue"),
                        F.col("total_items_sold").alias("items_sold")).unionByName(
        hourly.select(F.lit("hourly").alias("summary"), "order_date",
                      F.lit("all").alias("category_name"), "order_hour",
                      F.col("hourly_orders").alias("orders"), F.lit(-1).cast("bigint").alias("customers"),
                      F.col("hourly_revenue").alias("revenue"),
                      F.lit(-1).cast("bigint").alias("items_sold")))


@register("versioned_backfill")
def _t4_versions(t: ShopTables) -> DataFrame:
    """T4 with versions: an earlier state of the shop is loaded (some orders not there yet), then a run is
    stopped after its tables and before its commit, then all orders come in as a load of the changed
    days. Both tables as readers see them."""
    target = scratch_path(t.spark, "versions")
    early = _EarlyShop(t)
    sales.run_versioned_pipeline(t.spark, early, target, "early", load_time=LOAD_TIME)
    part = sales.daily_sales_summary(_extract_of(t, RUN_DATE))
    versions.write_tables({"daily_sales_summary": sink_tables.stamped(part, "daily_sales_summary", LOAD_TIME)},
                          target, "stopped", "order_date")
    sales.run_versioned_pipeline(t.spark, t, target, "now", load_time=LOAD_TIME)
    return _both_summaries(*(sink_tables.read_loaded(t.spark, target, n).drop("created_at")
                             for n in ("daily_sales_summary", "hourly_sales_summary")))


class _EarlyShop:
    """The shop before the orders of three days came in, and with one order of a fourth day missing."""
    def __init__(self, t: ShopTables):
        self.order_items, self.products, self.categories, self.users = (
            t.order_items, t.products, t.categories, t.users)
        late = F.to_date("created_at").isin(*[(AS_OF - dt.timedelta(days=d)).date() for d in (1, 30, 90)])
        self.orders = t.orders.filter(~F.coalesce(late, F.lit(False)) & (F.col("id") != 7))


@register("distinct_customers_by_range")
def _a2(t: ShopTables) -> DataFrame:
    """Distinct customers per category and distinct checkout users over months, years and the last
    30 and 90 days, all merged from one bitmap per day."""
    extract = _extract_of(t)
    checkouts = t.orders.filter(F.col("status") != "pending").select(
        F.lit("checkouts").alias("group"), "user_id", F.to_date("created_at").alias("day"))
    rows = extract.select(F.concat(F.lit("category "), "category_name").alias("group"), "user_id",
                          F.col("order_date").alias("day")).unionByName(checkouts)
    daily = reach.daily_bitmaps(rows, F.col("day"), "user_id", ["group"])
    months = reach.roll_up(daily, "month", ["group"])
    years = reach.roll_up(months, "year", ["group"])
    last = literal_rows(t.spark, [(f"last {n} days", (AS_OF - dt.timedelta(days=n)).date(),
                                   (AS_OF - dt.timedelta(days=1)).date()) for n in (30, 90)],
                        "range_name string, first_day date, last_day date")
    recent = reach.over_ranges(daily, last, ["group"])
    named = [b.withColumn("range_name", F.concat(F.lit(f"{grain} "), F.col("day").cast("string"))).drop("day")
             for grain, b in (("month", months), ("year", years))]
    merged = named[0].unionByName(named[1]).unionByName(recent)
    return reach.count_bitmaps(merged, ["range_name", "group"], "users")


def _facts(t: ShopTables) -> bucketed.FactTables:
    path = scratch_path(t.spark, "facts")
    return bucketed.write_fact_tables(t.orders, t.order_items, f"facts_{path[-12:]}", path)


@register("bucketed_extract")
def _t1_bucketed(t: ShopTables) -> DataFrame:
    """T1 from facts stored in buckets of the order id: the item join shuffles neither side."""
    facts = _facts(t)
    return sales.daily_sales_extract(facts.orders, facts.ordered_items, t.products, t.categories, t.users,
                                     bucketed=True)


@register("bucketed_product_performance", doubles=("total_quantity_sold", "current_stock"))
def _v2_bucketed(t: ShopTables) -> DataFrame:
    """V2 from the same stored facts."""
    return metrics.product_performance_of(bucketed.pairs_with_status(_facts(t)), t.products, t.categories)


@register("csv_staging_roundtrip")
def _k3(t: ShopTables) -> DataFrame:
    """K3 + S5: the extract written as header CSV and read back with its schema."""
    extract = _extract_of(t)
    path = scratch_path(t.spark, "csv_staging")
    sink_tables.write_csv_staging(extract, path)
    return read_csv_staging(t.spark, path, extract.schema)


# --- Q1-Q4, R1-R3 ---------------------------------------------------------------

@register("dq_freshness")
def _q1(t: ShopTables) -> DataFrame:
    return quality.check_data_freshness(t.orders, "created_at", 24, AS_OF, "orders")


@register("dq_null_rates")
def _q2(t: ShopTables) -> DataFrame:
    return quality.check_null_rates(t.orders, ["user_id", "total_amount", "status"])


@register("dq_orphans")
def _q3(t: ShopTables) -> DataFrame:
    return quality.check_referential_integrity(t.order_items, "order_id", t.orders, "id",
                                               "order_items", "orders")


@register("dq_all_checks")
def _q4(t: ShopTables) -> DataFrame:
    return quality.run_all_checks(t.all_tables(), AS_OF)


@register("audit_unique")
def _r1(t: ShopTables) -> DataFrame:
    return quality.audit_unique(t.all_tables())


@register("audit_not_null")
def _r2(t: ShopTables) -> DataFrame:
    return quality.audit_not_null(t.all_tables())


@register("audit_foreign_keys")
def _r3(t: ShopTables) -> DataFrame:
    return quality.audit_foreign_keys(t.all_tables())


# --- M1-M6 ------------------------------------------------------------------------

def _trailing_of(t: ShopTables) -> DataFrame:
    return monitor.trailing_average(monitor.daily_revenue(t.orders, AS_OF))


LOAD_TIME = dt.datetime(2024, 1, 29, 20, 0, 0)


def _loaded_summary(t: ShopTables) -> DataFrame:
    """The daily summary table after the job has loaded a day at LOAD_TIME; M4 reads the
    load time that the sink stamped."""
    target = scratch_path(t.spark, "health")
    sales.run_daily_pipeline(t.spark, t, target, run_date=RUN_DATE, load_time=LOAD_TIME)
    return sink_tables.read_summary(t.spark, sink_tables.daily_path(target))


@register("monitor_daily_revenue")
def _m1(t: ShopTables) -> DataFrame:
    return monitor.daily_revenue(t.orders, AS_OF)


@register("monitor_trailing_avg")
def _m2(t: ShopTables) -> DataFrame:
    return _trailing_of(t)


@register("monitor_revenue_alerts")
def _m3(t: ShopTables) -> DataFrame:
    return monitor.revenue_alerts(_trailing_of(t))


@register("alerts_merged")
def _m5_merge(t: ShopTables) -> DataFrame:
    """M5: the history of alerts is merged day by day; then every second day is checked again without an
    alert, which resets it."""
    path = scratch_path(t.spark, "alerts")
    checks = monitor.revenue_alerts(_trailing_of(t))
    days = checks.select(F.col("metric_date").alias("check_date"))
    found = checks.filter(F.col("alert_title").isNotNull()).select(
        F.col("metric_date").alias("check_date"), "alert_title", "message", F.col("status").alias("severity"),
        F.lit(AS_OF).cast("timestamp_ntz").alias("alert_time"))
    sink_tables.merge_alerts(t.spark, monitor.alert_payloads(found), days, path, "history")
    again = days.filter(F.day("check_date") % 2 == 0)
    sink_tables.merge_alerts(t.spark, t.spark.createDataFrame([], sink_tables.ALERT_ROWS), again, path, "again")
    return sink_tables.read_alerts(t.spark, path).select("check_date", "alert_title", "message", "severity")


@register("monitor_revenue_check")
def _m3_day(t: ShopTables) -> DataFrame:
    """M3 for the checked day alone, as one scheduled run does it."""
    return monitor.revenue_check(monitor.revenue_alerts(_trailing_of(t)), AS_OF)


@register("monitor_pipeline_health")
def _m4(t: ShopTables) -> DataFrame:
    return monitor.pipeline_health(_loaded_summary(t), AS_OF)


@register("alert_payloads")
def _m5(t: ShopTables) -> DataFrame:
    daily = monitor.daily_revenue(t.orders, AS_OF)
    history = monitor.revenue_alerts(monitor.trailing_average(daily))
    alerts = monitor.collect_alerts(
        monitor.revenue_check(history, AS_OF),
        monitor.pipeline_health(_loaded_summary(t), AS_OF), AS_OF, daily=daily)
    return monitor.alert_payloads(alerts)


# --- E1-E7, S2, K4, K6 ------------------------------------------------------------

def _raw_stream(t: ShopTables) -> DataFrame:
    return event_adapters.raw_stream_rows(t.spark, t.raw("events"), t.orders, t.raw("lineitem"))


@register("event_envelopes")
def _e123(t: ShopTables) -> DataFrame:
    """Every field of every message, read back from its JSON."""
    env = event_adapters.envelopes(t.raw("events"), t.orders, t.raw("lineitem"))
    read = events.decode(env)
    texts = ["event_id", "event_type", "user_id", "page", "session_id", "user_agent", "ip_address",
             "product_id", "category_id", "order_id", "items", "payment_method", "metadata"]
    return read.select("topic", "key", *[F.col("m").getItem(c).alias(c) for c in texts],
                       F.col("m").getItem("timestamp").alias("timestamp_text"),
                       *[F.col("m").getItem(c).cast("double").alias(c)
                         for c in ("quantity", "price", "total_amount")],
                       F.size("m").alias("field_count"))


@register("event_ids_by_content")
def _p21(t: ShopTables) -> DataFrame:
    """Every sign-up and error event sent twice without its id: ids from the content."""
    rows = event_adapters.user_event_rows(t.raw("events")).drop("event_id", "metadata")
    read = events.decode(events.user_event_envelopes(rows.unionByName(rows)))
    return read.select("key", *[F.col("m").getItem(c).alias(c) for c in ("event_id", "event_type")])


@register("events_decode", doubles=("field_count",))
def _s2(t: ShopTables) -> DataFrame:
    decoded = events.decode(_raw_stream(t))
    return decoded.select("topic", "key", F.col("m").isNotNull().alias("is_json"),
                          F.when(F.col("m").isNotNull(), F.size("m")).alias("field_count"))


@register("user_events_normalized")
def _e4(t: ShopTables) -> DataFrame:
    return events.normalise(_raw_stream(t), events.USER_TOPIC)


@register("product_events_normalized")
def _e5(t: ShopTables) -> DataFrame:
    return events.normalise(_raw_stream(t), events.PRODUCT_TOPIC)


@register("order_events_normalized")
def _e6(t: ShopTables) -> DataFrame:
    return events.normalise(_raw_stream(t), events.ORDER_TOPIC)


@register("events_dead_letter")
def _k6(t: ShopTables) -> DataFrame:
    dl = events.dead_letter(_raw_stream(t))
    return dl.select("topic", "key", "reason", "timestamp",
                     F.when(F.col("reason") != "malformed_json",
                            F.get_json_object("value", "$.event_id")).alias("event_id"))


@register("events_routed_counts")
def _e7(t: ShopTables) -> DataFrame:
    return events.routed_counts(_raw_stream(t))


@register("event_layout")
def _k4(t: ShopTables) -> DataFrame:
    return events.event_layout(events.normalise(_raw_stream(t), events.USER_TOPIC),
                               events.USER_TOPIC)


@register("event_layout_products")
def _k4_products(t: ShopTables) -> DataFrame:
    return events.event_layout(events.normalise(_raw_stream(t), events.PRODUCT_TOPIC),
                               events.PRODUCT_TOPIC)


@register("event_layout_orders")
def _k4_orders(t: ShopTables) -> DataFrame:
    return events.event_layout(events.normalise(_raw_stream(t), events.ORDER_TOPIC),
                               events.ORDER_TOPIC)


# --- R4, R5 -------------------------------------------------------------------------

ERASE_SIGNUPS_BEFORE = "2023-07-01 00:00:00"


@register("cascade_delete")
def _r4(t: ShopTables) -> DataFrame:
    """Erase cancelled orders, discontinued products (stock -1), accounts that signed
    up before July 2023, every 97th cart and two categories, with their cascades; report
    per table."""
    before = t.all_tables()
    requested = {
        "categories": t.categories.filter(F.col("id").isin(4, 6)).select("id"),
        "products": t.products.filter(F.col("stock_quantity") == -1).select("id"),
        "carts": t.carts.filter(F.col("id") % 97 == 0).select("id"),
        "users": t.users.filter(F.col("created_at") < F.lit(ERASE_SIGNUPS_BEFORE)
                                .cast("timestamp_ntz")).select("id"),
        "orders": t.orders.filter(F.col("status") == "cancelled").select("id"),
    }
    after, blocked = upkeep.cascade_delete(before, requested)
    return upkeep.delete_summary(before, after, blocked)


@register("defaults_filled")
def _r5(t: ShopTables) -> DataFrame:
    filled = upkeep.with_defaults(t.orders, "orders")
    return filled.select("id", "status", "tax_amount", "shipping_amount", "discount_amount",
                         "payment_status")


@register("defaults_all_tables")
def _r5_all(t: ShopTables) -> DataFrame:
    """Every declared default of all nine tables: rows per filled value (a clock default
    counts as 'now')."""
    parts = []
    for name, df in t.all_tables().items():
        filled = upkeep.with_defaults(df, name)
        for column, literal, _type in schemas.DEFAULTS[name]:
            if column not in df.columns:
                value = (F.when(F.col(column).isNotNull(), F.lit("now")) if "localtimestamp" in literal
                         else F.col(column).cast("string"))
                parts.append(filled.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("rows"))
                             .select(F.lit(name).alias("table_name"),
                                     F.lit(column).alias("column_name"), "value", "rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@register("events_ingest_stream")
def _e7_stream(t: ShopTables) -> DataFrame:
    """E7 end to end: the raw stream lands as files under the shared checkpoint folder, one
    folder per topic, the Structured Streaming ingest queries of each topic run with
    ``availableNow``, and the rows the sinks stored are read back."""
    base = scratch_path(t.spark, "ingest")
    _raw_stream(t).write.partitionBy("topic").parquet(f"{base}/landing")

    def read_topic(topic: str) -> DataFrame:
        return ingest.read_file_stream(t.spark, f"{base}/landing/topic={topic}").withColumn(
            "topic", F.lit(topic))

    for query in ingest.start_topic_ingest(read_topic, f"{base}/out", f"{base}/ckpt",
                                           available_now=True).values():
        query.awaitTermination()
    stored = None
    for topic in events.TOPIC_NAMES:
        entity = schemas.TOPICS[topic][0]
        good = ingest.read_landed(t.spark, f"{base}/out", topic).select(
            F.lit(topic).alias("destination"), "event_id", "event_type",
            F.col(entity).alias("entity"), "timestamp", "metadata", F.lit(None).cast("string").alias("reason"))
        bad = ingest.read_landed(t.spark, f"{base}/out", f"{ingest.DEAD_LETTER}_{topic}").select(
            F.lit(ingest.DEAD_LETTER).alias("destination"),
            *[F.lit(None).cast("string").alias(c) for c in ("event_id", "event_type")],
            F.col("key").alias("entity"), "timestamp", F.lit(None).cast("string").alias("metadata"), "reason")
        part = good.unionByName(bad)
        stored = part if stored is None else stored.unionByName(part)
    return stored
