"""Hand-made cases, one per trap, with expected rows worked out by hand."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.operators import metrics, monitor, quality, sales, upkeep
from basketlens.plans import cards

T = dt.datetime
D = Decimal


def users_df(spark, rows):
    return spark.createDataFrame(rows, schemas.USERS)


def orders_df(spark, rows):
    full = [(i, u, s, D(a), D(a), D("0.00"), D("0.00"), ts) for i, u, s, a, ts in rows]
    return spark.createDataFrame(full, schemas.ORDERS_OP)


def test_lifespan_counts_whole_24_hour_periods(spark):
    users = users_df(spark, [(1, "a", "A", "A", T(2023, 6, 1)), (2, "b", "B", "B", T(2023, 6, 1)),
                             (3, "c", "C", "C", T(2023, 6, 1))])
    orders = orders_df(spark, [
        # user 1: 01-01 02:00 -> 01-03 01:00 = 1 day 23 h -> 1 (datediff would say 2)
        (10, 1, "completed", "100.00", T(2024, 1, 1, 2)),
        (11, 1, "completed", "50.00", T(2024, 1, 3, 1)),
        # user 2: one order -> 0 days, annual value = total spent
        (12, 2, "completed", "70.00", T(2024, 1, 5)),
        # user 3: 25 hours -> 1 day; one pending order is ignored
        (13, 3, "completed", "10.00", T(2024, 1, 1, 0)),
        (14, 3, "completed", "20.00", T(2024, 1, 2, 1)),
        (15, 3, "pending", "999.00", T(2024, 1, 9)),
    ])
    got = {r.customer_id: r for r in metrics.customer_lifetime_value(users, orders).collect()}
    assert got[1].customer_lifespan_days == 1
    assert got[1].estimated_annual_value == 150.0 * 365.0
    assert got[1].customer_segment == "Regular customer"
    assert got[2].customer_lifespan_days == 0
    assert got[2].estimated_annual_value == 70.0
    assert got[2].customer_segment == "One-time buyer"
    assert got[3].total_orders == 2 and got[3].total_spent == D("30.00")
    assert got[3].avg_order_value == 15.0


def _product_inputs(spark):
    products = spark.createDataFrame([
        (1, "sold", "S1", D("10.00"), 5, 1, None),
        (2, "unsold", "S2", D("10.00"), None, 1, None),
        (3, "pending only", "S3", D("10.00"), 0, 1, None),
        (4, "null status", "S4", D("10.00"), -1, None, None),
    ], schemas.PRODUCTS)
    categories = spark.createDataFrame([(1, "ECONOMY")], schemas.CATEGORIES)
    orders = orders_df(spark, [(100, 1, "completed", "1.00", T(2024, 1, 1)),
                               (101, 1, "pending", "1.00", T(2024, 1, 1)),
                               (102, 1, None, "1.00", T(2024, 1, 1))])
    items = spark.createDataFrame([
        (100, 1, 2, D("3.00")), (101, 1, 1, D("5.00")),   # product 1: completed + pending
        (101, 3, 4, D("2.00")),                           # product 3: pending only -> vanishes
        (102, 4, 1, D("7.00")),                           # product 4: NULL status -> kept
        (None, 4, 1, D("1.00")),                          # NULL order id -> kept (no order)
    ], schemas.ORDER_ITEMS)
    return products, categories, items, orders


def test_product_performance_join_then_filter(spark):
    pp = {r.product_id: r for r in metrics.product_performance(*_product_inputs(spark)).collect()}
    assert set(pp) == {1, 2, 4}
    assert pp[1].total_orders == 1 and pp[1].total_revenue == D("6.00")
    assert pp[2].total_orders == 0 and pp[2].total_revenue is None
    assert pp[2].stock_status == "In Stock"          # NULL stock
    assert pp[4].stock_status == "Low Stock"         # negative stock
    assert pp[4].category_name is None
    assert pp[4].total_orders == 1 and pp[4].total_quantity_sold == 2
    assert pp[4].avg_selling_price == 4.0


def test_top_products_put_unsold_first_and_categories_null_first(spark):
    pp = metrics.product_performance(*_product_inputs(spark))
    top = [r.product_id for r in cards.card_top_products(pp, 2).collect()]
    assert top == [2, 4]                             # NULL revenue leads on DESC
    cat = [r.category_name for r in cards.card_category_performance(
        spark.createDataFrame([("A", D("1.00")), ("B", None), ("C", D("5.00"))],
                              "category_name string, total_revenue decimal(20,2)")).collect()]
    assert cat == ["B", "C", "A"]


def test_funnel_absent_metric_is_null_and_rate_null(spark):
    sessions = spark.createDataFrame([(T(2024, 1, 1, 9),), (T(2024, 1, 1, 10),)],
                                     "created_at timestamp_ntz")
    carts = spark.createDataFrame([(5, 5)], "id bigint, user_id bigint")
    cart_items = spark.createDataFrame(
        [(1, 5, T(2024, 1, 1, 9)), (2, 5, T(2024, 1, 2, 9)), (3, None, T(2024, 1, 2, 9))],
        "id bigint, cart_id bigint, created_at timestamp_ntz")
    orders = orders_df(spark, [(1, 7, "completed", "1.00", T(2024, 1, 1)),
                               (2, 7, "shipped", "1.00", T(2024, 1, 1)),
                               (3, 8, "completed", "1.00", T(2024, 1, 1)),
                               (4, 9, None, "1.00", T(2024, 1, 1))])
    rows = {r.metric_date: r for r in
            metrics.sales_funnel(sessions, cart_items, carts, orders).collect()}
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    assert rows[d1].page_views == 2 and rows[d1].cart_additions == 1
    assert rows[d1].checkouts_started == 2         # users 7, 8; NULL status excluded
    assert rows[d1].orders_completed == 2
    assert rows[d1].cart_conversion_rate == 50.0
    assert rows[d1].checkout_conversion_rate == 100.0
    assert rows[d2].page_views is None              # carts but no sessions
    assert rows[d2].cart_additions == 1             # the NULL cart drops
    assert rows[d2].cart_conversion_rate is None


def test_rate_rounds_half_up_exactly(spark):
    from basketlens.functions.exprs import pct_round2

    df = spark.createDataFrame([(1, 8), (2, 3), (1, 0), (None, 4)], "a bigint, b bigint")
    got = [r.r for r in df.select(pct_round2(F.col("a"), F.col("b")).alias("r")).collect()]
    assert got == [12.5, 66.67, None, None]


def test_daily_summary_keeps_order_fan_out(spark):
    extract = spark.createDataFrame([
        (dt.date(2024, 1, 1), 1, 7, D("100.00"), 2, "A", 3),
        (dt.date(2024, 1, 1), 1, 7, D("100.00"), 1, "A", 3),
        (dt.date(2024, 1, 1), 1, 7, D("100.00"), 5, "B", 3),
        (dt.date(2024, 1, 1), 2, 8, D("10.00"), 1, "A", 4),
    ], "order_date date, order_id bigint, user_id bigint, total_amount decimal(10,2), "
       "quantity int, category_name string, order_hour int")
    daily = {r.category_name: r for r in sales.daily_sales_summary(extract).collect()}
    assert daily["A"].total_orders == 2 and daily["A"].unique_customers == 2
    assert daily["A"].total_revenue == D("210.00")   # order 1 counted per item row
    assert daily["A"].total_items_sold == 4
    assert daily["B"].total_revenue == D("100.00")
    hourly = {r.order_hour: r for r in sales.hourly_sales_summary(extract).collect()}
    assert hourly[3].hourly_orders == 1 and hourly[3].hourly_revenue == D("300.00")


def test_freshness_and_null_rates_on_empty_table(spark):
    empty = spark.createDataFrame([], "created_at timestamp_ntz, x string")
    fresh = quality.check_data_freshness(empty, "created_at", 24, T(2024, 1, 31)).first()
    assert fresh.latest_record is None and fresh.age_hours is None
    assert fresh.is_fresh is False and fresh.total_records == 0
    rates = quality.check_null_rates(empty, ["x"]).first()
    assert rates.total_records == 0 and rates.x_null_rate is None


def test_freshness_boundaries(spark):
    df = spark.createDataFrame([(T(2024, 1, 30, 0),), (T(2024, 1, 29, 12),)],
                               "created_at timestamp_ntz")
    r = quality.check_data_freshness(df, "created_at", 24, T(2024, 1, 31)).first()
    assert r.age_hours == 24.0 and r.is_fresh is True     # <= is fresh
    assert r.recent_records == 0                          # strict > as_of - 24 h


def test_orphans_ignore_null_keys(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,), (9,)], "k bigint")
    parent = spark.createDataFrame([(1,), (2,)], "id bigint")
    r = quality.check_referential_integrity(child, "k", parent, "id").first()
    assert r.orphaned_records == 1 and r.has_orphans is True


def test_revenue_alert_boundaries_do_not_fire(spark):
    days = [dt.date(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]
    daily = spark.createDataFrame(
        [(days[0], D("100.00")), (days[1], D("50.00")), (days[2], D("150.00")),
         (days[3], D("0.00")), (days[4], D("400.00"))],
        "metric_date date, daily_revenue decimal(20,2)")
    got = {r.metric_date: r for r in
           monitor.revenue_alerts(monitor.trailing_average(daily)).collect()}
    assert got[days[0]].status == "insufficient_history"
    assert got[days[1]].status == "ok"                     # exactly 0.5 x 100
    assert got[days[2]].status == "ok"                     # exactly 2 x 75
    assert got[days[3]].status == "critical"               # 0 < 0.5 x 100
    assert got[days[3]].alert_title == "Revenue Anomaly"
    assert got[days[4]].status == "warning"                # 400 > 2 x 75
    assert got[days[4]].message == ("Daily revenue (400.00) is significantly above "
                                    "average (75.00)")


def test_pipeline_health_threshold_is_26_hours(spark):
    runs = spark.createDataFrame([(T(2024, 1, 29, 22),)], "created_at timestamp_ntz")
    ok = monitor.pipeline_health(runs, T(2024, 1, 31, 0)).first()
    assert ok.status == "ok" and ok.hours_since == 26.0
    late = monitor.pipeline_health(runs, T(2024, 1, 31, 0, 0, 1)).first()
    assert late.status == "critical" and late.alert_title == "Pipeline Failure"
    none = monitor.pipeline_health(runs.limit(0), T(2024, 1, 31)).first()
    assert none.status == "critical" and none.last_run is None


def test_missing_input_raises_check_failed_alert(spark):
    empty = spark.createDataFrame([], "metric_date date, daily_revenue decimal(20,2)")
    alerts = monitor.missing_input_alerts(empty, monitor.TITLE_CHECK_FAILED, "Error: none",
                                          T(2024, 1, 31))
    payload = monitor.alert_payloads(alerts).first()
    assert payload.alert_title == "Data Quality Check Failed"
    assert '"color":"warning"' in payload.payload
    assert '"value":"WARNING"' in payload.payload
    assert '"value":"2024-01-31T00:00:00"' in payload.payload


def test_cascade_delete_blocks_referenced_users(spark):
    users = users_df(spark, [(1, "a", "A", "A", None), (2, "b", "B", "B", None)])
    orders = orders_df(spark, [(10, 1, "completed", "1.00", None)])
    carts = spark.createDataFrame([(5, 1), (6, 2)], "id bigint, user_id bigint")
    cart_items = spark.createDataFrame([(1, 5, None), (2, 6, None), (3, 6, None)],
                                       "id bigint, cart_id bigint, created_at timestamp_ntz")
    tables = {"users": users, "orders": orders, "carts": carts, "cart_items": cart_items}
    after, blocked = upkeep.cascade_delete(
        tables, {"users": spark.createDataFrame([(1,), (2,)], "id bigint")})
    assert [r.id for r in after["users"].collect()] == [1]       # 1 has an order
    assert [r.id for r in after["carts"].collect()] == [5]
    assert sorted(r.id for r in after["cart_items"].collect()) == [1]
    assert [(r.table_name, r.id) for r in blocked.collect()] == [("users", 1)]


def test_defaults_fill_only_absent_columns(spark):
    df = spark.createDataFrame([(1, None)], "id bigint, status string")
    out = upkeep.with_defaults(df, "orders").first()
    assert out.status is None                       # explicit NULL stays
    assert out.payment_status == "pending" and out.discount_amount == D("0.00")


def test_monitoring_error_when_run_log_is_missing(spark):
    rows = monitor.pipeline_health_or_error(spark, None, T(2024, 1, 31)).collect()
    assert [(r.alert_title, r.severity) for r in rows] == [("Monitoring Error", "warning")]
    runs = spark.createDataFrame([(T(2024, 1, 1),)], "created_at timestamp_ntz")
    late = monitor.pipeline_health_or_error(spark, runs, T(2024, 1, 31)).collect()
    assert [r.alert_title for r in late] == ["Pipeline Failure"]


def test_envelope_gets_a_uuid_when_input_has_no_id(spark):
    from basketlens.streaming import events

    df = spark.createDataFrame([(T(2024, 1, 1), "7", "signup", "/")],
                               "timestamp timestamp_ntz, user_id string, event_type string, "
                               "page string")
    env = events.user_event_envelopes(df)
    back = events.normalise(env.withColumn("timestamp", F.lit(None).cast("timestamp_ntz")),
                            events.USER_TOPIC).first()
    assert len(back.event_id) == 36 and back.user_id == "7" and back.metadata == "{}"


def test_funnel_order_metrics_absent_not_zero(spark):
    orders = orders_df(spark, [(1, 7, "pending", "1.00", T(2024, 1, 3)),
                               (2, 8, "cancelled", "1.00", T(2024, 1, 4)),
                               (3, 9, None, "1.00", T(2024, 1, 5))])
    rows = {(r.metric_date, r.metric_type): r.metric_value
            for r in metrics.funnel_order_metrics(orders).collect()}
    assert rows == {(dt.date(2024, 1, 4), "checkouts_started"): 1}


def test_alerts_table_appends_rows_by_day(spark, scratch):
    from basketlens.sinks import tables as sinks

    empty = spark.createDataFrame([], "metric_date date, daily_revenue decimal(20,2)")
    for day in (30, 31):
        sinks.append_alerts(monitor.alert_payloads(monitor.missing_input_alerts(
            empty, monitor.TITLE_CHECK_FAILED, "Error: none", T(2024, 1, day, 2))), f"{scratch}/alerts")
    back = spark.read.parquet(f"{scratch}/alerts")
    assert sorted(r.check_date for r in back.collect()) == [dt.date(2024, 1, 30), dt.date(2024, 1, 31)]
    assert back.first().payload.startswith('{"text":"')


def test_rate_rounding_matches_decimal_half_up(spark):
    """Property: pct_round2 equals ROUND(100 * a / b, 2) done in exact decimal
    arithmetic, half up, for any non-negative counts."""
    from decimal import ROUND_HALF_UP

    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from basketlens.functions.exprs import pct_round2

    pairs = st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)),
                     min_size=50, max_size=50)

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(pairs)
    def check(rows):
        df = spark.createDataFrame(rows, "a bigint, b bigint")
        got = [r.r for r in df.select(pct_round2(F.col("a"), F.col("b")).alias("r")).collect()]
        want = [float((D(100) * a / D(b)).quantize(D("0.01"), rounding=ROUND_HALF_UP))
                for a, b in rows]
        assert got == want

    check()


def test_whole_days_matches_timedelta_days(spark):
    """Property (P13): EXTRACT(DAYS FROM later - earlier) counts whole 24-hour
    periods, which is Python's ``timedelta.days`` for a non-negative gap."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    from basketlens.functions.exprs import whole_days

    stamps = st.datetimes(min_value=T(2000, 1, 1), max_value=T(2030, 1, 1))
    pairs = st.lists(st.tuples(stamps, stamps), min_size=40, max_size=40)

    @settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
    @given(pairs)
    def check(rows):
        rows = [(min(a, b), max(a, b)) for a, b in rows]
        df = spark.createDataFrame(rows, "e timestamp_ntz, l timestamp_ntz")
        got = [r.d for r in df.select(whole_days(F.col("l"), F.col("e")).alias("d")).collect()]
        assert got == [(later - earlier).days for earlier, later in rows]

    check()
