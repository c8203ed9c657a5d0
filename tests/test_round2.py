"""Cases that a review of the first version found wrong."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.operators import metrics, monitor, quality, upkeep
from basketlens.session import ensure_checkpoint_dir
from basketlens.sinks import tables as sinks
from basketlens.sources import event_adapters, tables as sources
from basketlens.streaming import events, ingest

T = dt.datetime


def rows(spark, schema, *values):
    return spark.createDataFrame(list(values), schema)


# --- one message per order -------------------------------------------------------------

def test_an_order_with_5000_lines_is_one_message(spark):
    lineitem = spark.range(5000).select(
        F.lit(1).cast("bigint").alias("l_orderkey"), F.col("id").alias("l_partkey"),
        (F.col("id") % 7).cast("int").alias("l_linenumber"), F.lit(1.0).alias("l_quantity"),
        F.lit(2.5).alias("l_extendedprice"))
    orders = rows(spark, "id bigint, user_id bigint, total_amount double, created_at timestamp_ntz",
                  (1, 7, 10.0, T(2024, 1, 1)))
    out = event_adapters.order_event_rows(orders, lineitem).collect()
    assert [r.event_id for r in out] == ["order-1"] and len(out[0].items) == 5000


# --- revenue monitoring -------------------------------------------------------------------

def _history(spark, as_of):
    orders = rows(spark, "status string, total_amount decimal(10,2), created_at timestamp_ntz",
                  *[("completed", D("100.00"), T(2024, 1, d, 12)) for d in range(1, 21)])
    return monitor.revenue_alerts(monitor.trailing_average(monitor.daily_revenue(orders, as_of)))


def test_a_day_without_sales_raises_a_critical_alert(spark):
    as_of = T(2024, 1, 31)
    history = _history(spark, as_of)
    assert history.agg(F.max("metric_date")).first()[0] == dt.date(2024, 1, 31)
    row = monitor.revenue_check(history, as_of).collect()
    assert [(r.metric_date, r.status, r.daily_revenue) for r in row] == [
        (dt.date(2024, 1, 31), "critical", D("0.00"))]


def test_sales_after_the_checked_day_are_not_seen(spark):
    assert _history(spark, T(2024, 1, 10)).count() == 10


def test_checking_a_day_again_adds_no_second_alert(spark, scratch):
    as_of = T(2024, 1, 31)
    runs = rows(spark, "created_at timestamp_ntz", (T(2024, 1, 30, 23),))
    alerts = monitor.alert_payloads(monitor.collect_alerts(
        monitor.revenue_check(_history(spark, as_of), as_of), monitor.pipeline_health(runs, as_of), as_of))
    for _ in range(2):
        sinks.append_alerts(alerts, f"{scratch}/alerts")
    stored = spark.read.parquet(f"{scratch}/alerts").collect()
    assert [r.check_date for r in stored] == [dt.date(2024, 1, 31)]


def test_health_reads_the_time_the_sink_stamped(spark, scratch):
    day = rows(spark, "order_date date, order_hour int, hourly_orders bigint, hourly_revenue decimal(20,2)",
               (dt.date(2024, 1, 30), 1, 2, D("3.00")))
    sinks.load_summary(day, sinks.hourly_path(scratch), load_time=T(2024, 1, 29, 20))
    health = monitor.pipeline_health(sinks.read_summary(spark, sinks.hourly_path(scratch)), T(2024, 1, 31))
    assert health.first().last_run == T(2024, 1, 29, 20) and health.first().status == "critical"


# --- cascade delete -----------------------------------------------------------------------

def _ids(df):
    return sorted(r.id for r in df.select("id").collect())


def _shop(spark):
    return {
        "users": rows(spark, "id bigint", (1,), (2,)),
        "carts": rows(spark, "id bigint, user_id bigint", (5, 1), (6, 2)),
        "cart_items": rows(spark, "id bigint, cart_id bigint, product_id bigint, variant_id bigint",
                           (100, 5, 10, None), (101, 6, 11, None)),
        "categories": rows(spark, "id bigint, parent_id bigint", (1, None), (2, 1), (3, None), (4, 3)),
        "products": rows(spark, "id bigint, category_id bigint", (10, 1), (11, None), (12, None)),
        "product_variants": rows(spark, "id bigint, product_id bigint", (20, 12), (21, 10)),
        "orders": rows(spark, "id bigint, user_id bigint", (50, None)),
        "order_items": rows(spark, "id bigint, order_id bigint, product_id bigint, variant_id bigint",
                            (500, 50, None, 20)),
    }


def _request(spark, **ids):
    return {t: rows(spark, "id bigint", *[(i,) for i in own]) for t, own in ids.items()}


def test_a_row_that_goes_too_blocks_nothing(spark):
    after, blocked = upkeep.cascade_delete(_shop(spark), _request(spark, products=[10], users=[1]))
    assert _ids(after["products"]) == [11, 12] and _ids(after["cart_items"]) == [101]
    assert _ids(after["product_variants"]) == [20] and blocked.count() == 0


def test_a_reference_to_a_cascaded_row_blocks_the_root(spark):
    after, blocked = upkeep.cascade_delete(_shop(spark), _request(spark, products=[12]))
    assert _ids(after["products"]) == [10, 11, 12] and _ids(after["product_variants"]) == [20, 21]
    assert [tuple(r) for r in blocked.collect()] == [("products", 12)]


def test_a_child_category_blocks_its_parent_unless_it_goes_too(spark):
    after, blocked = upkeep.cascade_delete(_shop(spark), _request(spark, categories=[3]))
    assert 3 in _ids(after["categories"]) and [tuple(r) for r in blocked.collect()] == [("categories", 3)]
    after, blocked = upkeep.cascade_delete(_shop(spark), _request(spark, categories=[3, 4]))
    assert _ids(after["categories"]) == [1, 2] and blocked.count() == 0


def test_what_is_blocked_can_block_others(spark):
    """Category 2 may go; 1 is held by product 10, which variant 21's order line holds."""
    shop = _shop(spark)
    shop["order_items"] = rows(spark, "id bigint, order_id bigint, product_id bigint, variant_id bigint",
                               (500, 50, None, 21))
    after, blocked = upkeep.cascade_delete(shop, _request(spark, categories=[1, 2], products=[10], users=[1]))
    assert _ids(after["categories"]) == [1, 3, 4] and 10 in _ids(after["products"])
    assert sorted(tuple(r) for r in blocked.collect()) == [("categories", 1), ("products", 10)]
    assert _ids(after["carts"]) == [6]


def test_any_table_may_be_requested_and_unknown_ones_are_refused(spark):
    after, _ = upkeep.cascade_delete(_shop(spark), _request(spark, carts=[5], order_items=[500]))
    assert _ids(after["carts"]) == [6] and _ids(after["cart_items"]) == [101]
    assert _ids(after["order_items"]) == []
    with pytest.raises(ValueError):
        upkeep.cascade_delete(_shop(spark), _request(spark, invoices=[1]))


# --- strict decode --------------------------------------------------------------------------

USER = '{"event_id": "a", "timestamp": "%s", "user_id": %s, "event_type": "signup", "page": %s}'


def _raw(spark, *values, topic="user_events"):
    return rows(spark, schemas.RAW_EVENT, *[(topic, "k", v, T(2024, 1, 1)) for v in values])


@pytest.mark.parametrize("value, reason", [
    (USER % ("2024-01-15T10:00:00", '"7"', '"/"') + " more", "malformed_json"),
    (USER % ("2024-01-15T10:00:00", '"7"', '"/"') + "}", "malformed_json"),
    (USER % ("2024-01-15T10:00:00", '"7"', '"/", "page": "/x"'), "malformed_json"),
    ("[1, 2]", "malformed_json"), ("", "malformed_json"), (None, "malformed_json"),
    (USER % ("2024-01-15T10:00:00", '"7"', '{"a": 1}'), "bad_type:page"),
    (USER % ("2024-01-15T10:00:00", "7", '"/"'), "bad_type:user_id"),
    (USER % ("2024-01-15T10:00:00", "null", '"/"'), "null_field:user_id"),
    (USER % ("soon", '"7"', '"/"'), "bad_timestamp"),
])
def test_bad_messages_are_set_aside_with_key_and_time(spark, value, reason):
    raw = _raw(spark, value)
    dead = events.dead_letter(raw).collect()
    assert [(r.key, r.value, r.timestamp, r.reason) for r in dead] == [("k", value, T(2024, 1, 1), reason)]
    assert events.normalise(raw, "user_events").count() == 0


def test_a_zoned_time_is_stored_in_utc(spark):
    raw = _raw(spark, USER % ("2024-01-15T10:00:00+05:00", '"7"', '"/"'),
               USER % ("2024-01-15T10:00:00Z", '"7"', '"/"'))
    got = sorted(r.timestamp for r in events.normalise(raw, "user_events").collect())
    assert got == [T(2024, 1, 15, 5), T(2024, 1, 15, 10)]


def test_quantity_as_text_is_no_number(spark):
    value = ('{"event_id": "a", "timestamp": "2024-01-15T10:00:00", "product_id": "1", '
             '"event_type": "view", "quantity": "3"}')
    assert events.dead_letter(_raw(spark, value, topic="product_events")).first().reason == "bad_quantity"


def test_bad_metadata_does_not_stop_the_producer(spark):
    df = rows(spark, "event_id string, timestamp timestamp_ntz, user_id string, event_type string, page string, "
                     "metadata string", ("a", T(2024, 1, 1), "7", "signup", "/", "{bad"),
              ("b", T(2024, 1, 1), "7", "signup", "/", '{"x":1}'))
    assert events.user_event_envelopes(df).count() == 2
    assert [r.event_id for r in events.bad_metadata(df).collect()] == ["a"]


# --- staging and readers ----------------------------------------------------------------------

def test_csv_staging_gives_back_what_was_written(spark, scratch):
    values = ["  pad ", "", None, 'a "quoted" b', "two\nlines", "cr\r\nlf", "comma, here", "NA", "\\", '"', "null",
              "é 漢"]
    df = rows(spark, "id int, v string", *list(enumerate(values)))
    sinks.write_csv_staging(df, f"{scratch}/csv")
    back = {r.id: r.v for r in sources.read_csv_staging(spark, f"{scratch}/csv", df.schema).collect()}
    assert back == dict(enumerate(values))


def test_jdbc_needs_a_partition_column_or_an_explicit_wish():
    with pytest.raises(ValueError):
        sources.jdbc_options("jdbc:x", "t")
    assert sources.jdbc_options("jdbc:x", "t", single_connection=True)["dbtable"] == "t"
    assert sources.jdbc_options("jdbc:x", "t", "id", 0, 9)["partitionColumn"] == "id"


def test_no_machine_local_folder_off_a_local_master(monkeypatch):
    class Conf:
        def get(self, *_a):
            return None

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())


# --- audits ---------------------------------------------------------------------------------

def test_absent_columns_are_rows_of_the_audits(spark):
    one = {"users": rows(spark, "id bigint, email string", (1, "a"), (1, None))}
    unique = {(r.table_name, r.key_columns): r for r in quality.audit_unique(one).collect()}
    assert len(unique) == 15 and unique["users", "id"].duplicate_rows == 2
    assert unique["orders", "id"].status == "column_absent"
    required = quality.audit_not_null(one)
    assert required.count() == 35 and required.filter("status = 'checked'").count() == 2
    keys = quality.audit_foreign_keys(one)
    assert keys.count() == 12 and keys.filter("orphaned_records IS NULL").count() == 12


# --- plans -----------------------------------------------------------------------------------

def test_layout_writes_files_by_bytes_and_compaction_reads_one_day(spark, scratch, capsys):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        raw = _raw(spark, *[USER % (f"2024-01-{d:02d}T10:00:00", f'"{i}"', '"/"') for d in (14, 15) for i in range(90)])
        path = f"{scratch}/landing"
        raw.write.parquet(path)
        for q in ingest.start_ingest(ingest.read_file_stream(spark, path), f"{scratch}/out", f"{scratch}/ckpt",
                                     available_now=True).values():
            q.awaitTermination()
        ingest.compact_events(spark, f"{scratch}/out", f"{scratch}/table", "user_events", dt.date(2024, 1, 15))
        table = spark.read.parquet(f"{scratch}/table/user_events")
        assert table.count() == 90 and len(table.inputFiles()) <= 2
        capsys.readouterr()
        ingest.landed_days(spark, f"{scratch}/out", "user_events").filter(
            F.col("event_date") == F.lit("2024-01-15").cast("date")).explain("formatted")
        assert "PartitionFilters: [isnotnull(event_date" in capsys.readouterr().out
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_null_order_ids_of_one_product_are_one_row_before_the_join(spark):
    items = spark.range(20_000).select(F.lit(None).cast("bigint").alias("order_id"),
                                       F.lit(1).cast("bigint").alias("product_id"),
                                       F.lit(2).alias("quantity"), F.lit(D("1.50")).alias("price"))
    orders = rows(spark, "id bigint, status string", (1, "completed"))
    pairs = metrics._pairs_with_status(items, orders).collect()
    assert len(pairs) == 1 and pairs[0]["_rows"] == 20_000 and pairs[0]["status"] is None


def test_the_extract_forces_no_broadcast(spark, capsys):
    from basketlens.plans import catalog

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from basketlens.operators import sales

        t = lambda ddl: spark.createDataFrame([], ddl)
        extract = sales.daily_sales_extract(
            t("id bigint, user_id bigint, status string, total_amount decimal(10,2), subtotal decimal(10,2), "
              "tax_amount decimal(10,2), shipping_amount decimal(10,2), created_at timestamp_ntz"),
            t("order_id bigint, product_id bigint, quantity int, price decimal(10,2)"),
            t("id bigint, name string, category_id bigint"), t("id bigint, name string"),
            t("id bigint, email string"))
        capsys.readouterr()
        extract.explain()
        assert "Broadcast" not in capsys.readouterr().out
        assert catalog.queries()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
