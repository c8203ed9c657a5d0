"""Event stream: envelope round trip, and the Structured Streaming ingest with
file source and file sinks (availableNow, stop, add files, restart)."""

import datetime as dt

from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.functions.exprs import iso_text, trunc_second
from basketlens.sources import event_adapters
from basketlens.sources.adapters import ShopTables
from basketlens.streaming import events, ingest

SF = "/root/testdata/sf0.001"


def test_round_trip_returns_input_rows_to_the_second(spark):
    ev = spark.read.schema(schemas.EVENTS).parquet(f"{SF}/events.parquet")
    users = event_adapters.user_event_rows(ev)
    raw = events.user_event_envelopes(users).withColumn(
        "timestamp", F.lit(None).cast("timestamp_ntz"))
    back = events.normalise(raw, events.USER_TOPIC)
    want = users.select(F.col("event_id").cast("string").alias("event_id"),
                        trunc_second(F.col("timestamp")).alias("timestamp"),
                        F.col("user_id").cast("string").alias("user_id"), "event_type", "page")
    got = back.select("event_id", "timestamp", "user_id", "event_type", "page")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    meta = back.select("metadata").distinct().limit(3).collect()
    assert all(r.metadata.startswith('{"k":') for r in meta)


def test_missing_and_null_fields_follow_the_producer_defaults(spark):
    rows = [
        ("product_events", "1", '{"event_id": "a", "timestamp": "2024-01-01T00:00:00.5", '
         '"product_id": "1", "event_type": "view"}'),
        ("product_events", "1", '{"event_id": "b", "timestamp": "2024-01-01T00:00:00", '
         '"product_id": "1", "event_type": "view", "quantity": null}'),
        ("product_events", "1", '{"event_id": "c", "timestamp": "2024-01-01T00:00:00", '
         '"product_id": "1", "event_type": "view", "quantity": 3, "metadata": null}'),
        ("order_events", "9", '{"event_id": "d", "timestamp": "2024-01-01T00:00:00", '
         '"order_id": "9", "event_type": "paid", "items": [{"p": 1}]}'),
    ]
    raw = spark.createDataFrame(rows, "topic string, key string, value string").withColumn(
        "timestamp", F.lit(None).cast("timestamp_ntz"))
    prod = {r.event_id: r for r in events.normalise(raw, events.PRODUCT_TOPIC).collect()}
    assert prod["a"].quantity == 1 and prod["a"].metadata == "{}"
    assert prod["a"].timestamp == dt.datetime(2024, 1, 1)
    assert "b" not in prod
    assert prod["c"].quantity == 3 and prod["c"].metadata == "null"
    order = events.normalise(raw, events.ORDER_TOPIC).first()
    assert order.items == '[{"p":1}]' and order.metadata == "{}"
    dead = {r.value: r.reason for r in events.dead_letter(raw).collect()}
    assert list(dead.values()) == ["null_field:quantity"]


def _write_batch(spark, df, path):
    df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.RAW_EVENT.fields]) \
      .write.mode("append").parquet(path)


def test_ingest_stores_each_event_once_across_restart(spark, scratch):
    t = ShopTables(spark, SF)
    raw = event_adapters.raw_stream_rows(spark, t.raw("events"), t.orders, t.raw("lineitem"))
    raw = raw.cache()
    first = raw.filter(F.col("topic") != "order_events")
    second = raw.filter(F.col("topic") == "order_events")
    landing, out, ckpt = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt"

    _write_batch(spark, first, landing)
    stream = ingest.read_file_stream(spark, landing)
    for q in ingest.start_ingest(stream, out, ckpt, available_now=True).values():
        q.awaitTermination()
    assert ingest.read_landed(spark, out, "order_events").count() == 0

    _write_batch(spark, second, landing)          # new files, then a restart
    stream = ingest.read_file_stream(spark, landing)
    for q in ingest.start_ingest(stream, out, ckpt, available_now=True).values():
        q.awaitTermination()
    for q in ingest.start_ingest(stream, out, ckpt, available_now=True).values():
        q.awaitTermination()                     # a third run finds nothing new

    for topic in events.TOPIC_NAMES:
        stored = ingest.read_landed(spark, out, topic)
        expected = events.normalise(raw, topic)
        assert stored.count() == expected.count()
        assert stored.select("event_id").distinct().count() == stored.count()
    dead = ingest.read_landed(spark, out, ingest.DEAD_LETTER)
    reasons = {r.reason for r in dead.select("reason").distinct().collect()}
    assert {"malformed_json", "missing_field:event_id", "null_field:user_id", "bad_quantity",
            "bad_timestamp", "null_field:quantity"} <= reasons
    assert dead.count() == events.dead_letter(raw).count()
    raw.unpersist()


def test_compaction_sorts_and_partitions_by_day(spark, scratch):
    rows = [("user_events", "1", '{"event_id": "%d", "timestamp": "2024-01-0%dT0%d:00:00", '
             '"user_id": "%d", "event_type": "signup", "page": "/"}' % (i, 1 + i % 2, i, 9 - i))
            for i in range(6)]
    raw = spark.createDataFrame(rows, "topic string, key string, value string").withColumn(
        "timestamp", F.lit(None).cast("timestamp_ntz"))
    landed = f"{scratch}/landed"
    events.normalise(raw, events.USER_TOPIC).write.parquet(f"{landed}/user_events")
    ingest.compact_events(spark, landed, f"{scratch}/tables", events.USER_TOPIC)
    table = spark.read.parquet(f"{scratch}/tables/user_events")
    assert table.count() == 6
    assert {r.event_date for r in table.select("event_date").distinct().collect()} == {
        dt.date(2024, 1, 1), dt.date(2024, 1, 2)}
    ingest.compact_events(spark, landed, f"{scratch}/tables", events.USER_TOPIC,
                          day=dt.date(2024, 1, 1))
    assert spark.read.parquet(f"{scratch}/tables/user_events").count() == 6   # idempotent


def test_per_topic_ingest_matches_single_source_ingest(spark, scratch):
    t = ShopTables(spark, SF)
    raw = event_adapters.raw_stream_rows(spark, t.raw("events"), t.orders, t.raw("lineitem"))
    landing, out, ckpt = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt"
    _write_batch(spark, raw, landing)

    def read_topic(topic):
        return ingest.read_file_stream(spark, landing).filter(F.col("topic") == topic)

    for q in ingest.start_topic_ingest(read_topic, out, ckpt, available_now=True).values():
        q.awaitTermination()
    for topic in events.TOPIC_NAMES:
        assert (ingest.read_landed(spark, out, topic).count()
                == events.normalise(raw, topic).count())
    dead = sum(ingest.read_landed(spark, out, f"{ingest.DEAD_LETTER}_{topic}").count()
               for topic in events.TOPIC_NAMES)
    assert dead == events.dead_letter(raw).count()


def test_iso_text_and_truncation_ignore_the_session_zone(spark):
    """A local time inside a daylight-saving gap must not move."""
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        df = spark.createDataFrame([("2020-03-08 02:30:00",), ("2024-01-01 00:00:07.5",)],
                                   "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
        got = [(r.i, r.s) for r in df.select(iso_text(F.col("t")).alias("i"),
                                               trunc_second(F.col("t")).alias("s")).collect()]
        assert got == [("2020-03-08T02:30:00", dt.datetime(2020, 3, 8, 2, 30)),
                       ("2024-01-01T00:00:07.500000", dt.datetime(2024, 1, 1, 0, 0, 7))]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_compacted_files_are_sorted_by_time_then_entity(spark, scratch):
    import glob

    import pyarrow.parquet as pq

    t = ShopTables(spark, SF)
    raw = event_adapters.raw_stream_rows(spark, t.raw("events"), t.orders, t.raw("lineitem"))
    landed = f"{scratch}/landed"
    events.normalise(raw, events.USER_TOPIC).write.parquet(f"{landed}/user_events")
    ingest.compact_events(spark, landed, f"{scratch}/tables", events.USER_TOPIC)
    files = glob.glob(f"{scratch}/tables/user_events/event_date=*/*.parquet")
    assert files
    for path in files:
        rows = pq.read_table(path, columns=["timestamp", "user_id"]).to_pylist()
        keys = [(r["timestamp"], r["user_id"]) for r in rows]
        assert keys == sorted(keys)
