"""Loads that appear at once, changed-day backfills, the alert merge, and the single-parse ingest."""

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from basketlens import schemas
from basketlens.operators import sales
from basketlens.sinks import tables as sinks
from basketlens.sinks import versions
from basketlens.sources.adapters import ShopTables
from basketlens.sources.tables import read_csv_staging
from basketlens.streaming import events, ingest

SF = "/root/testdata/sf0.001"
T = dt.datetime
DAY = [dt.date(2024, 1, d) for d in range(1, 6)]
NAMES = ("daily_sales_summary", "hourly_sales_summary")


class Inputs:
    """Shop tables with some of them replaced."""
    def __init__(self, tables, **changed):
        for name in ("orders", "order_items", "products", "categories", "users"):
            setattr(self, name, changed.get(name, getattr(tables, name)))


def content(spark, target):
    return {n: sorted(map(tuple, sinks.read_loaded(spark, target, n).drop("created_at").collect()), key=str)
            for n in NAMES}


def plain(inputs, run_date=None):
    extract = sales.daily_sales_extract(inputs.orders, inputs.order_items, inputs.products,
                                        inputs.categories, inputs.users, run_date)
    made = {"daily_sales_summary": sales.daily_sales_summary(extract),
            "hourly_sales_summary": sales.hourly_sales_summary(extract)}
    return {n: sorted(map(tuple, sinks.stamped(df, n).drop("created_at").collect()), key=str)
            for n, df in made.items()}


@pytest.fixture(scope="module")
def tables(spark):
    """Two months of the shop, so that a load makes few folders."""
    every = ShopTables(spark, SF)
    span = F.to_date("created_at").between(F.lit("2023-12-15").cast("date"), F.lit("2024-02-15").cast("date"))
    return Inputs(every, orders=every.orders.filter(span).cache(), order_items=every.order_items.cache())


def test_a_run_stopped_between_the_tables_is_invisible(spark, tables, scratch, monkeypatch):
    target = f"{scratch}/t"
    sales.run_versioned_pipeline(spark, tables, target, "run-1")
    before = content(spark, target)
    assert before == plain(tables)
    fewer = Inputs(tables, orders=tables.orders.filter("id % 3 > 0"))
    write, written = versions.write_tables, []

    def half(frames, root, run_id, day):
        first = dict(list(frames.items())[:1])
        write(first, root, run_id, day)
        written.extend(first)
        raise RuntimeError("stopped")
    monkeypatch.setattr(versions, "write_tables", half)
    with pytest.raises(RuntimeError):
        sales.run_versioned_pipeline(spark, fewer, target, "run-2")
    assert written == ["daily_sales_summary"]
    assert content(spark, target) == before
    monkeypatch.setattr(versions, "write_tables", write)
    monkeypatch.setattr(versions, "commit", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("stopped")))
    with pytest.raises(RuntimeError):       # both tables written, no commit
        sales.run_versioned_pipeline(spark, fewer, target, "run-2")
    assert content(spark, target) == before
    monkeypatch.undo()
    assert sales.run_versioned_pipeline(spark, fewer, target, "run-2")["loaded"]
    assert content(spark, target) == plain(fewer)
    assert sales.run_versioned_pipeline(spark, fewer, target, "run-2") == {"loaded": False, "days": 0}
    assert content(spark, target) == plain(fewer)


def test_one_changed_order_reloads_one_day(spark, tables, scratch):
    target = f"{scratch}/t"
    first = sales.run_versioned_pipeline(spark, tables, target, "a")
    assert first["days"] > 10
    assert sales.run_versioned_pipeline(spark, tables, target, "b")["days"] == 0
    one = tables.order_items.join(tables.orders.select(F.col("id").alias("order_id"), "created_at", "status"),
                                  "order_id").filter("status = 'completed'").first()
    changed = Inputs(tables, order_items=tables.order_items.withColumn("quantity", F.when(
        F.col("id") == one["id"], F.col("quantity") + 1).otherwise(F.col("quantity")).cast("int")))
    assert sales.run_versioned_pipeline(spark, changed, target, "c")["days"] == 1
    assert content(spark, target) == plain(changed)
    full = f"{scratch}/full"
    sales.run_versioned_pipeline(spark, changed, full, "x", only_changed=False)
    assert content(spark, full) == content(spark, target)
    # A day whose orders all go is emptied, once.
    gone = Inputs(tables, orders=changed.orders.filter(F.to_date("created_at") != one["created_at"].date()),
                  order_items=changed.order_items)
    assert sales.run_versioned_pipeline(spark, gone, target, "d")["days"] == 1
    assert content(spark, target) == plain(gone)
    assert sales.run_versioned_pipeline(spark, gone, target, "e")["days"] == 0


def test_single_day_runs_touch_their_day_only(spark, tables, scratch):
    target = f"{scratch}/t"
    day = dt.date(2024, 1, 30)
    assert sales.run_versioned_pipeline(spark, tables, target, "a", run_date=day)["days"] <= 1
    assert content(spark, target) == plain(tables, day)
    sales.run_versioned_pipeline(spark, tables, target, "b")
    assert content(spark, target) == plain(tables)
    assert sales.run_versioned_pipeline(spark, tables, target, "c", run_date=day)["days"] == 0
    empty = Inputs(tables, orders=tables.orders.limit(0))
    sales.run_versioned_pipeline(spark, empty, target, "d", run_date=day)
    assert all(r[0] != day for rows in content(spark, target).values() for r in rows)


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), "d date, v int")


def test_runs_replace_or_add_by_day(spark, scratch):
    root, schema = f"{scratch}/r", spark.createDataFrame([], "d date, v int").schema
    read = lambda: sorted(((r.d, r.v) for r in versions.read_current(spark, root, "t", schema, "d").collect()),
                          key=str)
    assert read() == []
    versions.load_run(spark, root, "r1", {"t": rows_of(spark, (DAY[0], 1), (DAY[1], 2), (None, 3))}, "d")
    versions.load_run(spark, root, "r2", {"t": rows_of(spark, (DAY[0], 1))}, "d", replaces=False)
    assert read() == sorted([(DAY[0], 1), (DAY[0], 1), (DAY[1], 2), (None, 3)], key=str)
    versions.load_run(spark, root, "r3", {"t": rows_of(spark, (DAY[0], 9), (None, 4))}, "d")
    assert read() == sorted([(DAY[0], 9), (DAY[1], 2), (None, 4)], key=str)
    empty = spark.createDataFrame([(DAY[1],)], "day date")
    versions.load_run(spark, root, "r4", {"t": spark.createDataFrame([], schema)}, "d", empty)
    assert read() == sorted([(DAY[0], 9), (None, 4)], key=str)
    assert not versions.load_run(spark, root, "r4", {"t": rows_of(spark, (DAY[1], 5))}, "d")
    with pytest.raises(ValueError):
        versions.load_run(spark, root, "a/b", {}, "d")


def test_fingerprints_see_repeats_and_ignore_order(spark):
    marks = lambda *rows: [tuple(r)[1:] for r in versions.day_fingerprints(rows_of(spark, *rows), "d").collect()]
    assert marks((DAY[0], 1), (DAY[0], 2)) == marks((DAY[0], 2), (DAY[0], 1))
    assert marks((DAY[0], 1), (DAY[0], 1), (DAY[0], 3)) != marks((DAY[0], 2), (DAY[0], 2), (DAY[0], 3))


def test_a_recheck_without_an_alert_leaves_none(spark, scratch):
    alert = lambda *days: spark.createDataFrame(
        [(d, "t", "m", "critical", T(2024, 1, 6), "{}") for d in days], sinks.ALERT_ROWS)
    checked = lambda *days: spark.createDataFrame([(d,) for d in days], "check_date date")
    path = f"{scratch}/alerts"
    stored = lambda: sorted(r.check_date for r in sinks.read_alerts(spark, path).collect())
    sinks.merge_alerts(spark, alert(DAY[0], DAY[1], DAY[1]), checked(DAY[0], DAY[1], DAY[2]), path, "c1")
    assert stored() == [DAY[0], DAY[1], DAY[1]]
    sinks.merge_alerts(spark, alert(), checked(DAY[1]), path, "c2")
    assert stored() == [DAY[0]]
    sinks.merge_alerts(spark, alert(DAY[2]), checked(DAY[0], DAY[2]), path, "c3")
    assert stored() == [DAY[2]]
    assert not sinks.merge_alerts(spark, alert(DAY[0]), checked(DAY[0]), path, "c3")
    assert stored() == [DAY[2]]


# --- ingest -------------------------------------------------------------------------------

USER = '{"event_id": "%d", "timestamp": "2024-01-%02dT10:00:00", "user_id": "%d", "event_type": "view", "page": "/"}'


def raw_rows(spark, values, topic="user_events"):
    return spark.createDataFrame([(topic, str(i), v) for i, v in enumerate(values)],
                                 "topic string, key string, value string").withColumn(
        "timestamp", F.lit(T(2024, 1, 9)).cast("timestamp_ntz"))


def run_ingest(spark, landing, out, ckpt):
    for q in ingest.start_ingest(ingest.read_file_stream(spark, landing), out, ckpt, available_now=True).values():
        q.awaitTermination()


@pytest.mark.parametrize("stop_at", ["_record", "second table"])
def test_a_batch_stopped_midway_is_stored_once(spark, scratch, monkeypatch, stop_at):
    landing, out, ckpt = f"{scratch}/landing", f"{scratch}/out", f"{scratch}/ckpt"
    raw_rows(spark, [USER % (i, 1 + i % 3, i) for i in range(60)] + ["broken"] * 7).write.parquet(landing)
    run_ingest(spark, landing, out, ckpt)
    second = raw_rows(spark, [USER % (i, 1 + i % 3, i) for i in range(60, 100)] + ["broken"] * 4)
    product = raw_rows(spark, ['{"event_id": "p", "timestamp": "2024-01-01T00:00:00", "product_id": "1", '
                               '"event_type": "view"}'], "product_events")
    second.unionByName(product).coalesce(1).write.mode("append").parquet(landing)
    if stop_at == "_record":
        monkeypatch.setattr(ingest, "_record", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    else:
        good = events.stored_columns
        monkeypatch.setattr(events, "stored_columns",
                            lambda t: [F.expr("raise_error('killed')")] if t == "product_events" else good(t))
    with pytest.raises(Exception):
        run_ingest(spark, landing, out, ckpt)
    monkeypatch.undo()
    count = lambda name: ingest.read_landed(spark, out, name).count()
    assert (count("user_events"), count("dead_letter")) == (60, 7)     # nothing of the stopped batch is seen
    run_ingest(spark, landing, out, ckpt)
    run_ingest(spark, landing, out, ckpt)
    assert (count("user_events"), count("dead_letter")) == (100, 11)
    assert ingest.read_landed(spark, out, "user_events").select("event_id").distinct().count() == 100
    log = spark.read.schema(ingest.LOG_SCHEMA).parquet(f"{out}/{ingest.LOG}")
    assert {(r.table, r.n) for r in log.groupBy("table").agg(F.sum("n_rows").alias("n")).collect()} == {
        ("user_events", 100), ("dead_letter", 11), ("product_events", 1), ("order_events", 0)}


def test_a_batch_run_again_after_its_entry_adds_nothing(spark, scratch):
    batch = raw_rows(spark, [USER % (1, 1, 1)])
    for _ in range(2):
        ingest._store_batch(batch, 0, events.TOPIC_NAMES, "dead_letter", scratch, "x")
    assert ingest.read_landed(spark, scratch, "user_events").count() == 1
    assert spark.read.parquet(f"{scratch}/{ingest.LOG}").count() == 4


def test_the_sinks_read_the_kept_parse(spark, scratch, capsys):
    batch = events.routed(raw_rows(spark, [USER % (1, 1, 1), "x"]), events.TOPIC_NAMES).persist()
    for name in (*events.TOPIC_NAMES, "dead_letter"):
        capsys.readouterr()
        batch.filter(F.col("destination") == name).select(f"{name}.*").explain()
        top = capsys.readouterr().out.split("InMemoryRelation")[0]
        assert "InMemoryTableScan" in top and "from_json" not in top and "parse_json" not in top
    batch.unpersist()


def test_a_hot_day_has_as_many_writers_as_its_rows_need(spark, scratch):
    """One day's rows: one file where they are few, several where they pass the advisory size."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    few, many = ([USER % (i, 1, i * 7919 % 100_003) for i in range(n)] for n in (50, 20_000))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k")
    try:
        files = []
        for name, values in (("few", few), ("many", many)):
            batch = raw_rows(spark, values).repartition(8)
            ingest._store_batch(batch, 0, ["user_events"], "dead_letter", f"{scratch}/{name}", "x")
            files.append(len(ingest.landed_days(spark, f"{scratch}/{name}", "user_events").inputFiles()))
    finally:
        if old is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    assert files[0] == 1 and files[1] >= 3


# --- values that used to switch behaviour -----------------------------------------------------

def test_no_text_makes_a_message_malformed_or_whole(spark):
    good = ['{"a": "__end_of_value__"}', '{"end": 0}', ' {"a": [1, {"b": 2}]} ', "{}"]
    bad = ['{"a": 1},"x"', '{"a": 1}, 0', '{"a": 1},"end":0', '{"a": 1}], [1', '{"a": 1} x', '[{"a": 1}]', "1", "",
           None, '{"a": 1, "a": 2}', '{"a": 1}{"b": 2}', '"x"', "null", '{"a": 1},"__end_of_value__":0}']
    got = [r.m is not None for r in events.decode(raw_rows(spark, good + bad)).orderBy(
        F.col("key").cast("int")).collect()]
    assert got == [True] * len(good) + [False] * len(bad)


def test_every_text_survives_csv_and_large_files_split(spark, scratch):
    texts = ["\u0001", "", None, "\\", "\\n", "\\\\n", "\\N", "\\E", "\\s", "a\nb", "a\r\nb", "\r", '"', '""', '","', " x ",
             "NA", "null", "é 漢🙂", ",", "#", "\\sn", "\t", "\x00"]
    frame = spark.createDataFrame([(i, t, D("1.50") if i % 2 else None) for i, t in enumerate(texts)],
                                  "i int, t string, d decimal(10,2)")
    sinks.write_csv_staging(frame, f"{scratch}/a")
    back = read_csv_staging(spark, f"{scratch}/a", frame.schema)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, frame.collect()))
    big = spark.range(40_000).select(F.col("id").cast("int").alias("i"), F.lit("line\nbreak " * 6).alias("t"),
                                     F.lit(None).cast("decimal(10,2)").alias("d")).coalesce(1)
    sinks.write_csv_staging(big, f"{scratch}/b")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 19))
    try:
        back = read_csv_staging(spark, f"{scratch}/b", frame.schema)
        assert back.rdd.getNumPartitions() > 3 and back.filter("t LIKE 'line%'").count() == 40_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert schemas.TOPICS
