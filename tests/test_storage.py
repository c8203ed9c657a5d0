"""Merged distinct counts, event ids from content, file layout, buckets, database splits, SQL cards."""

import datetime as dt
import glob
import random
import uuid

import duckdb
import pytest
from pyspark.sql import functions as F

from basketlens import schemas, session
from basketlens.operators import metrics, reach, sales
from basketlens.plans import cards, catalog, sql_views
from basketlens.sinks import bucketed
from basketlens.sources import splits
from basketlens.sources.adapters import ShopTables
from basketlens.streaming import events, ingest

SF = "/root/testdata/sf0.001"


# --- merged distinct counts -----------------------------------------------------------

IDS = [1, 32_768, 32_769, 0, -1, -32_768, 2 ** 62, -2 ** 62, None]


def test_bitmaps_count_like_distinct(spark):
    rng = random.Random(3)
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(100)), rng.choice("ab"),
             rng.choice(IDS + list(range(50)))) for _ in range(3000)]
    rows += [(None, "a", 5), (dt.date(2024, 1, 3), None, 7)]
    df = spark.createDataFrame(rows, "d date, g string, u bigint")
    daily = reach.daily_bitmaps(df, F.col("d"), "u", ["g"])
    want = lambda key: {k: len({u for d, g, u in rows if u is not None and key(d, g) == k})
                        for k in {key(d, g) for d, g, u in rows if u is not None}}
    got = reach.count_bitmaps(daily, ["day", "g"], "n")
    assert {(r.day, r.g): r.n for r in got.collect()} == want(lambda d, g: (d, g))
    months = reach.roll_up(daily, "month", ["g"])
    quarters = reach.count_bitmaps(reach.roll_up(months, "quarter", ["g"]), ["day", "g"], "n")
    first = lambda d: d and dt.date(d.year, 3 * ((d.month - 1) // 3) + 1, 1)
    assert {(r.day, r.g): r.n for r in quarters.collect()} == want(lambda d, g: (first(d), g))
    ranges = spark.createDataFrame(
        [("x", dt.date(2024, 1, 5), dt.date(2024, 1, 20)), ("y", dt.date(2024, 1, 15), dt.date(2024, 3, 1)),
         ("none", dt.date(2025, 1, 1), dt.date(2024, 1, 1)), ("open", None, dt.date(2024, 1, 1)),
         ("later", dt.date(2030, 1, 1), dt.date(2030, 1, 2))],
        "range_name string, first_day date, last_day date")
    counted = {(r.range_name, r.g): r.n for r in
               reach.count_bitmaps(reach.over_ranges(daily, ranges, ["g"]), ["range_name", "g"], "n").collect()}
    for name, a, b in (("x", dt.date(2024, 1, 5), dt.date(2024, 1, 20)),
                       ("y", dt.date(2024, 1, 15), dt.date(2024, 3, 1))):
        for g in {g for d, g, _ in rows if d and a <= d <= b}:
            assert counted.pop((name, g)) == len({u for d, h, u in rows if d and a <= d <= b and h == g
                                                 and u is not None})
    assert not counted


def test_bitmaps_of_no_rows(spark):
    nothing = spark.createDataFrame([], "d date, g string, u bigint")
    assert reach.daily_bitmaps(nothing, F.col("d"), "u", ["g"]).isEmpty()


def test_counting_shuffles_bitmaps_not_users(spark, capsys):
    """The only shuffle is by day, group and bucket, and rows are folded before it."""
    df = spark.range(100).select(F.lit(dt.date(2024, 1, 1)).alias("d"), F.lit("a").alias("g"), F.col("id").alias("u"))
    capsys.readouterr()
    reach.daily_bitmaps(df, F.col("d"), "u", ["g"]).explain()
    plan = capsys.readouterr().out
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1 and "bucket" in exchanges[0] and "u#" not in exchanges[0]
    assert "partial_bitmap_construct_agg" in plan


# --- event ids ---------------------------------------------------------------------------

def sent(spark, copies=1):
    at = dt.datetime(2024, 1, 5, 10, 0, 0, 500)
    rows = [(1, at, "view", "/a", None), (2, at, "view", "/a", "x"), (None, None, None, "/;é", ""),
            (1, at, "view", "/b", None)] * copies
    return spark.createDataFrame(rows, "user_id bigint, timestamp timestamp_ntz, event_type string, page string, "
                                       "session_id string")


def ids(df):
    read = events.decode(events.user_event_envelopes(df))
    return sorted(r[0] for r in read.select(F.col("m")["event_id"]).collect())


def test_event_ids_are_name_based_and_stable(spark):
    once = ids(sent(spark))
    assert len(set(once)) == 4 and once == ids(sent(spark).repartition(3))
    twice = ids(sent(spark, 2))
    assert len(set(twice)) == 8 and set(once) < set(twice)
    name = "user_events;event_type=4:view;page=2:/a;session_id=-;timestamp=26:2024-01-05T10:00:00.000500;user_id=1:1#0"
    assert str(uuid.uuid5(events.ID_NAMESPACE, name)) in once
    assert all(uuid.UUID(i).version == 5 and uuid.UUID(i).variant == uuid.RFC_4122 for i in twice)


def test_many_copies_of_a_row_get_ids_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(events, "ORDINALS", 7)
    got = ids(sent(spark, 20))
    assert len(got) == len(set(got)) == 80
    monkeypatch.undo()
    assert got == ids(sent(spark, 20))


def test_given_event_ids_stay(spark):
    assert ids(sent(spark).withColumn("event_id", F.lit(5))) == ["5"] * 4


def test_topics_and_nested_columns_tell_events_apart(spark):
    rows = spark.createDataFrame([(1, [1, 2]), (1, [1, 3]), (1, None)], "a int, items array<int>")
    one, other = (events.with_event_ids(rows, t).select("event_id").collect() for t in ("x", "y"))
    assert len({r[0] for r in [*one, *other]}) == 6


# --- event table files ----------------------------------------------------------------------

def test_row_groups_can_be_skipped_by_time_and_by_id(spark, scratch):
    start = dt.datetime(2024, 1, 1)
    days = spark.range(40_000).select(
        F.concat(F.lit("event-"), F.sha1(F.col("id").cast("string"))).alias("event_id"),
        (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id") * 4)).alias("timestamp"),
        (F.col("id") * 7919 % 5000).cast("string").alias("user_id"), F.lit("view").alias("event_type"),
        F.lit("/").alias("page"))
    rows = days.select(*[(F.col(f.name) if f.name in days.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in schemas.USER_EVENTS.fields])
    out = f"{scratch}/user_events"
    options = {**events.event_file_options("user_events", row_group_bytes=128 * 1024),
               "parquet.page.size.row.check.min": "100", "parquet.block.size.row.check.min": "100"}
    (events.event_layout(rows, "user_events").write.options(**options).partitionBy("event_date").parquet(out))
    stored = spark.read.parquet(out)
    assert stored.count() == 40_000
    con = duckdb.connect()
    files = sorted(glob.glob(f"{out}/event_date=*/*.parquet"))
    groups = [g for f in files for g in con.execute(
        "SELECT file_name, row_group_id, stats_min_value, stats_max_value FROM parquet_metadata(?) "
        "WHERE path_in_schema = 'timestamp'", [f]).fetchall()]
    assert len(groups) >= 8
    # A quarter of an hour lies in few row groups of its day by their bounds.
    noon = "2024-01-02 12:00:00"
    inside = [g for g in groups if str(g[2])[:19] <= "2024-01-02 12:15:00" and str(g[3])[:19] >= noon
              and "2024-01-02" in g[0]]
    day = [g for g in groups if "event_date=2024-01-02" in g[0]]
    assert 1 <= len(inside) <= 2 < len(day)
    # One id: every group that does not hold it is excluded by its filter, but for chance hits.
    wanted = stored.select("event_id").first()[0]
    probes = [p for f in files for p in con.execute(
        "SELECT file_name, row_group_id, bloom_filter_excludes FROM parquet_bloom_probe(?, 'event_id', ?)",
        [f, wanted]).fetchall()]
    assert len(probes) == len(groups)
    kept = [p for p in probes if not p[2]]
    assert 1 <= len(kept) <= 2
    assert stored.filter(F.col("event_id") == wanted).count() == 1


def test_compacted_tables_have_filters(spark, scratch):
    t = ShopTables(spark, SF)
    for topic in events.TOPIC_NAMES:
        rows = events.normalise(catalog._raw_stream(t), topic).filter("timestamp >= '2024-01-25'")
        rows.withColumn("event_date", F.to_date("timestamp")).write.partitionBy("event_date").parquet(
            f"{scratch}/landed/{topic}")
        ingest.compact_events(spark, f"{scratch}/landed", f"{scratch}/table", topic)
        back = spark.read.parquet(f"{scratch}/table/{topic}").select(*rows.columns)
        assert back.exceptAll(rows).isEmpty() and back.count() == rows.count()
        one = glob.glob(f"{scratch}/table/{topic}/event_date=*/*.parquet")[0]
        offsets = duckdb.sql(f"SELECT bloom_filter_offset FROM parquet_metadata('{one}') "
                             "WHERE path_in_schema = 'event_id'").fetchall()
        assert offsets and all(o[0] for o in offsets)


# --- bucketed facts -----------------------------------------------------------------------

def exchanges_below(plan: str, marker: str) -> int:
    """Shuffles in the subtree of the first line with ``marker``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if marker in line)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    n = 0
    for line in lines[at + 1:]:
        if len(line) - len(line.lstrip(" :+-")) <= depth:
            break
        n += "Exchange hashpartitioning" in line
    return n


def test_bucketed_facts_join_without_a_shuffle(spark, scratch, capsys):
    t = ShopTables(spark, SF)
    facts = bucketed.write_fact_tables(t.orders, t.order_items, "shuffle_free", f"{scratch}/f", buckets=4)
    assert facts.items.exceptAll(t.order_items).isEmpty() and facts.items.count() == t.order_items.count()
    assert facts.loose_items.count() > 0
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        extract = sales.daily_sales_extract(facts.orders, facts.ordered_items, t.products, t.categories, t.users,
                                            bucketed=True)
        for df, marker in ((extract, "SortMergeJoin [order_id"),
                           (bucketed.pairs_with_status(facts), "SortMergeJoin [order_id")):
            capsys.readouterr()
            df.explain()
            plan = capsys.readouterr().out
            assert exchanges_below(plan, marker) == 0, plan
        plain = sales.daily_sales_extract(t.orders, t.order_items, t.products, t.categories, t.users)
        capsys.readouterr()
        plain.explain()
        assert exchanges_below(capsys.readouterr().out, "SortMergeJoin [order_id") > 0
        assert extract.exceptAll(plain).isEmpty() and plain.exceptAll(extract).isEmpty()
        v2 = metrics.product_performance_of(bucketed.pairs_with_status(facts), t.products, t.categories)
        want = metrics.product_performance(t.products, t.categories, t.order_items, t.orders)
        assert v2.exceptAll(want).isEmpty() and want.exceptAll(v2).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        for name in (facts.orders_name, facts.items_name):
            spark.sql(f"DROP TABLE {name}")


# --- database splits ---------------------------------------------------------------------------

def keys_of(kind, rng):
    value = {"int": lambda: rng.randrange(-500, 5000), "text": lambda: rng.choice(["o'b", "Z", "a", "é", ""])
             + str(rng.randrange(900)), "double": lambda: rng.random() * 100,
             "date": lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(700)),
             "time": lambda: dt.datetime(2024, 1, 1) + dt.timedelta(microseconds=rng.randrange(10 ** 12))}[kind]
    hot = value()
    return [None if rng.random() < 0.1 else hot if rng.random() < 0.33 else value() for _ in range(6000)]


@pytest.mark.parametrize("then", [None, "id"])
@pytest.mark.parametrize("kind", ["int", "text", "double", "date", "time"])
def test_splits_cover_each_row_once_and_are_even(kind, then):
    rng = random.Random(kind)
    types = {"int": "BIGINT", "text": "VARCHAR", "double": "DOUBLE", "date": "DATE", "time": "TIMESTAMP"}
    values = keys_of(kind, rng)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t (k {types[kind]}, id BIGINT)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(v, i) for i, v in enumerate(values)])
    sample = [(v, i) for i, v in enumerate(values) if rng.random() < 0.3]
    parts = 12
    predicates = splits.split_predicates(sample, "k", parts, then)
    sizes = [con.execute(f"SELECT count(*) FROM t WHERE {p}").fetchone()[0] for p in predicates]
    once = " + ".join(f"CAST(coalesce({p}, FALSE) AS INT)" for p in predicates)
    assert con.execute(f"SELECT count(*) FROM t WHERE {once} <> 1").fetchone()[0] == 0
    assert sum(sizes) == len(values) and len(predicates) <= 3 * parts
    if then:
        assert max(sizes) <= 2 * len(values) / parts
    # Rows that the sample has not seen are covered too.
    for sample_of in ([], sample[:1], [(None, 1)] * 5, [(values[0], 1)] * 50):
        predicates = splits.split_predicates(sample_of, "k", parts, then)
        once = " + ".join(f"CAST(coalesce({p}, FALSE) AS INT)" for p in predicates)
        assert con.execute(f"SELECT count(*) FROM t WHERE {once} <> 1").fetchone()[0] == 0


def test_the_sample_is_bounded_and_has_nulls(spark):
    df = spark.range(1000).select(F.when(F.col("id") % 3 > 0, F.col("id")).alias("k"), "id")
    got = splits.sample_keys(df, "k", "id", rows=100)
    assert len(got) == 100 and any(k is None for k, _ in got)
    assert splits.sample_keys(df, "k", rows=5)[0][1] is None
    with pytest.raises(ValueError):
        splits.split_predicates([], "k", 0)


# --- SQL cards --------------------------------------------------------------------------------

def test_cards_in_sql_equal_the_functions(spark):
    t, as_of = ShopTables(spark, SF), catalog.AS_OF
    catalog._sql(t)
    clv = metrics.customer_lifetime_value(t.users, t.orders)
    pp = metrics.product_performance(t.products, t.categories, t.order_items, t.orders)
    funnel = metrics.sales_funnel(t.user_sessions, t.cart_items, t.carts, t.orders)
    want = {"card_revenue_30d": cards.card_revenue_30d(t.orders, as_of),
            "card_new_customers_30d": cards.card_new_customers_30d(t.users, as_of),
            "card_avg_order_value": cards.card_avg_order_value(t.orders, as_of),
            "card_daily_revenue_trend": cards.card_daily_revenue_trend(t.orders, as_of),
            "card_top_products": cards.card_top_products(pp, 20), "card_low_stock": cards.card_low_stock(pp),
            "card_category_performance": cards.card_category_performance(pp),
            "card_clv_values": cards.card_clv_values(clv), "card_customer_segments": cards.card_customer_segments(clv),
            "card_sales_funnel_30d": cards.card_sales_funnel_30d(funnel, as_of)}
    assert set(want) == set(sql_views.CARDS)
    ordered = {"card_daily_revenue_trend", "card_top_products", "card_category_performance", "card_sales_funnel_30d"}
    for name, df in want.items():
        got = sql_views.card(spark, name, as_of)
        assert got.columns == df.columns, name
        a, b = [tuple(r) for r in got.collect()], [tuple(r) for r in df.collect()]
        assert (a == b) if name in ordered else sorted(a, key=str) == sorted(b, key=str), name
    for view, df in (("customer_lifetime_value", clv), ("product_performance", pp), ("sales_funnel", funnel)):
        got = spark.table(view)
        assert got.columns == df.columns
        assert got.exceptAll(df).isEmpty() and df.exceptAll(got).isEmpty()


def test_cards_in_sql_default_to_now_and_prune(spark, capsys):
    catalog._sql(ShopTables(spark, SF))
    assert sql_views.card(spark, "card_new_customers_30d").collect()[0][0] == 0
    capsys.readouterr()
    sql_views.card(spark, "card_revenue_30d", catalog.AS_OF).explain("formatted")
    plan = capsys.readouterr().out
    assert "BroadcastNestedLoopJoin" not in plan
    assert all("o_orderpriority" not in line for line in plan.splitlines() if line.startswith("ReadSchema"))


def test_the_number_of_buckets_follows_the_rows(spark, scratch, monkeypatch):
    monkeypatch.setattr(bucketed, "ROWS_PER_BUCKET", 100)
    orders = spark.range(1500).select("id", F.lit("completed").alias("status"))
    items = spark.range(3000).select((F.col("id") % 1500).alias("order_id"), F.col("id").alias("product_id"))
    for n, facts in ((30, bucketed.write_fact_tables(orders, items, "by_rows", f"{scratch}/by_rows")),
                     (8, bucketed.write_fact_tables(orders.limit(9), items.limit(9), "few", f"{scratch}/few"))):
        found = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {facts.items_name}").collect()}
        assert found["Num Buckets"] == str(n)
    assert spark.table("by_rows_order_items").count() == 3000


def test_shuffles_of_a_query_start_wide_unless_the_session_says_otherwise(spark):
    own = spark.newSession()
    key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    session.follow_size(own)
    assert own.conf.get(key) == "1024"
    own.conf.set(key, "7")
    session.follow_size(own)
    assert own.conf.get(key) == "7"
