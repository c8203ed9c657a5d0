"""Daily job: backfill equals the union of single days; append twice doubles
(the reference's behaviour), overwrite_day twice does not."""

import datetime as dt

from pyspark.sql import functions as F

from basketlens.operators import sales
from basketlens.sinks import tables as sinks
from basketlens.sources.adapters import ShopTables

SF = "/root/testdata/sf0.001"


def _days(t):
    ex = sales.daily_sales_extract(t.orders, t.order_items, t.products, t.categories, t.users)
    return [r.order_date for r in ex.select("order_date").distinct()
            .orderBy(F.desc("order_date")).limit(2).collect()]


def test_backfill_is_union_of_days(spark):
    t = ShopTables(spark, SF)
    days = _days(t)
    full = sales.daily_sales_summary(
        sales.daily_sales_extract(t.orders, t.order_items, t.products, t.categories, t.users))
    for d in days:
        one = sales.daily_sales_summary(sales.daily_sales_extract(
            t.orders, t.order_items, t.products, t.categories, t.users, d))
        same_day = full.filter(F.col("order_date") == F.lit(d))
        assert one.exceptAll(same_day).count() == 0 and same_day.exceptAll(one).count() == 0


def test_append_duplicates_and_overwrite_day_is_idempotent(spark, scratch):
    t = ShopTables(spark, SF)
    day = _days(t)[0]
    counts = sales.run_daily_pipeline(spark, t, f"{scratch}/a", run_date=day)
    assert counts["extract_daily_sales"] > 0 and counts["daily_summary"] > 0
    sales.run_daily_pipeline(spark, t, f"{scratch}/a", run_date=day)
    appended = sinks.read_summary(spark, sinks.daily_path(f"{scratch}/a")).count()
    assert appended == 2 * counts["daily_summary"]

    for _ in range(2):
        sales.run_daily_pipeline(spark, t, f"{scratch}/b", run_date=day, overwrite_day=True)
    once = sinks.read_summary(spark, sinks.daily_path(f"{scratch}/b"))
    assert once.count() == counts["daily_summary"]
    hourly = sinks.read_summary(spark, sinks.hourly_path(f"{scratch}/b"))
    assert hourly.count() == counts["hourly_summary"]
    assert once.filter(F.col("created_at").isNull()).count() == 0
    assert {r.order_date for r in once.select("order_date").distinct().collect()} == {day}


def test_day_filter_reaches_the_scan(spark, scratch, capsys):
    """On a stored orders table, DATE(created_at) = d becomes a pushed range."""
    t = ShopTables(spark, SF)
    t.orders.write.parquet(f"{scratch}/orders")
    stored = spark.read.parquet(f"{scratch}/orders")
    stored.filter(sales.day_filter("created_at", dt.date(2024, 1, 30))).explain("formatted")
    plan = capsys.readouterr().out
    scan = plan[plan.index("Scan parquet"):]
    pushed = scan[scan.index("PushedFilters"):].splitlines()[0]
    assert "created_at" in pushed and "GreaterThanOrEqual" in pushed and "LessThan" in pushed


def test_csv_staging_keeps_types_and_an_na_category(spark, scratch):
    """Unlike an inferred re-read, the staged CSV comes back with its schema:
    decimals stay decimal and a category named NA is not read as missing."""
    from decimal import Decimal

    from basketlens.sources.tables import read_csv_staging

    df = spark.createDataFrame(
        [(dt.date(2024, 1, 1), "NA", Decimal("10.50"), 3), (dt.date(2024, 1, 2), None,
                                                           Decimal("0.00"), 4)],
        "order_date date, category_name string, total_amount decimal(10,2), order_hour int")
    sinks.write_csv_staging(df, f"{scratch}/csv")
    back = read_csv_staging(spark, f"{scratch}/csv", df.schema)
    assert back.schema == df.schema
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
