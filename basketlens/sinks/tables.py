"""Batch sinks: the summary tables (K1, K2), CSV staging (K3) and the alerts
table (M5). Targets are folders on shared storage, partitioned by day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions.exprs import as_of_ts
from ..sources.tables import CSV_OPTIONS, csv_encoded
from . import versions


DAYS_PER_TASK = 32


def daily_path(target: str) -> str:
    return f"{target.rstrip('/')}/daily_sales_summary"


def hourly_path(target: str) -> str:
    return f"{target.rstrip('/')}/hourly_sales_summary"


def _create_if_absent(spark: SparkSession, path: str, schema: T.StructType,
                      partition_by: list[str]) -> None:
    """``CREATE TABLE IF NOT EXISTS``: mode ``ignore`` writes nothing when the
    folder already holds a table."""
    (spark.createDataFrame([], schema).write.mode("ignore")
     .partitionBy(*partition_by).parquet(path))


def create_summary_tables(spark: SparkSession, target: str) -> None:
    """K1: both summary tables, partitioned by ``order_date``."""
    _create_if_absent(spark, daily_path(target), schemas.DAILY_SALES_SUMMARY, ["order_date"])
    _create_if_absent(spark, hourly_path(target), schemas.HOURLY_SALES_SUMMARY, ["order_date"])


def load_summary(df: DataFrame, path: str, overwrite_day: bool = False, load_time=None) -> None:
    """K2: append rows, stamping ``created_at`` as the database default did (with
    ``load_time``, by default now).

    ``overwrite_day=True`` uses dynamic partition overwrite: only the days
    present in ``df`` are replaced, so rerunning a day is idempotent.
    """
    schema = (schemas.DAILY_SALES_SUMMARY if "category_name" in df.columns
              else schemas.HOURLY_SALES_SUMMARY)
    stamped = df.withColumn("created_at", as_of_ts(load_time))
    ordered = stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                               for f in schema.fields])
    # Rows of a day together; the number of tasks follows the number of day folders to write,
    # whatever spark.sql.shuffle.partitions says: one task for a single day. (A summary day is
    # a few thousand rows, so creating the folders is the work.)
    days = ordered.select("order_date").distinct().count()
    writer = (ordered.repartition(max(1, -(-days // DAYS_PER_TASK)), "order_date")
              .write.partitionBy("order_date"))
    if overwrite_day:
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode("append")
    writer.parquet(path)


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    schema = (schemas.DAILY_SALES_SUMMARY if path.rstrip("/").endswith("daily_sales_summary")
              else schemas.HOURLY_SALES_SUMMARY)
    cols = [f.name for f in schema.fields]
    return spark.read.schema(schema).parquet(path).select(*cols)


def write_csv_staging(df: DataFrame, path: str) -> None:
    """K3 re-aimed: header CSV, one file per task, no index column, lossless."""
    csv_encoded(df).write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def append_alerts(alerts: DataFrame, path: str) -> None:
    """M5 sink, simple form: alerts are rows in a table, partitioned by the day they are about.
    Days that are in the frame replace what is stored; a day checked without an alert is not in
    it and stays as it was. ``merge_alerts`` resets such days."""
    (alerts.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("check_date").parquet(path))


ALERT_ROWS = T.StructType([
    T.StructField("check_date", T.DateType()), T.StructField("alert_title", T.StringType()),
    T.StructField("message", T.StringType()), T.StructField("severity", T.StringType()),
    T.StructField("alert_time", T.TimestampNTZType()), T.StructField("payload", T.StringType())])


def merge_alerts(spark: SparkSession, alerts: DataFrame, checked: DataFrame, path: str,
                 run_id: str) -> bool:
    """M5 sink: one check run. ``checked`` has the days the run looked at (``check_date``); each has
    afterwards exactly the alerts this run raised for it, none if it raised none. A repeated run adds
    nothing. Alerts about other days than the checked ones are checked days too."""
    rows = alerts.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in ALERT_ROWS.fields])
    days = (checked.select(F.col("check_date").alias("day"), F.lit(0).alias("n"))
            .unionByName(rows.select(F.col("check_date").alias("day"), F.lit(1).alias("n")))
            .groupBy("day").agg(F.sum("n").cast("bigint").alias("n_rows")))
    return versions.load_run(spark, path, run_id, {"alerts": rows}, "check_date", days)


def read_alerts(spark: SparkSession, path: str) -> DataFrame:
    return versions.read_current(spark, path, "alerts", ALERT_ROWS, "check_date")


def read_loaded(spark: SparkSession, target: str, name: str) -> DataFrame:
    """A summary table of ``sales.run_versioned_pipeline``: ``daily_sales_summary`` or ``hourly_sales_summary``."""
    return versions.read_current(spark, target, name, SUMMARIES[name], "order_date")


SUMMARIES = {"daily_sales_summary": schemas.DAILY_SALES_SUMMARY,
             "hourly_sales_summary": schemas.HOURLY_SALES_SUMMARY}


def stamped(df: DataFrame, name: str, load_time=None) -> DataFrame:
    """Summary rows with ``created_at``, in the stored types and order."""
    rows = df.withColumn("created_at", as_of_ts(load_time))
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SUMMARIES[name].fields])
