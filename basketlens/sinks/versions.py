"""Tables loaded run by run, where a run's rows appear all at once (K2, T4, M5).

A run writes each of its tables into a folder of its own, `<root>/<table>/run_id=<run>/<day>=...`, and
then adds its rows to the manifest: one per day, with the day's fingerprint if it has one. Readers
go through the manifest, so a run that was stopped between two tables is not there, and the same
run tried again writes the same folders. A run that replaces days hides what earlier runs hold of
these days, also where it has no row for one. One loader writes to a root at a time.
"""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "manifest"
MANIFEST_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("seq", T.LongType()),
    T.StructField("replaces", T.BooleanType()), T.StructField("day", T.DateType()),
    T.StructField("n_rows", T.LongType()), T.StructField("hash_xor", T.LongType()),
    T.StructField("hash_sum", T.DecimalType(38, 0)), T.StructField("committed_at", T.TimestampNTZType())])
RUN_ID = re.compile(r"[A-Za-z0-9][A-Za-z0-9._-]*")


def read_if_there(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame | None:
    """The parquet table at `path`, or None where there is none."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def manifest(spark: SparkSession, root: str) -> DataFrame:
    found = read_if_there(spark, f"{root.rstrip('/')}/{MANIFEST}", MANIFEST_SCHEMA)
    return spark.createDataFrame([], MANIFEST_SCHEMA) if found is None else found


def is_committed(spark: SparkSession, root: str, run_id: str) -> bool:
    return not manifest(spark, root).filter(F.col("run_id") == run_id).isEmpty()


def day_fingerprints(df: DataFrame, day: str) -> DataFrame:
    """(day, n_rows, hash_xor, hash_sum) of each day's rows whatever their order: their count, and the
    exclusive or and exact sum of their hashes, so that repeated rows do not cancel out."""
    h = F.xxhash64(*[F.col(c) for c in sorted(df.columns)])
    return (df.select(F.col(day).alias("day"), h.alias("h")).groupBy("day")
            .agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor("h").alias("hash_xor"),
                 F.sum(F.col("h").cast("decimal(20,0)")).cast("decimal(38,0)").alias("hash_sum")))


def current_days(spark: SparkSession, root: str) -> DataFrame:
    """The newest manifest row of every day."""
    latest = F.max_by(F.struct(*[c for c in MANIFEST_SCHEMA.names if c != "day"]), "seq").alias("m")
    return manifest(spark, root).groupBy("day").agg(latest).select("day", "m.*")


def changed_days(spark: SparkSession, root: str, fingerprints: DataFrame) -> DataFrame:
    """The rows of `fingerprints` whose day is not loaded as it is now, and with zero rows the loaded days that
    are gone."""
    now, old = fingerprints.alias("now"), current_days(spark, root).alias("old")
    marks = ("n_rows", "hash_xor", "hash_sum")
    same = F.lit(True)
    for c in marks:
        same = same & F.col(f"now.{c}").eqNullSafe(F.col(f"old.{c}"))
    zero = F.lit(0).cast("bigint")
    both = now.join(old, F.col("now.day").eqNullSafe(F.col("old.day")), "full")
    gone = F.col("now.n_rows").isNull()
    return (both.filter(~same & ~(gone & (F.col("old.n_rows") == 0)))
            .select(F.coalesce("now.day", "old.day").alias("day"),
                    F.coalesce("now.n_rows", zero).alias("n_rows"),
                    F.coalesce("now.hash_xor", zero).alias("hash_xor"),
                    F.coalesce("now.hash_sum", F.lit(0).cast("decimal(38,0)")).alias("hash_sum")))


def write_tables(frames: dict[str, DataFrame], root: str, run_id: str, day: str) -> None:
    """The run's folders. Rows of a day come together; days share tasks by their measured size."""
    for name, df in frames.items():
        (df.hint("rebalance", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(day).parquet(f"{root.rstrip('/')}/{name}/run_id={run_id}"))


def commit(spark: SparkSession, root: str, run_id: str, days: DataFrame, replaces: bool,
           committed_at=None) -> None:
    """Add the run's days to the manifest: one file, so all of them or none."""
    last = manifest(spark, root).agg(F.max("seq")).first()[0] or 0
    stamp = F.localtimestamp() if committed_at is None else F.lit(committed_at).cast("timestamp_ntz")
    marks = [F.col(f.name).cast(f.dataType) if f.name in days.columns else F.lit(None).cast(f.dataType)
             for f in MANIFEST_SCHEMA.fields if f.name in ("n_rows", "hash_xor", "hash_sum")]
    rows = days.select(F.lit(run_id), F.lit(last + 1).cast("bigint"), F.lit(replaces),
                       F.col("day").cast("date"), *marks, stamp).toDF(*MANIFEST_SCHEMA.names)
    rows.coalesce(1).write.mode("append").parquet(f"{root.rstrip('/')}/{MANIFEST}")


def load_run(spark: SparkSession, root: str, run_id: str, frames: dict[str, DataFrame], day: str,
             days: DataFrame | None = None, replaces: bool = True, committed_at=None) -> bool:
    """Load the tables `frames` as the run `run_id`; False if that run is already in.

    `days` has a column `day` (and fingerprints, if they are known): the days this run is about, also those
    without rows. By default these are the days that occur. With `replaces` their earlier rows no
    longer count; without, the run's rows are added. A null day is allowed like any other.
    """
    if not RUN_ID.fullmatch(run_id):
        raise ValueError(f"a run id is made of letters, digits and ._- : {run_id!r}")
    if is_committed(spark, root, run_id):
        return False
    write_tables(frames, root, run_id, day)
    if days is None:
        written = [spark.read.schema(df.schema).parquet(f"{root.rstrip('/')}/{name}/run_id={run_id}")
                   .select(F.col(day).alias("day")) for name, df in frames.items()]
        days = written[0]
        for more in written[1:]:
            days = days.unionByName(more)
        days = days.groupBy("day").agg(F.count(F.lit(1)).alias("n_rows"))
    commit(spark, root, run_id, days, replaces, committed_at)
    return True


def read_current(spark: SparkSession, root: str, name: str, schema: T.StructType, day: str) -> DataFrame:
    """The rows of the table that count: of every day those of the newest run that replaced it, and of the runs
    that added to it since."""
    runs = manifest(spark, root)
    since = runs.filter("replaces").groupBy("day").agg(F.max("seq").alias("since"))
    seen = (runs.alias("m").join(since.alias("s"), F.col("m.day").eqNullSafe(F.col("s.day")), "left")
            .filter(F.col("m.seq") >= F.coalesce("s.since", F.lit(0)))
            .select("m.run_id", F.col("m.day").alias("_day")).distinct())
    stored = T.StructType([*schema.fields, T.StructField("run_id", T.StringType())])
    rows = read_if_there(spark, f"{root.rstrip('/')}/{name}", stored)
    if rows is None:
        return spark.createDataFrame([], schema)
    match = (rows["run_id"] == seen["run_id"]) & rows[day].eqNullSafe(seen["_day"])
    return rows.join(seen, match, "left_semi").select(*schema.names)
