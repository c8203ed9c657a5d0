"""Exact distinct counts that can be merged (A2, T2, V3): bitmaps of ids per day and group.

A distinct count of one day says nothing about a week. A bitmap per (day, group, bucket of ids) does:
bitmaps of any days are combined by OR and counted, and the count is exact. ``bitmap_construct_agg`` folds
rows into bitmaps in the map tasks, so what is shuffled is at most one bitmap per task and (day, group,
bucket), never a row per (group, user); a group or day that holds a third of all rows is folded like any
other.

Ids are whole numbers; NULL ids are not counted. A bitmap covers 32,768 neighbouring ids and takes 4 KB
before compression, so ids should be dense, as the shop's serial keys are. Sparse ids stay right but take
a bitmap each: number them densely first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITMAP_COLUMNS = ("bucket", "bitmap")


def _merge(bitmaps: DataFrame, keys: list) -> DataFrame:
    return bitmaps.groupBy(*keys, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def daily_bitmaps(rows: DataFrame, day: Column, id_col: str, groups: list[str]) -> DataFrame:
    """(day, *groups, bucket, bitmap): the ids seen per day and group, ready to be stored by day."""
    ids = F.col(id_col).cast("bigint")
    seen = rows.filter(ids.isNotNull()).select(
        day.cast("date").alias("day"), *groups, F.bitmap_bucket_number(ids).alias("bucket"),
        F.bitmap_bit_position(ids).alias("_bit"))
    return seen.groupBy("day", *groups, "bucket").agg(F.bitmap_construct_agg("_bit").alias("bitmap"))


def roll_up(bitmaps: DataFrame, grain: str, groups: list[str], day: str = "day") -> DataFrame:
    """The bitmaps of whole weeks, months, quarters or years: ``day`` becomes the first day of each. Months
    can be rolled up further to quarters and years, since the bitmaps merge."""
    first = F.to_date(F.date_trunc(grain, F.col(day).cast("timestamp_ntz")))
    return _merge(bitmaps.withColumn(day, first), [day, *groups])


def count_bitmaps(bitmaps: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Distinct ids per ``keys``. Rows of one key and bucket must be merged already, as ``daily_bitmaps``,
    ``roll_up`` and ``over_ranges`` give them: buckets hold different ids, so their counts add up."""
    return bitmaps.groupBy(*keys).agg(F.sum(F.bitmap_count("bitmap")).cast("bigint").alias(name))


def over_ranges(bitmaps: DataFrame, ranges: DataFrame, groups: list[str]) -> DataFrame:
    """Bitmaps merged over ranges of days, which may overlap. ``ranges``: ``range_name``, ``first_day``,
    ``last_day`` (inclusive), one row per name; a range with a NULL bound or no day is empty and has no row in
    the result. Ranges are expanded to days, so the join is on the day, not on an interval."""
    days = (ranges.filter(F.col("first_day") <= F.col("last_day"))
            .select("range_name", F.explode(F.sequence("first_day", "last_day")).alias("day")))
    return _merge(bitmaps.join(days, "day"), ["range_name", *groups])
