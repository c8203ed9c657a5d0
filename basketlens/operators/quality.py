"""Data-quality checks (Q1-Q4) and constraint audits.

The reference runs nine queries in series, each on its own connection, and
returns Python dicts. Here each check is a one-pass aggregate; the full set is
one unioned plan in long form, so a single action runs all nine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions.exprs import as_of_ts, hours_between, ratio

LONG_FORM = ["check_name", "table_name", "column_name", "metric", "value", "text_value"]


def _freshness_aggs(timestamp_col: str, max_age_hours: int, now: F.Column) -> list:
    ts = F.col(timestamp_col)
    cutoff = now - F.make_dt_interval(F.lit(0), F.lit(max_age_hours))
    return [F.max(ts).alias("latest_record"),
            F.count(F.lit(1)).alias("total_records"),
            F.count_if(ts > cutoff).alias("recent_records")]


def _freshness_columns(max_age_hours: int, now: F.Column) -> list:
    age = hours_between(F.col("latest_record"), now)
    return [age.alias("age_hours"),
            F.coalesce(age <= F.lit(float(max_age_hours)), F.lit(False)).alias("is_fresh")]


def check_data_freshness(df: DataFrame, timestamp_col: str, max_age_hours: int = 24,
                         as_of=None, table: str = "table") -> DataFrame:
    """Q1: table_name, latest_record, age_hours, is_fresh (age <= max), total_records,
    recent_records (strictly newer than ``as_of - max_age_hours``).

    Both of the reference's clocks (SQL ``NOW()`` and Python ``now()``) are one
    ``as_of``. An empty table gives NULL age and ``is_fresh = false``.
    """
    now = as_of_ts(as_of)
    agg = df.agg(*_freshness_aggs(timestamp_col, max_age_hours, now))
    return agg.select(F.lit(table).alias("table_name"), "latest_record",
                      *_freshness_columns(max_age_hours, now),
                      "total_records", "recent_records")


def check_null_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Q2: total_records and ``<col>_null_rate`` for each column, in one pass.
    A rate is NULL on an empty table (AVG over no rows)."""
    n = F.count(F.lit(1))
    rates = [ratio(F.count_if(F.col(c).isNull()), n).alias(f"{c}_null_rate") for c in columns]
    return df.agg(n.alias("total_records"), *rates)


def _orphan_count(child: DataFrame, child_col: str, parent: DataFrame,
                  parent_col: str) -> DataFrame:
    """Rows of ``child`` whose non-NULL key has no parent.

    The reference writes LEFT JOIN ... WHERE parent IS NULL, which Catalyst
    keeps as an outer join; this is the anti join it means. Child rows are
    first counted per key, so a key holding a third of all rows is one row per
    map task before the shuffle.
    """
    per_key = (child.filter(F.col(child_col).isNotNull())
               .groupBy(F.col(child_col).alias("_k"))
               .agg(F.count(F.lit(1)).alias("_n")))
    keys = parent.select(F.col(parent_col).alias("_k"))
    missing = per_key.join(keys, "_k", "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("orphaned_records"))


def check_referential_integrity(child: DataFrame, child_col: str, parent: DataFrame,
                                parent_col: str, child_table: str = "child",
                                parent_table: str = "parent") -> DataFrame:
    """Q3: orphaned_records and has_orphans for one foreign key."""
    counted = _orphan_count(child, child_col, parent, parent_col)
    return counted.select(F.lit(child_table).alias("child_table"),
                          F.lit(parent_table).alias("parent_table"),
                          "orphaned_records",
                          (F.col("orphaned_records") > 0).alias("has_orphans"))


# The checks the reference runs (fixed values): table, timestamp column.
FRESHNESS_CHECKS = [("users", "created_at"), ("orders", "created_at"),
                    ("products", "updated_at")]
# table -> columns whose NULL rate is checked.
NULL_RATE_CHECKS = [("users", ["email", "first_name", "last_name"]),
                    ("products", ["name", "price", "sku"]),
                    ("orders", ["user_id", "total_amount", "status"])]
# child table, child column, parent table, parent column.
INTEGRITY_CHECKS = [("products", "category_id", "categories", "id"),
                    ("orders", "user_id", "users", "id"),
                    ("order_items", "order_id", "orders", "id")]


# Metrics that are no numbers; they stand in text_value.
TEXT_METRICS = {"latest_record", "parent_table"}


def _long_multi(df: DataFrame, table: str,
                items: list[tuple[str, str | None, str]]) -> DataFrame:
    """Unpivot a one-row aggregate into (check, table, column, metric, value, text_value)
    rows, one per (check, column, metric) item, with a single explode."""
    def value(m: str) -> F.Column:
        return F.lit(None).cast("double") if m in TEXT_METRICS else F.col(m).cast("double")

    def text(m: str) -> F.Column:
        return (F.col(m) if m in TEXT_METRICS else F.lit(None)).cast("string")

    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(check).alias("check_name"),
                 F.lit(column).cast("string").alias("column_name"), F.lit(m).alias("metric"),
                 value(m).alias("value"), text(m).alias("text_value"))
        for check, column, m in items])).alias("m"))
    return stacked.select(F.col("m.check_name").alias("check_name"),
                          F.lit(table).alias("table_name"),
                          F.col("m.column_name").alias("column_name"),
                          F.col("m.metric").alias("metric"), F.col("m.value").alias("value"),
                          F.col("m.text_value").alias("text_value"))


def _long(df: DataFrame, check: str, table: str, column: str | None,
          metrics: list[str]) -> DataFrame:
    """Unpivot one check's single row into (check, table, column, metric, value)."""
    return _long_multi(df, table, [(check, column, m) for m in metrics])


def run_all_checks(tables: dict[str, DataFrame], as_of=None) -> DataFrame:
    """Q4: three freshness, three null-rate and three integrity checks as one
    long-form frame (check_name, table_name, column_name, metric, value).

    A table's freshness and null-rate metrics come from one aggregate pass
    over it, so users, orders and products are each read once for both."""
    now = as_of_ts(as_of)
    null_cols = dict(NULL_RATE_CHECKS)
    parts: list[DataFrame] = []
    for table, col in FRESHNESS_CHECKS:
        cols = null_cols.get(table, [])
        n = F.count(F.lit(1))
        rates = [ratio(F.count_if(F.col(c).isNull()), n).alias(f"{c}_null_rate") for c in cols]
        one = tables[table].agg(*_freshness_aggs(col, 24, now), *rates)
        one = one.select("*", *_freshness_columns(24, now))
        items = [("freshness", col, m)
                 for m in ["latest_record", "age_hours", "is_fresh", "total_records", "recent_records"]]
        if cols:
            items += [("null_rates", None, m)
                      for m in ["total_records"] + [f"{c}_null_rate" for c in cols]]
        parts.append(_long_multi(one, table, items))
    for table, cols in NULL_RATE_CHECKS:
        if table not in dict(FRESHNESS_CHECKS):
            parts.append(_long(check_null_rates(tables[table], cols), "null_rates", table, None,
                               ["total_records"] + [f"{c}_null_rate" for c in cols]))
    for child, col, parent, pcol in INTEGRITY_CHECKS:
        ri = check_referential_integrity(tables[child], col, tables[parent], pcol, child, parent)
        parts.append(_long(ri, "referential_integrity", child, col,
                           ["parent_table", "orphaned_records", "has_orphans"]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


CHECKED, ABSENT = "checked", "column_absent"


def _absent(tables: dict[str, DataFrame], names: dict[str, str], numbers: list[str]) -> DataFrame:
    """The row of a constraint that cannot be checked: the input lacks a column."""
    spark = next(iter(tables.values())).sparkSession
    return spark.range(1).select(*[F.lit(v).alias(n) for n, v in names.items()],
                                 *[F.lit(None).cast("bigint").alias(n) for n in numbers],
                                 F.lit(ABSENT).alias("status"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _has(tables: dict[str, DataFrame], table: str, *cols: str) -> bool:
    return table in tables and set(cols) <= set(tables[table].columns)


def audit_unique(tables: dict[str, DataFrame]) -> DataFrame:
    """One row for every declared PRIMARY KEY / UNIQUE column: the rows
    checked, the keys that repeat and the rows they cover. NULL keys are
    skipped, as a UNIQUE constraint allows many NULLs. A constraint whose columns
    the input lacks is a row with status ``column_absent``."""
    parts = []
    numbers = ["rows_checked", "duplicate_keys", "duplicate_rows"]
    for table, cols in schemas.UNIQUE_KEYS:
        names = {"table_name": table, "key_columns": ",".join(cols)}
        if not _has(tables, table, *cols):
            parts.append(_absent(tables, names, numbers))
            continue
        keyed = tables[table].select(*cols)
        for c in cols:
            keyed = keyed.filter(F.col(c).isNotNull())
        per_key = keyed.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
        parts.append(per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("rows_checked"),
            F.count_if(F.col("_n") > 1).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0))
             .cast("bigint").alias("duplicate_rows"),
        ).select(*[F.lit(v).alias(n) for n, v in names.items()], *numbers,
                 F.lit(CHECKED).alias("status")))
    return _union(parts)


def audit_not_null(tables: dict[str, DataFrame]) -> DataFrame:
    """R2: NULL count per declared NOT NULL column, one aggregate pass per table;
    an absent column is a row with status ``column_absent``."""
    parts = []
    numbers = ["null_count", "total_records"]
    for table, cols in schemas.NOT_NULL.items():
        present = [c for c in cols if _has(tables, table, c)]
        parts += [_absent(tables, {"table_name": table, "column_name": c}, numbers)
                  for c in cols if c not in present]
        if not present:
            continue
        agg = tables[table].agg(F.count(F.lit(1)).alias("_total"),
                                *[F.count_if(F.col(c).isNull()).alias(c) for c in present])
        stacked = agg.select("_total", F.explode(F.array(*[
            F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count"))
            for c in present])).alias("m"))
        parts.append(stacked.select(F.lit(table).alias("table_name"),
                                    F.col("m.column_name").alias("column_name"),
                                    F.col("m.null_count").alias("null_count"),
                                    F.col("_total").alias("total_records"),
                                    F.lit(CHECKED).alias("status")))
    return _union(parts)


def audit_foreign_keys(tables: dict[str, DataFrame]) -> DataFrame:
    """Orphan counts over every declared foreign key; one whose columns are absent
    is a row with status ``column_absent``."""
    parts = []
    for child, col, parent, pcol, _cascade in schemas.FOREIGN_KEYS:
        names = {"child_table": child, "child_column": col, "parent_table": parent,
                 "parent_column": pcol}
        if not (_has(tables, child, col) and _has(tables, parent, pcol)):
            parts.append(_absent(tables, names, ["orphaned_records"]))
            continue
        parts.append(_orphan_count(tables[child], col, tables[parent], pcol).select(
            *[F.lit(v).alias(n) for n, v in names.items()], "orphaned_records",
            F.lit(CHECKED).alias("status")))
    return _union(parts)
