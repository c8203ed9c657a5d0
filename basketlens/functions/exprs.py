"""Column expressions shared by the operators. All are built-in Spark
expressions, so they stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: _dt.datetime | _dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal (``F.lit(datetime)`` would give the zoned type)."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")


def iso_text(ts: Column) -> Column:
    """Python ``datetime.isoformat()`` of a TIMESTAMP_NTZ: ``T`` separator,
    six fraction digits only when the microseconds are non-zero.

    Built from ``cast(ts AS STRING)``, which is zone-free for NTZ values;
    ``date_format`` would first cast to the zoned type and shift local times
    that fall into a daylight-saving gap of the session zone."""
    text = ts.cast("timestamp_ntz").cast("string")
    base = F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8))
    frac = F.substring(text, 21, 6)
    return F.when(F.length(frac) == 0, base).otherwise(
        F.concat(base, F.lit("."), F.rpad(frac, 6, "0")))


def trunc_second(ts: Column) -> Column:
    """TIMESTAMP_NTZ truncated to the whole second, without a zone round trip."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19).cast("timestamp_ntz")


def date_lit(value: _dt.date | str) -> Column:
    text = value.isoformat() if isinstance(value, _dt.date) else str(value)
    return F.lit(text[:10]).cast("date")


def as_of_ts(as_of) -> Column:
    """The clock of a windowed metric. ``None`` means now, as a local (NTZ) time."""
    if as_of is None:
        return F.localtimestamp()
    if isinstance(as_of, Column):
        return as_of
    return ntz(as_of)


def days_before(as_of, days: int) -> Column:
    """``as_of - INTERVAL 'days days'`` on NTZ timestamps."""
    return as_of_ts(as_of) - F.make_dt_interval(F.lit(days))


def whole_days(later: Column, earlier: Column) -> Column:
    """``EXTRACT(DAYS FROM (later - earlier))``: whole 24-hour periods, not
    calendar-day boundaries (01-01 02:00 -> 01-03 01:00 is 1, datediff says 2)."""
    return F.extract(F.lit("DAY"), later - earlier).cast("bigint")


def int_div(a: Column, b: Column) -> Column:
    """SQL integer division ``a div b`` (bigint); NULL when b is 0 or NULL."""
    return F.when(b != 0, F.call_function("div", a, b))


def ratio(numerator: Column, denominator: Column) -> Column:
    """``cast(n as double) / cast(d as double)``; NULL when d is 0 or NULL."""
    d = denominator.cast("double")
    return F.when(d != 0, numerator.cast("double") / d)


def pct_round2(numerator: Column, denominator: Column) -> Column:
    """``ROUND(100.0 * n / NULLIF(d, 0), 2)`` for non-negative counts.

    Rounded half up exactly in integers: floor((20000 n + d) / (2 d)) / 100,
    so no double-rounding can move a boundary value."""
    n = numerator.cast("bigint")
    d = denominator.cast("bigint")
    return int_div(F.lit(20000) * n + d, F.lit(2) * d).cast("double") / F.lit(100.0)


def hours_between(earlier: Column, later: Column) -> Column:
    """``(later - earlier).total_seconds() / 3600`` as double."""
    micros = F.timestamp_diff("MICROSECOND", earlier, later)
    return micros.cast("double") / F.lit(3.6e9)


def cents_text(cents: Column) -> Column:
    """Render a non-negative integer number of cents as ``1234.56``."""
    c = cents.cast("bigint")
    return F.concat(F.call_function("div", c, F.lit(100)).cast("string"), F.lit("."),
                    F.lpad((c % 100).cast("string"), 2, "0"))


def literal_rows(spark, rows, schema):
    """A small literal table built on the JVM (``inline`` over one row), so
    reading it needs no Python worker and no parallelized RDD."""
    from pyspark.sql import types as T

    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs))).select(
        *[F.col(f.name) for f in schema.fields])


def portable(df, doubles=()):
    """Export types for cross-engine checks: integers -> bigint, decimals and
    floats -> double, dates -> midnight timestamp_ntz. DuckDB hands DECIMAL and
    DATE to pandas as float64 and datetime64, Spark as Decimal and date objects;
    the oracle SQL applies the same casts. Integer columns that can hold NULL
    (named in ``doubles``) become double too: pandas has no common type for
    them (Spark gives float64, DuckDB nullable Int64)."""
    from pyspark.sql import types as T

    cols = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        t = field.dataType
        if field.name in doubles:
            c = c.cast("double")
        elif isinstance(t, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        elif isinstance(t, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(t, T.DateType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.BooleanType):
            c = c.cast("boolean")
        cols.append(c.alias(field.name))
    return df.select(*cols)
