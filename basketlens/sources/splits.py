"""Predicates that cut a database read into even parts for any key type.

Spark's own partitioned read needs a numeric or time column and cuts its range into equal widths; text keys,
skewed keys and NULLs are left out or pile up. Here the cuts are quantiles of a bounded sample, so parts
hold about the same number of rows. The sample only decides how even the parts are: the predicates cover
every row exactly once, whatever the table holds, NULL keys included.
"""

from __future__ import annotations

import datetime as dt
import decimal
from bisect import bisect_left

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of the sample that decide the cuts.
SAMPLE_ROWS = 100_000


def literal(value) -> str:
    """A standard SQL literal."""
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, (int, decimal.Decimal)):
        return str(value)
    if isinstance(value, float):
        if value != value or value in (float("inf"), float("-inf")):
            raise ValueError("a key without an order cannot be cut")
        return repr(value)
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    return "'" + str(value).replace("'", "''") + "'"


def _ranges(column: str, cuts: list) -> list[str]:
    """Half-open ranges between the cuts, open at both ends: each non-NULL value is in one of them."""
    if not cuts:
        return [f"{column} IS NOT NULL"]
    inner = [f"{column} >= {literal(a)} AND {column} < {literal(b)}" for a, b in zip(cuts, cuts[1:])]
    return [f"{column} < {literal(cuts[0])}", *inner, f"{column} >= {literal(cuts[-1])}"]


def _cuts(values: list, parts: int) -> list:
    """Different values at the ``parts``-quantiles of sorted ``values``; the smallest cuts nothing off."""
    at = {values[len(values) * k // parts] for k in range(1, parts)} if values else set()
    return sorted(v for v in at if v > values[0])


def split_predicates(sample: list[tuple], column: str, parts: int, then: str | None = None) -> list[str]:
    """Predicates over ``column`` that cover every row once, even in the sample's view.

    ``sample``: (key, second) pairs, NULLs allowed. A key that holds more than a part's share gets predicates
    of its own, cut by ``then``, a second column (for instance the primary key), where one is named; the same
    goes for rows without a key. A text column must be compared as the sample is sorted, by code
    points: in PostgreSQL pass ``column='name COLLATE "C"'``.
    """
    if parts < 1:
        raise ValueError("at least one part")
    sample = [(k, s) for k, s in sample if k == k and s == s]      # a NaN has no place in an order
    share = max(1.0, len(sample) / parts)

    def of_one(condition: str, seconds: list) -> list[str]:
        wanted = min(parts, round(len(seconds) / share))
        if then is None or wanted < 2:
            return [condition]
        cuts = _cuts(sorted(s for s in seconds if s is not None), wanted)
        if not cuts:
            return [condition]
        return [f"{condition} AND {r}" for r in [*_ranges(then, cuts), f"{then} IS NULL"]]

    keys = sorted(k for k, _ in sample if k is not None)
    empty = [s for k, s in sample if k is None]
    hot = []
    if keys:
        seconds: dict = {}
        for k, s in sample:
            if k is not None:
                seconds.setdefault(k, []).append(s)
        hot = sorted(k for k, s in seconds.items() if len(s) > share)
    out: list[str] = []
    # The stretches between hot keys are cut on their own, so a hot key never shares a part with others.
    low, start = None, 0
    for edge in [*hot, None]:
        stop = len(keys) if edge is None else bisect_left(keys, edge)
        stretch = keys[start:stop]
        cuts = _cuts(stretch, max(1, round(len(stretch) / share)))
        bounds = [f"{column} > {literal(low)}"] if low is not None else []
        bounds += [f"{column} < {literal(edge)}"] if edge is not None else []
        out += [" AND ".join([*bounds, r]) for r in _ranges(column, cuts)]
        if edge is not None:
            out += of_one(f"{column} = {literal(edge)}", seconds[edge])
            low, start = edge, stop + len(seconds[edge])
    return [*out, *of_one(f"{column} IS NULL", empty)]


def sample_keys(df: DataFrame, column: str, then: str | None = None, rows: int = SAMPLE_ROWS,
                fraction: float | None = None) -> list[tuple]:
    """At most ``rows`` (key, second) pairs of ``df`` for ``split_predicates``, drawn with the smallest random
    numbers of a fixed seed: the one bounded collection of this module."""
    picked = df if fraction is None else df.sample(fraction, seed=1)
    pairs = picked.select(F.col(column).alias("k"), (F.col(then) if then else F.lit(None)).alias("s"),
                          F.rand(1).alias("r")).orderBy("r").limit(rows)
    return [(r["k"], r["s"]) for r in pairs.select("k", "s").collect()]


def read_jdbc_split(spark: SparkSession, url: str, table: str, predicates: list[str],
                    fetch_size: int = 10_000, **properties: str) -> DataFrame:
    """One task and one query per predicate (needs the database's driver on the classpath)."""
    return spark.read.jdbc(url, table, predicates=predicates,
                           properties={"fetchsize": str(fetch_size), **{k: str(v) for k, v in properties.items()}})
