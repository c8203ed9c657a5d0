"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Also lets Python workers import this package in a
    local session (on a cluster it is installed or sent with --py-files)."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows and bytes of one Arrow batch, so that a batch of long documents stays small.
ARROW_BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
               "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20)}


def ship(spark: SparkSession) -> None:
    for key, value in ARROW_BATCH.items():
        if spark.conf.get(key, None) is None:       # a session's own setting stays
            spark.conf.set(key, value)
    env = spark.sparkContext.environment
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if PACKAGE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([p for p in paths if p] + [PACKAGE_ROOT])


def staged(spark: SparkSession, df: DataFrame, name: str, **options) -> DataFrame:
    """Write `df` under the shared checkpoint folder and read it back: later steps
    start from files that every executor sees, also after one is lost. `options` are the writer's."""
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """What is written here leaves no shuffle files; else they stay until the driver collects its garbage."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def filled_text(column: str = "text"):
    """The text column with null read as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def blocks(texts: list[str], chars: int):
    """Consecutive texts of about so many characters together; one text is never cut."""
    block: list[str] = []
    size = 0
    for text in texts:
        block.append(text)
        size += len(text)
        if size >= chars:
            yield block
            block, size = [], 0
    if block:
        yield block


_KEPT: dict = {}


def kept(name, make):
    """What a worker process keeps from task to task. It keeps one thing at a time: a worker that
    turns to another operator lets go of the caches of the one before."""
    if name not in _KEPT:
        _KEPT.clear()
        _KEPT[name] = make()
    return _KEPT[name]
