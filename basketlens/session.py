"""Session settings shared by tests, the bench and the entry point."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on. NTZ timestamps carry no zone, but UTC keeps
# any zoned conversion (e.g. localtimestamp) independent of the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}


#: Shuffles start with many partitions and adaptive execution joins them up to the advisory size: the
#: number of tasks follows the rows, so that a task's sorts and hash tables do not grow with the input.
FOLLOW_SIZE = {"spark.sql.adaptive.coalescePartitions.initialPartitionNum": "1024",
               "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m"}


def follow_size(spark: SparkSession) -> None:
    for key, value in FOLLOW_SIZE.items():
        if spark.conf.get(key, None) is None:       # a session's own setting stays
            spark.conf.set(key, value)


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "basketlens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    sc = _context(spark)
    if sc is not None:
        sc.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _context(spark: SparkSession):
    """The driver-side SparkContext, or None on a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect has no driver-side context
        return None


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``."""
    sc = _context(spark)
    if sc is None:
        return spark.conf.get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    return sc.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the session's checkpoint folder; set one only where none is set.

    On a cluster the folder comes from the session (shared storage). Only a
    local test session without one gets a scratch folder.
    """
    current = checkpoint_dir(spark)
    if current:
        return current
    sc = _context(spark)
    if sc is None or not (fallback or sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a shared folder on the cluster")
    path = fallback or tempfile.mkdtemp(prefix="basketlens-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A unique sub-folder of the shared checkpoint folder for staged tables."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([base, *parts, uuid.uuid4().hex])
