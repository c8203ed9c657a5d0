"""The ingest as Structured Streaming queries, plus the Kafka source and
sink option builders (S1, K8) and the batch compaction of landed days (K4).

Each query parses a message once: a micro-batch is decoded, tagged and kept while its good rows go
to their event tables and its bad ones to the dead letter. What a batch wrote counts from its
entry in the ingest log on. A batch stopped before that is run again by Spark with the same number
and the same messages and writes the same folders anew, so every message is stored exactly once.
Readers use ``read_landed``, which honours the log. Offsets live in the checkpoints, not in a
consumer group; a checkpoint belongs to its output, so start over with a new checkpoint root.

No Kafka connector jar ships with PySpark here, so tests drive the same
queries from the file stream source with the same columns.
"""

from __future__ import annotations

import zlib

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..sinks.versions import read_if_there
from . import events

DEAD_LETTER = "dead_letter"
LOG = "ingest_log"
LOG_SCHEMA = T.StructType([
    T.StructField("ingest", T.StringType()), T.StructField("batch_id", T.LongType()),
    T.StructField("table", T.StringType()), T.StructField("n_rows", T.LongType())])


def kafka_source_options(bootstrap_servers: str, topics: list[str] | None = None,
                         starting_offsets: str = "latest",
                         max_offsets_per_trigger: int | None = None) -> dict[str, str]:
    """Subscribe to the three topics, starting at the latest offsets."""
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": ",".join(topics or events.TOPIC_NAMES),
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def kafka_sink_options(bootstrap_servers: str) -> dict[str, str]:
    """K8: publish ``(topic, key, value)`` rows; the topic comes from the row."""
    return {"kafka.bootstrap.servers": bootstrap_servers}


def read_kafka_stream(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """The raw stream ``(topic, key, value, timestamp)`` from Kafka (needs the
    spark-sql-kafka connector on the classpath)."""
    raw = spark.readStream.format("kafka").options(**options).load()
    return raw.select("topic", F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      F.col("timestamp").cast("timestamp_ntz").alias("timestamp"))


def read_file_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                     fmt: str = "parquet") -> DataFrame:
    """The same raw stream from landed files (tests, replays)."""
    reader = spark.readStream.schema(schemas.RAW_EVENT).format(fmt)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path)


def publish(envelopes: DataFrame, bootstrap_servers: str) -> None:
    """K8, batch: write envelopes to their topics."""
    (envelopes.select("topic", "key", "value").write.format("kafka")
     .options(**kafka_sink_options(bootstrap_servers)).save())


def _log(spark: SparkSession, out_dir: str) -> DataFrame | None:
    return read_if_there(spark, f"{out_dir}/{LOG}", LOG_SCHEMA)


def ingest_name(checkpoint: str) -> str:
    """The folder name of a query's output: its checkpoint's path as a number, since batch numbers count
    within one checkpoint."""
    return f"{zlib.crc32(checkpoint.encode()):08x}"


def _record(spark: SparkSession, out_dir: str, ingest: str, batch_id: int,
            counts: dict[str, int]) -> None:
    """The batch's log entry: one file, so it is there or not."""
    rows = [(ingest, batch_id, table, n) for table, n in sorted(counts.items())]
    entry = ", ".join(f"('{i}', {b}L, '{t}', {n}L)" for i, b, t, n in rows)
    (spark.sql(f"SELECT * FROM VALUES {entry} AS t(ingest, batch_id, `table`, n_rows)").coalesce(1)
     .write.mode("append").parquet(f"{out_dir}/{LOG}"))


def _store_batch(batch: DataFrame, batch_id: int, topics: list[str], dead_letter: str, out_dir: str,
                 ingest: str) -> None:
    """Parse a micro-batch once and store it under its number. The number of writing tasks follows the
    rows: days are rebalanced by size, a large day over several tasks, small ones together."""
    spark = batch.sparkSession
    log = _log(spark, out_dir)
    done = (F.col("ingest") == ingest) & (F.col("batch_id") == batch_id)
    if log is not None and not log.filter(done).isEmpty():
        return
    routed = events.routed(batch, topics).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r["destination"]: r["n"] for r in routed.groupBy("destination").agg(
            F.count(F.lit(1)).alias("n")).collect()}
        for table in [*topics, DEAD_LETTER]:
            if not counts.get(table):
                continue
            name = dead_letter if table == DEAD_LETTER else table
            columns = [f"{DEAD_LETTER}.*"] if table == DEAD_LETTER else events.stored_columns(table)
            rows = routed.filter(F.col("destination") == table).select(*columns)
            (rows.withColumn("event_date", F.to_date("timestamp")).hint("rebalance", F.col("event_date"))
             .write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("event_date")
             .parquet(f"{out_dir}/{name}/ingest={ingest}/batch_id={batch_id}"))
        named = {dead_letter if t == DEAD_LETTER else t: counts.get(t, 0) for t in [*topics, DEAD_LETTER]}
        _record(spark, out_dir, ingest, batch_id, named)
    finally:
        routed.unpersist()


def _start(raw: DataFrame, name: str, topics: list[str], dead_letter: str, out_dir: str,
           checkpoint_root: str, available_now: bool, processing_time: str | None) -> StreamingQuery:
    checkpoint = f"{checkpoint_root}/{name}"
    ingest = ingest_name(checkpoint)

    def store(batch: DataFrame, batch_id: int) -> None:
        _store_batch(batch, batch_id, topics, dead_letter, out_dir, ingest)
    writer = (raw.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
              .queryName(f"ingest_{name}"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time is not None:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def start_ingest(raw: DataFrame, out_dir: str, checkpoint_root: str,
                 available_now: bool = False,
                 processing_time: str | None = None) -> dict[str, StreamingQuery]:
    """Start the ingest of one raw stream of all topics: one query, one parse per message.

    ``out_dir/<table>`` receives the events and ``out_dir/dead_letter`` the bad messages, in a folder per
    batch and day; ``checkpoint_root/all`` holds the offsets.
    """
    out_dir, checkpoint_root = out_dir.rstrip("/"), checkpoint_root.rstrip("/")
    return {"all": _start(raw, "all", events.TOPIC_NAMES, DEAD_LETTER, out_dir, checkpoint_root,
                          available_now, processing_time)}


def start_topic_ingest(read_topic, out_dir: str, checkpoint_root: str,
                       available_now: bool = False,
                       processing_time: str | None = None) -> dict[str, StreamingQuery]:
    """Per-topic variant of ``start_ingest`` for a broker source.

    ``read_topic(topic)`` returns the raw stream of one topic (for Kafka,
    ``read_kafka_stream(spark, kafka_source_options(servers, [topic]))``). Each
    topic has one query with its table and its dead-letter folder
    ``dead_letter_<topic>``, so every message is read and parsed once.
    """
    out_dir, checkpoint_root = out_dir.rstrip("/"), checkpoint_root.rstrip("/")
    return {topic: _start(read_topic(topic), topic, [topic], f"{DEAD_LETTER}_{topic}", out_dir,
                          checkpoint_root, available_now, processing_time)
            for topic in events.TOPIC_NAMES}


def read_landed(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    return landed_days(spark, out_dir, name).drop("event_date")


def landed_days(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    """Landed rows with their ``event_date`` folder: those of logged batches. Without a log, all rows there
    are (a folder that another job wrote)."""
    out_dir = out_dir.rstrip("/")
    schema = schemas.DEAD_LETTER if name.startswith(DEAD_LETTER) else schemas.TOPICS[name][1]
    dated = T.StructType([*schema.fields, T.StructField("event_date", T.DateType())])
    log = _log(spark, out_dir)
    if log is None:
        return spark.read.schema(dated).parquet(f"{out_dir}/{name}")
    stored = T.StructType([*dated.fields, T.StructField("ingest", T.StringType()),
                           T.StructField("batch_id", T.LongType())])
    # The logged folders by name, one per micro-batch: unfinished ones are not even listed.
    found = (log.filter((F.col("table") == name) & (F.col("n_rows") > 0)).select("ingest", "batch_id")
             .distinct().orderBy("ingest", "batch_id").collect())
    if not found:
        return spark.createDataFrame([], dated)
    root = f"{out_dir}/{name}"
    rows = spark.read.schema(stored).option("basePath", root).parquet(
        *[f"{root}/ingest={r['ingest']}/batch_id={r['batch_id']}" for r in found])
    return rows.select(*dated.names)


def compact_events(spark: SparkSession, landed_dir: str, table_dir: str, topic: str,
                   day=None) -> None:
    """K4: rewrite landed rows of ``topic`` (one day, or all) into the event
    table, partitioned by ``event_date`` and sorted by (timestamp, entity id)
    inside each file, with Bloom filters on the ids (``events.event_file_options``). Only the
    days written are replaced (dynamic partition overwrite), so rerunning a day is idempotent."""
    landed = landed_days(spark, landed_dir, topic)
    if day is not None:
        landed = landed.filter(F.col("event_date") == F.lit(str(day)).cast("date"))
    laid_out = events.event_layout(landed.drop("event_date"), topic)
    (laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .options(**events.event_file_options(topic)).partitionBy("event_date").parquet(f"{table_dir.rstrip('/')}/{topic}"))
