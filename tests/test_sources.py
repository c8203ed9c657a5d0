"""Connector option builders (no broker or database runs in tests)."""

import pytest

from basketlens.sources.tables import jdbc_options
from basketlens.streaming import ingest


def test_kafka_source_subscribes_to_the_three_topics_at_latest():
    opts = ingest.kafka_source_options("broker:9092")
    assert opts["subscribe"] == "user_events,product_events,order_events"
    assert opts["startingOffsets"] == "latest"
    assert opts["kafka.bootstrap.servers"] == "broker:9092"
    one = ingest.kafka_source_options("b:1", ["order_events"], max_offsets_per_trigger=1000)
    assert one["subscribe"] == "order_events" and one["maxOffsetsPerTrigger"] == "1000"


def test_jdbc_read_is_partitioned_and_needs_bounds():
    opts = jdbc_options("jdbc:postgresql://db/shop", "orders", "id", 1, 1_000_000,
                        num_partitions=200)
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "200"
    assert opts["lowerBound"] == "1" and opts["upperBound"] == "1000000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://db/shop", "orders", "id")
