"""Kafka topics. Needs Spark's Kafka connector on the class path, which is a separate package."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from gradewise.sources.events import parse_events


def kafka_options(
    servers: str, topic: str, starting: str = "earliest", max_offsets: int | None = None,
    more: dict[str, str] | None = None,
) -> dict[str, str]:
    """Reader options. Spark gives every query a consumer group of its own and keeps the
    offsets in the query's checkpoint, so jobs read the topic independently.

    `more` holds any further ones, such as `kafka.security.protocol` or `minPartitions`."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if max_offsets is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets)
    return options | (more or {})


def kafka_events(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_offsets: int | None = None,
    more: dict[str, str] | None = None,
) -> DataFrame:
    """Loan events of a topic as a stream, with the broker's `timestamp` column."""
    options = kafka_options(servers, topic, starting, max_offsets, more)
    messages = spark.readStream.format("kafka").options(**options).load()
    return parse_events(messages, keep=("timestamp",))


def send_to_kafka(events: DataFrame, servers: str, topic: str, more: dict[str, str] | None = None) -> None:
    """Send `key`/`value` events; executors write their own partitions. `more` as in kafka_options."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic} | (more or {})
    events.write.format("kafka").options(**options).save()
