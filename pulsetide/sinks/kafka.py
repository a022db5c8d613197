"""Keyed JSON records for a Kafka topic."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.model import PAYLOAD, TOPIC


def encode_events(events: DataFrame) -> DataFrame:
    """(key, value): user id bytes and UTF-8 JSON; null fields are left out of the JSON."""
    return events.select(
        F.col("user_id").cast("binary").alias("key"),
        F.to_json(F.struct(*PAYLOAD.fieldNames())).cast("binary").alias("value"),
    )


def publish(events: DataFrame, brokers: str, topic: str = TOPIC, **options: str) -> None:
    """Append the events to a topic; needs the Kafka connector on the class path."""
    (
        encode_events(events)
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("topic", topic)
        .options(**options)
        .save()
    )
