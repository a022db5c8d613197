"""Kafka source."""

from pyspark.sql import DataFrame, SparkSession

from pulsetide.model import TOPIC


def kafka_source(
    spark: SparkSession,
    brokers: str,
    topic: str = TOPIC,
    starting_offsets: str = "earliest",
    fail_on_data_loss: bool = False,
    **options: str,
) -> DataFrame:
    """Stream of a topic's records.

    Needs the Kafka connector on the class path (``session.KAFKA_PACKAGE``). ``options``
    go to the connector as they are, for example ``maxOffsetsPerTrigger`` to bound the
    first batch of a long topic, or ``minPartitions`` to read with more tasks than the
    topic has partitions.
    """
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
        .option("failOnDataLoss", str(fail_on_data_loss).lower())
        .options(**options)
        .load()
    )
