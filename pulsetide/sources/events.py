"""Telemetry tables derived from the sample ``events`` and ``customer`` tables."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetide.functions import iso_text, padded_user_id
from pulsetide.model import TOPIC


def sample_user_id(number: Column) -> Column:
    """Id of a user of the sample tables."""
    return padded_user_id(number, digits=4)


def readings(events: DataFrame) -> DataFrame:
    """One device reading per event, faulty ones included; a fixed rule of id and value."""
    number = F.col("event_id")

    def tenths(base: int, spread: int) -> Column:
        return (base + number % spread) / F.lit(10.0)

    return events.select(
        sample_user_id(F.col("user_id")).alias("user_id"),
        iso_text(F.col("ts")).alias("timestamp"),
        F.when(number % 37 != 0, 40 + F.floor("value") % 230).cast("int").alias("heart_rate"),
        F.when(number % 41 == 0, -1).otherwise(number % 51).cast("int").alias("steps"),
        F.when(number % 97 == 0, 65.0)
        .when(number % 20 == 7, tenths(880, 31))
        .otherwise(tenths(940, 61))
        .alias("spo2"),
        "event_id",
        "ts",
    )


def kafka_records(events: DataFrame) -> DataFrame:
    """The readings as the Kafka source would deliver them; some payloads are not JSON."""
    number = F.col("event_id")
    payload = F.to_json(F.struct("user_id", "timestamp", "heart_rate", "steps", "spo2"))
    return readings(events).select(
        F.col("user_id").cast("binary").alias("key"),
        F.when(number % 101 == 0, "not json").otherwise(payload).cast("binary").alias("value"),
        F.lit(TOPIC).alias("topic"),
        (number % 3).cast("int").alias("partition"),
        F.floor(number / 3).alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


#: Steps in which the sample events arrive, and the end of their first half.
ARRIVALS = 6
HALF = "2024-01-16T12:34:56Z"


def arrivals(events: DataFrame) -> DataFrame:
    """Events with the step of their ``arrival``: a week a step, every seventh one step late."""
    week = F.floor((F.dayofmonth("ts") - 1) / 7).cast("int")
    return events.withColumn("arrival", week + F.when(F.col("event_id") % 7 == 3, 1).otherwise(0))


def halves(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events before and from ``HALF`` on."""
    early = F.col("ts").cast("timestamp") < F.lit(HALF).cast("timestamp")
    return events.filter(early), events.filter(~early)


def summary_requests(events: DataFrame, customers: DataFrame) -> DataFrame:
    """Requests for summaries: one per event and one per customer.

    Customers reach beyond the users with events, and one event type and one market
    segment ask for a metric that does not exist.
    """

    def metric(column: str, names: dict[str, str]) -> Column:
        chosen = F.lit("glucose")
        for value, name in names.items():
            chosen = F.when(F.col(column) == value, name).otherwise(chosen)
        return chosen.alias("metric_name")

    by_event = events.select(
        F.concat(F.lit("e"), F.col("event_id")).alias("request_id"),
        sample_user_id(F.col("user_id")).alias("user_id"),
        metric(
            "event_type",
            {"click": "heart_rate", "view": "steps", "purchase": "spo2", "signup": "spo2"},
        ),
    )
    by_customer = customers.select(
        F.concat(F.lit("c"), F.col("c_custkey")).alias("request_id"),
        sample_user_id(F.col("c_custkey")).alias("user_id"),
        metric(
            "c_mktsegment",
            {
                "BUILDING": "heart_rate",
                "AUTOMOBILE": "steps",
                "MACHINERY": "spo2",
                "HOUSEHOLD": "heart_rate",
            },
        ),
    )
    return by_event.unionByName(by_customer)
