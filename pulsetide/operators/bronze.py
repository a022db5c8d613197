"""Bronze: broker records to parsed events."""

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetide.functions import event_date, instant
from pulsetide.model import PAYLOAD


def to_bronze(records: DataFrame, ingested_at: Column | datetime | str | None = None) -> DataFrame:
    """Parse the JSON payload, keep partition and offset, stamp arrival, derive the date.

    A payload that cannot be parsed keeps its row, with every field null. Batch and
    streaming inputs are both fine. ``ingested_at`` is a time, or a column of the records
    (their broker time, say); without it the stamp is the time of the job or of the batch.
    """
    # inline() and not select("data.*"): later filters on the fields would otherwise be
    # pushed below the projection and repeat from_json once per predicate.
    payload = F.from_json(F.col("value").cast("string"), PAYLOAD)
    return (
        records.select("partition", "offset", instant(ingested_at).alias("__stamp"), F.inline(F.array(payload)))
        .select(
            *PAYLOAD.fieldNames(),
            F.col("partition").alias("kafka_partition"),
            F.col("offset").alias("kafka_offset"),
            F.col("__stamp").alias("ingestion_timestamp"),
        )
        .withColumn("date", event_date("timestamp"))
    )


def count_by_date(bronze: DataFrame) -> DataFrame:
    """Rows and parsed rows per event date; rows without a date form a group of their own."""
    return bronze.groupBy("date").agg(
        F.count("*").alias("row_count"),
        F.count("user_id").alias("parsed_count"),
    )
