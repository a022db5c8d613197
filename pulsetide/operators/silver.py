"""Silver: complete, plausible readings with an anomaly flag."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetide.model import (
    HEART_RATE_HIGH,
    HEART_RATE_RANGE,
    MIN_STEPS,
    SPO2_LOW,
    SPO2_RANGE,
    VITALS,
)


def to_silver(bronze: DataFrame) -> DataFrame:
    """Drop rows lacking a vital or out of range, and flag anomalies.

    Only vitals are checked: a row without user id or time stays.
    """
    plausible = (
        F.col("heart_rate").between(*HEART_RATE_RANGE)
        & F.col("spo2").between(*SPO2_RANGE)
        & (F.col("steps") >= MIN_STEPS)
    )
    return (
        bronze.dropna(subset=list(VITALS))
        .filter(plausible)
        .withColumn(
            "is_anomaly",
            (F.col("heart_rate") > HEART_RATE_HIGH) | (F.col("spo2") < SPO2_LOW),
        )
    )


def anomalies(silver: DataFrame) -> DataFrame:
    """The flagged rows."""
    return silver.filter("is_anomaly")
