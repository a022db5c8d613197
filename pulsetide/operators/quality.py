"""Data-quality checks over the layers, as a table of one row per check."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetide.functions import present
from pulsetide.model import (
    HEART_RATE_HIGH,
    HEART_RATE_RANGE,
    MIN_STEPS,
    REQUIRED_COLUMNS,
    SPO2_LOW,
    SPO2_RANGE,
    VITALS,
)
from pulsetide.operators.series import union_all

CHECK_COLUMNS = (
    "layer string, check string, observed bigint, violations bigint, status string"
)


def row_rules() -> dict[str, dict[str, tuple[tuple[str, ...], Column]]]:
    """Per layer: check name, the columns it reads, and what every row must satisfy."""
    high = F.col("heart_rate") > HEART_RATE_HIGH
    low = F.col("spo2") < SPO2_LOW
    return {
        "bronze": {
            "no_null_keys": (
                ("user_id", "timestamp"),
                F.col("user_id").isNotNull() & F.col("timestamp").isNotNull(),
            ),
        },
        "silver": {
            "no_nulls": (
                VITALS,
                F.col("heart_rate").isNotNull()
                & F.col("steps").isNotNull()
                & present(F.col("spo2")),
            ),
            "range_heart_rate": (("heart_rate",), F.col("heart_rate").between(*HEART_RATE_RANGE)),
            "range_spo2": (("spo2",), F.col("spo2").between(*SPO2_RANGE)),
            "range_steps": (("steps",), F.col("steps") >= MIN_STEPS),
            # A flag needs a reason; a reason without a flag is not tested.
            "anomaly_flag": (
                ("is_anomaly", "heart_rate", "spo2"),
                ~F.coalesce("is_anomaly", F.lit(False))
                | F.coalesce(high, F.lit(False))
                | F.coalesce(low, F.lit(False)),
            ),
        },
        "gold": {},
    }


# Checks of a whole layer, in the order they are reported.
CHECKS = {
    "bronze": ("schema", "no_null_keys", "has_data"),
    "silver": (
        "schema",
        "no_nulls",
        "range_heart_rate",
        "range_spo2",
        "range_steps",
        "anomaly_flag",
    ),
    "gold": ("schema", "aggregation_exists", "user_coverage"),
}


def layer_checks(layer: str, frame: DataFrame) -> DataFrame:
    """All checks of one layer in one aggregation."""
    rules = row_rules()[layer]
    present_columns = set(frame.columns)
    missing = [name for name in REQUIRED_COLUMNS[layer] if name not in present_columns]
    testable = {
        name: rule for name, (needs, rule) in rules.items() if set(needs) <= present_columns
    }

    measures = [F.count("*").alias("row_count")]
    for name, rule in testable.items():
        measures.append(F.count_if(~F.coalesce(rule, F.lit(False))).alias(name))
    if layer == "gold" and "user_id" in present_columns:
        measures.append(F.count_distinct("user_id").alias("users"))
        # A missing id counts as one more user, as a set of ids would hold it.
        measures.append(F.max(F.col("user_id").isNull().cast("bigint")).alias("nameless"))

    def result(check: str, observed: Column, violations: Column) -> Column:
        failed = F.coalesce(violations > 0, F.lit(True))
        return F.struct(
            F.lit(layer).alias("layer"),
            F.lit(check).alias("check"),
            observed.cast("bigint").alias("observed"),
            violations.cast("bigint").alias("violations"),
            F.when(failed, "failed").otherwise("passed").alias("status"),
        )

    def some(count: Column) -> Column:
        return F.when(count > 0, 0).otherwise(1)

    rows = F.col("row_count")
    unknown = F.lit(None)
    results = []
    for check in CHECKS[layer]:
        if check == "schema":
            found = len(REQUIRED_COLUMNS[layer]) - len(missing)
            results.append(result(check, F.lit(found), F.lit(len(missing))))
        elif check in rules:
            results.append(result(check, rows, F.col(check) if check in testable else unknown))
        elif check == "user_coverage":
            if "user_id" in present_columns:
                users = F.col("users") + F.coalesce("nameless", F.lit(0))
                results.append(result(check, users, some(users)))
            else:
                results.append(result(check, rows, unknown))
        else:
            results.append(result(check, rows, some(rows)))
    return frame.agg(*measures).select(F.inline(F.array(*results)))


def skipped_checks(spark: SparkSession, layer: str) -> DataFrame:
    """The checks of an absent layer."""
    return spark.createDataFrame(
        [(layer, check, None, None, "skipped") for check in CHECKS[layer]], CHECK_COLUMNS
    )


def dq_checks(
    spark: SparkSession,
    bronze: DataFrame | None,
    silver: DataFrame | None,
    gold: DataFrame | None,
) -> DataFrame:
    """Every check of every layer: (layer, check, observed, violations, status).

    ``observed`` is what was looked at: columns found, rows, or distinct users.
    ``status`` is passed, failed (also when a column to test is missing) or skipped.
    """
    layers = {"bronze": bronze, "silver": silver, "gold": gold}
    return union_all(
        [
            skipped_checks(spark, name) if frame is None else layer_checks(name, frame)
            for name, frame in layers.items()
        ]
    )


def layer_row_counts(layers: dict[str, DataFrame]) -> DataFrame:
    """Rows per layer; on a Parquet layer the count needs the file footers only."""
    return union_all(
        [
            frame.agg(F.count("*").alias("row_count")).select(
                F.lit(name).alias("layer"), "row_count"
            )
            for name, frame in layers.items()
        ]
    )
