"""Schemas of the layers, and the fixed values of the telemetry model."""

from pyspark.sql import types as T

# --- Schemas -----------------------------------------------------------------

PAYLOAD = (
    T.StructType()
    .add("user_id", T.StringType())
    .add("timestamp", T.StringType())
    .add("heart_rate", T.IntegerType())
    .add("steps", T.IntegerType())
    .add("spo2", T.DoubleType())
)

BRONZE = (
    T.StructType(list(PAYLOAD.fields))
    .add("kafka_partition", T.IntegerType())
    .add("kafka_offset", T.LongType())
    .add("ingestion_timestamp", T.TimestampType())
    .add("date", T.DateType())
)

SILVER = T.StructType(list(BRONZE.fields)).add("is_anomaly", T.BooleanType())

GOLD = (
    T.StructType()
    .add("user_id", T.StringType())
    .add("avg_heart_rate", T.DoubleType())
    .add("avg_spo2", T.DoubleType())
    .add("total_steps", T.LongType())
    .add("event_count", T.LongType())
    .add("window_start", T.TimestampType())
    .add("window_end", T.TimestampType())
    .add("date", T.DateType())
)
LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD}

# --- Fixed values: what a valid vital is, and what counts as an anomaly --------

VITALS = ("heart_rate", "steps", "spo2")
HEART_RATE_RANGE = (30, 220)
SPO2_RANGE = (70.0, 100.0)
MIN_STEPS = 0
HEART_RATE_HIGH = 130
SPO2_LOW = 92.0

# --- Fixed values: windows, triggers and stream names --------------------------

WINDOW = "1 hour"
WATERMARK = "15 minutes"
LOOK_BACK_HOURS = 24
TOPIC = "health-events"
TRIGGERS = {"bronze": "30 seconds", "silver": "60 seconds", "gold": "60 seconds"}
STREAM_NAMES = {
    "bronze": "bronze_health_events",
    "silver": "silver_health_events",
    "gold": "gold_health_agg",
}

# --- Fixed values: metrics and where an hourly table keeps them -----------------

METRICS = ("heart_rate", "steps", "spo2")
METRIC_COLUMNS = {
    "heart_rate": "avg_heart_rate",
    "spo2": "avg_spo2",
    "steps": "total_steps",
}
TIME_COLUMNS = ("window_end", "window_start", "timestamp", "event_time")
VALUE_COLUMNS = ("avg", "mean", "value", "avg_value")

# --- Fixed values: trend -------------------------------------------------------

TREND_THRESHOLD = 0.05
TREND_EPSILON = 1e-9

# --- Fixed values: texts shown next to a metric --------------------------------

BASELINES = {
    "heart_rate": (
        "Normal resting heart rate: 60-100 bpm. Below 60 may indicate bradycardia; "
        "above 100 may indicate tachycardia."
    ),
    "spo2": (
        "Normal SpO2: 95-100%. Below 95% may indicate hypoxemia and warrants medical attention."
    ),
    "steps": (
        "Recommended daily steps: 8,000-10,000. Fewer than 5,000 is considered sedentary."
    ),
}
NO_BASELINE = "No specific baseline available."

STATISTICS = ("min", "max", "avg", "latest", "trend", "window_count")
STATISTIC_LABELS = {
    "min": "Minimum",
    "max": "Maximum",
    "avg": "Average",
    "latest": "Latest",
    "trend": "Trend",
}
USER_LABEL_PREFIX = "Patient "
USER_ID_PREFIX = "user_"

# --- Fixed values: columns each layer must have --------------------------------

REQUIRED_COLUMNS = {
    "bronze": (
        "user_id",
        "timestamp",
        "heart_rate",
        "steps",
        "spo2",
        "kafka_partition",
        "kafka_offset",
        "ingestion_timestamp",
    ),
    "silver": ("user_id", "timestamp", "heart_rate", "steps", "spo2", "is_anomaly"),
    "gold": (
        "user_id",
        "avg_heart_rate",
        "avg_spo2",
        "total_steps",
        "event_count",
        "window_start",
        "window_end",
    ),
}
