"""The registered queries: every operator over the whole sample tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetide.model import GOLD, SILVER, STREAM_NAMES, WATERMARK
from pulsetide.operators.bronze import count_by_date, to_bronze
from pulsetide.operators.gold import hourly, union_by_name
from pulsetide.operators.quality import dq_checks, layer_row_counts
from pulsetide.operators.reports import (
    advice_prompts,
    metric_catalog,
    summary_rows,
    user_labels,
    with_baseline,
)
from pulsetide.operators.requests import answer_requests
from pulsetide.operators.series import available_users, recent, to_long, user_history
from pulsetide.operators.silver import anomalies, to_silver
from pulsetide.operators.summary import summarise
from pulsetide.plans import runs
from pulsetide.session import scratch_path, use_utc
from pulsetide.sinks.kafka import encode_events
from pulsetide.sinks.layers import append_stream, overwrite_layer
from pulsetide.sources.events import kafka_records, readings, summary_requests
from pulsetide.sources.layers import read_layer, stream_layer
from pulsetide.streaming.jobs import start_bronze, start_gold, start_silver

# The sample events end in January 2024, so "now" is the end of that month's last full day.
AS_OF = "2024-01-31T00:00:00Z"
HISTORY_USER = "user_0007"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the sample tables."""
    return use_utc(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze of the sample events."""
    return to_bronze(kafka_records(table(spark, sf_dir, "events")))


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver of the sample events."""
    return to_silver(bronze(spark, sf_dir))


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of the sample events."""
    return hourly(silver(spark, sf_dir))


def plain_times(frame: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, which compare the same in any zone."""
    return frame.withColumns(
        {
            name: F.col(name).cast("timestamp_ntz")
            for name, kind in frame.dtypes
            if kind == "timestamp"
        }
    )


def bronze_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bronze(spark, sf_dir).drop("ingestion_timestamp", "date")


def bronze_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by_date(bronze(spark, sf_dir))


def silver_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).drop("ingestion_timestamp")


def anomaly_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anomalies(silver(spark, sf_dir)).drop("ingestion_timestamp")


def event_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = encode_events(readings(table(spark, sf_dir, "events")))
    return records.select(*[F.col(name).cast("string") for name in ("key", "value")])


def gold_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(gold(spark, sf_dir))


def gold_batch_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "gold-batch")
    overwrite_layer(gold(spark, sf_dir), path, ("user_id", "window_start"))
    return plain_times(read_layer(spark, path))


def gold_hourly_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    silver_path = scratch_path(spark, "silver")
    gold_path = scratch_path(spark, "gold-stream")
    overwrite_layer(silver(spark, sf_dir), silver_path)
    stream = hourly(stream_layer(spark, silver_path, SILVER), WATERMARK)
    append_stream(
        stream, gold_path, scratch_path(spark, "checkpoint"), STREAM_NAMES["gold"]
    ).awaitTermination()
    return plain_times(read_layer(spark, gold_path, GOLD))


def three_layer_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A backlog of broker records, in more files than there are cores, through all layers."""
    root = scratch_path(spark, "layers")
    files = 2 * spark.sparkContext.defaultParallelism
    records = kafka_records(table(spark, sf_dir, "events"))
    records.repartition(files, "offset").write.parquet(f"{root}/topic")
    start_bronze(spark.readStream.schema(records.schema).parquet(f"{root}/topic"), root).awaitTermination()
    start_silver(spark, root).awaitTermination()
    start_gold(spark, root).awaitTermination()
    # The rows of a window come from many files, so the last digit of a mean depends on order.
    means = {name: F.round(name, 6) for name in ("avg_heart_rate", "avg_spo2")}
    return plain_times(read_layer(spark, f"{root}/gold", GOLD)).withColumns(means)


def gold_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold written as a layer and read back."""
    path = scratch_path(spark, "gold-layer")
    overwrite_layer(gold(spark, sf_dir), path, ("user_id", "window_start"))
    return read_layer(spark, path)


def recent_windows_layer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(recent(gold_layer(spark, sf_dir), AS_OF))


def user_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    layer = gold_layer(spark, sf_dir)
    asked = requests(spark, sf_dir).filter(F.col("user_id") == HISTORY_USER)
    answered = answer_requests(asked, layer, AS_OF, users=[HISTORY_USER])
    return answered.select("request_id", "user_id", "metric_name", "status", "data_summary.*")


def gold_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(to_long(gold(spark, sf_dir)))


def gold_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = gold(spark, sf_dir)
    rows = to_long(wide).withColumnRenamed("time", "window_end")
    return plain_times(union_by_name(wide, rows))


def recent_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(recent(gold(spark, sf_dir), AS_OF))


def user_metric_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summarise(gold(spark, sf_dir), AS_OF)


def long_layout_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = to_long(gold(spark, sf_dir)).withColumnRenamed("time", "event_time")
    return summarise(rows, AS_OF)


def latest_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_metric_summary(spark, sf_dir).select("user_id", "metric_name", "latest")


def metric_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The whole month and not one day, so that the series are long.
    return summarise(gold(spark, sf_dir), AS_OF, hours=24 * 31).select(
        "user_id", "metric_name", "trend", "window_count"
    )


def available_users_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return available_users(gold(spark, sf_dir))


def user_history_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain_times(user_history(gold(spark, sf_dir), HISTORY_USER))


def metric_catalog_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_catalog(gold(spark, sf_dir))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests for summaries derived from the sample tables."""
    return summary_requests(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"))


def answer_requests_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    answered = answer_requests(requests(spark, sf_dir), gold(spark, sf_dir), AS_OF)
    return answered.select("request_id", "user_id", "metric_name", "status", "data_summary.*")


def baseline_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_baseline(requests(spark, sf_dir))


def advice_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = advice_prompts(user_metric_summary(spark, sf_dir))
    return records.select("user_id", "metric_name", "data_summary.*", "prompt")


def summary_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summary_rows(user_metric_summary(spark, sf_dir))


def user_label_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_labels(available_users(gold(spark, sf_dir)))


def dq_checks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq_checks(
        spark, bronze(spark, sf_dir), silver(spark, sf_dir), gold(spark, sf_dir)
    )


def layer_row_counts_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layer_row_counts(
        {
            "bronze": bronze(spark, sf_dir),
            "silver": silver(spark, sf_dir),
            "gold": gold(spark, sf_dir),
        }
    )


def stream_run(run: Callable[[SparkSession, str], DataFrame], *means: str) -> Callable[[SparkSession, str], DataFrame]:
    """A run of streams as a query; means of windows whose rows come in any order are rounded."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        frame = plain_times(run(spark, sf_dir))
        return frame.withColumns({name: F.round(name, 6) for name in means}) if means else frame

    return query


MEANS = ("avg_heart_rate", "avg_spo2")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "gold_hourly": gold_hourly,
    "bronze_parse": bronze_parse,
    "bronze_by_date": bronze_by_date,
    "silver_clean": silver_clean,
    "anomaly_rows": anomaly_rows,
    "event_encode": event_encode,
    "gold_batch_roundtrip": gold_batch_roundtrip,
    "gold_hourly_stream": gold_hourly_stream,
    "three_layer_stream": three_layer_stream,
    "recent_windows_layer": recent_windows_layer,
    "user_summary": user_summary,
    "gold_long": gold_long,
    "gold_union": gold_union,
    "recent_windows": recent_windows,
    "user_history": user_history_query,
    "available_users": available_users_query,
    "user_metric_summary": user_metric_summary,
    "long_layout_summary": long_layout_summary,
    "latest_value": latest_value,
    "metric_trend": metric_trend,
    "metric_catalog": metric_catalog_query,
    "answer_requests": answer_requests_query,
    "baseline_lookup": baseline_lookup,
    "advice_prompt": advice_prompt,
    "summary_rows": summary_rows_query,
    "user_label": user_label_query,
    "dq_checks": dq_checks_query,
    "layer_row_counts": layer_row_counts_query,
    "late_rows": stream_run(runs.late_rows),
    "late_gold": stream_run(runs.late_gold, *MEANS),
    "trigger_batches": stream_run(runs.trigger_batches),
    "restart_no_dupes": stream_run(runs.restart_no_dupes, *MEANS),
    "file_count": stream_run(runs.file_count),
    "stream_row_counts": stream_run(runs.stream_row_counts),
    "bronze_stamped": stream_run(runs.bronze_stamped),
    "layer_codecs": runs.layer_codecs,
    "corrupt_file_skip": lambda spark, sf_dir: runs.corrupt_file_skip(spark, sf_dir).drop("ingestion_timestamp"),
}
