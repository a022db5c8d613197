"""Requests: a table of (user, metric) questions answered with a summary or a reason."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetide.model import METRIC_COLUMNS, METRICS, STATISTICS
from pulsetide.operators.series import is_hourly, recent, to_long, value_columns
from pulsetide.operators.summary import hourly_statistics, shown_statistics, summarise

SUMMARY_TYPE = (
    "struct<min: double, max: double, avg: double, latest: double, trend: string, "
    "window_count: bigint>"
)

# A user with more than one in HOT_USERS of all requests is hot. There are fewer than
# HOT_USERS such users, so their list is broadcast, and each is spread over SPREAD join keys.
HOT_USERS = 1_000
SPREAD = 64


def known_users(table: DataFrame) -> DataFrame:
    """Every user of the table, of any time, with the metrics they have rows for."""
    columns = value_columns(table)
    if set(columns) == set(METRICS):
        users = table.select("user_id").dropna().distinct()
        return users.withColumn("known_metrics", F.array(*map(F.lit, METRICS)))
    # At most one entry per metric, so the set stays small.
    return (
        to_long(table)
        .dropna(subset=["user_id"])
        .groupBy("user_id")
        .agg(
            F.collect_set(
                F.when(F.col("metric_name").isin(*METRICS), F.col("metric_name"))
            ).alias("known_metrics")
        )
    )


def answers(table: DataFrame, as_of: Column | datetime | str | None) -> DataFrame:
    """One row per user of the table and metric, with the summary where there is one.

    Of an hourly table the whole history gives its user ids alone, one column; values are read
    from the dates of the look-back. Both meet in one aggregate, whose partial step leaves one
    row per user and task of the history, which says the user is known.
    """
    statistics = F.struct(*STATISTICS).alias("data_summary")
    if is_hourly(table):
        columns = ["user_id", "window_start", "window_end", *METRIC_COLUMNS.values()]
        values = recent(table, as_of).select(*columns)
        users = table.select("user_id").select(
            "user_id", *[F.lit(None).cast(values.schema[c].dataType).alias(c) for c in columns[1:]]
        )
        known = values.union(users).filter(F.col("user_id").isNotNull())
        shown = shown_statistics(hourly_statistics(known, METRICS, fold_first=True))
        return shown.select(
            "user_id",
            "metric_name",
            F.lit(True).alias("has_metric"),
            F.when(F.col("window_count") > 0, statistics).alias("data_summary"),
        )
    summaries = (
        summarise(table, as_of)
        .filter(F.col("metric_name").isin(*METRICS))
        .groupBy("user_id")
        .agg(F.map_from_entries(F.collect_list(F.struct("metric_name", statistics))).alias("found"))
    )
    return (
        known_users(table)
        .join(summaries, "user_id", "left")
        .select(
            "user_id",
            "found",
            "known_metrics",
            F.explode(F.array(*map(F.lit, METRICS))).alias("metric_name"),
        )
        .select(
            "user_id",
            "metric_name",
            F.array_contains("known_metrics", F.col("metric_name")).alias("has_metric"),
            F.col("found")[F.col("metric_name")].alias("data_summary"),
        )
    )


def join_spread(requests: DataFrame, found: DataFrame) -> DataFrame:
    """Left join of requests and answers, with hot users spread over many tasks.

    Requests without a user match nothing; they are spread like a hot user's.
    """
    counts = requests.groupBy("user_id").count()
    # One row beside at most as many as there are users.
    total = counts.agg(F.sum("count").alias("total"))
    hot = counts.join(F.broadcast(total), F.col("count") > F.col("total") / HOT_USERS).select(
        "user_id", F.lit(True).alias("hot")
    )
    # Row content and task, and not a random number: a repeated task gives the same parts.
    content = F.pmod(F.xxhash64(*requests.columns), F.lit(SPREAD))
    part = F.pmod(content + F.spark_partition_id(), F.lit(SPREAD))
    all_parts = F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))
    left = requests.join(F.broadcast(hot), "user_id", "left").withColumn(
        "part",
        F.when(F.col("hot") | F.col("user_id").isNull(), part).otherwise(0),
    )
    one_part = F.array(F.lit(0).cast("bigint"))
    right = found.join(F.broadcast(hot), "user_id", "left").withColumn(
        "part", F.explode(F.when(F.col("hot"), all_parts).otherwise(one_part))
    )
    return left.drop("hot").join(
        right.drop("hot"), ["user_id", "metric_name", "part"], "left"
    )


def answer_requests(
    requests: DataFrame,
    table: DataFrame | None,
    as_of: Column | datetime | str | None = None,
    users: Sequence[str] | None = None,
) -> DataFrame:
    """Each request with ``status`` and, where that is ``ok``, its ``data_summary``.

    Reasons are tested in this order: unknown metric, no table (``None``), unknown user,
    no row of the metric for the user, nothing in the look-back. Other columns of the
    requests are kept. ``users`` are all users the requests name, where the caller knows
    them: their ids then reach the Parquet reader. Requests and answers are shuffled with hot
    users spread; adaptive execution broadcasts a side that turns out to be small.
    """
    valid = F.coalesce(F.col("metric_name").isin(*METRICS), F.lit(False))
    if table is None:
        return requests.withColumn(
            "status", F.when(valid, "no_gold_data").otherwise("invalid_metric")
        ).withColumn("data_summary", F.lit(None).cast(SUMMARY_TYPE))
    if users is not None:
        table = table.filter(F.col("user_id").isin(*users))
    joined = join_spread(requests, answers(table, as_of))
    status = (
        F.when(~valid, "invalid_metric")
        .when(F.col("has_metric").isNull(), "unknown_user")
        .when(~F.col("has_metric"), "no_metric_data")
        .when(F.col("data_summary").isNull(), "no_recent_data")
        .otherwise("ok")
    )
    return joined.select(*requests.columns, status.alias("status"), "data_summary")
