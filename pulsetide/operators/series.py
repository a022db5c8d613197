"""Value series: where an hourly table keeps a metric, and the points of each series."""

from collections.abc import Iterable, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetide.functions import event_time, instant
from pulsetide.model import (
    LOOK_BACK_HOURS,
    METRIC_COLUMNS,
    METRICS,
    TIME_COLUMNS,
    VALUE_COLUMNS,
)


def first_existing(candidates: Iterable[str], columns: Sequence[str]) -> str | None:
    """The first candidate among the columns; looks at the schema only."""
    return next((name for name in candidates if name in columns), None)


def time_column(frame: DataFrame) -> str | None:
    """The column that orders the rows in time."""
    return first_existing(TIME_COLUMNS, frame.columns)


def value_columns(frame: DataFrame, metrics: Sequence[str] = METRICS) -> dict[str, str]:
    """Metrics that have a column of their own, with that column.

    The aggregate column wins. Without one, a table of (metric_name, value) rows is read
    by its rows, and only a table without ``metric_name`` falls back to a column named
    like the metric.
    """
    found = {}
    for metric in metrics:
        names = [METRIC_COLUMNS.get(metric)]
        if "metric_name" not in frame.columns:
            names.append(metric)
        column = first_existing([name for name in names if name], frame.columns)
        if column:
            found[metric] = column
    return found


def is_hourly(frame: DataFrame, metrics: Sequence[str] = METRICS) -> bool:
    """Whether every metric sits in an aggregate column next to its window's bounds."""
    wanted = [METRIC_COLUMNS.get(metric) for metric in metrics]
    return {"window_start", "window_end", *wanted} <= set(frame.columns)


def metric_rows(columns: dict[str, str]) -> Column:
    """Generator of one (metric_name, value) row per metric column.

    A generator keeps the partitioning of its input, which ``unpivot`` does not.
    """
    return F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(metric).alias("metric_name"),
                    F.col(column).cast("double").alias("value"),
                )
                for metric, column in columns.items()
            ]
        )
    )


def to_long(frame: DataFrame, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Every point of every series as (user_id, time, metric_name, value), nulls included.

    Takes a wide table, a (metric_name, value) table, or the union of both. In a union, a
    metric that has a column of its own is read from that column alone.
    """
    columns = value_columns(frame, metrics)
    time = time_column(frame)
    at = event_time(time) if time else F.lit(None).cast("timestamp")
    keyed = frame.withColumn("time", at)
    parts = []
    if columns:
        parts.append(keyed.select("user_id", "time", metric_rows(columns)))
    if "metric_name" in frame.columns and set(metrics) - set(columns):
        value = first_existing(VALUE_COLUMNS, frame.columns)
        if value is None:
            raise ValueError(f"no value column among {', '.join(VALUE_COLUMNS)}")
        parts.append(
            keyed.filter(~F.col("metric_name").isin(*columns) if columns else F.lit(True)).select(
                "user_id", "time", "metric_name", F.col(value).cast("double").alias("value")
            )
        )
    if not parts:
        raise ValueError(f"none of {', '.join(metrics)} found in the table")
    return union_all(parts)


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Rows of all parts; all have the same columns."""
    whole, *others = parts
    for part in others:
        whole = whole.unionByName(part)
    return whole


def is_recent(
    frame: DataFrame, as_of: Column | datetime | str | None = None, hours: int = LOOK_BACK_HOURS
) -> Column:
    """Whether a row of a table with time is at most ``hours`` before ``as_of``."""
    return event_time(time_column(frame)) >= instant(as_of) - F.expr(f"INTERVAL {hours} HOURS")


def recent(
    frame: DataFrame,
    as_of: Column | datetime | str | None = None,
    hours: int = LOOK_BACK_HOURS,
) -> DataFrame:
    """Rows whose time is at most ``hours`` before ``as_of``, with no upper bound.

    A table without a time column is returned whole. In the gold layer the ``date``
    partitions are pruned too: a window starts one hour before it ends, and one more
    day covers a layer written in another zone than this session's.
    """
    if time_column(frame) is None:
        return frame
    now = instant(as_of)
    kept = frame.filter(is_recent(frame, as_of, hours))
    if is_hourly(frame) and dict(frame.dtypes).get("date") == "date":
        earliest = F.to_date(now - F.expr(f"INTERVAL {hours + 1} HOURS"))
        kept = kept.filter(F.col("date") >= F.date_sub(earliest, 1))
    return kept


def user_history(frame: DataFrame, user_id: str) -> DataFrame:
    """All rows of one user in time order; the equality reaches the Parquet reader."""
    rows = frame.filter(F.col("user_id") == user_id)
    time = time_column(frame)
    return rows.orderBy(time) if time else rows


def available_users(frame: DataFrame) -> DataFrame:
    """Distinct user ids in order; rows without an id name no user."""
    return frame.select("user_id").dropna().distinct().orderBy("user_id")
