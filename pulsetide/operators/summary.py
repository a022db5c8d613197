"""Look-back summaries: min, max, average, latest, trend and count of every series.

Two plans give the same result; the table's layout decides between them.

* **Hourly table.** A user has one row per window, so their size follows the calendar, not
  the number of events. One shuffle by user serves folding equal copies of a row, the
  ordering and the aggregates of all metrics.
* **Table of any resolution.** One user may hold a third of all points, so points are
  aggregated per second first, and only those seconds are put in order per series. A
  midpoint inside a second with several points is settled on the points of that second.
"""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from pulsetide.functions import event_time, present, round_half_even, trend
from pulsetide.model import LOOK_BACK_HOURS, METRICS
from pulsetide.operators.series import (
    is_hourly,
    metric_rows,
    recent,
    time_column,
    to_long,
    value_columns,
)

SERIES = ["user_id", "metric_name"]


def clip(value: Column, upper: Column) -> Column:
    """``value`` held between zero and ``upper``."""
    return F.greatest(F.lit(0), F.least(value, upper))


def points_before(ordered: WindowSpec) -> Column:
    """Number of points in earlier rows of an ordered window."""
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("copies").over(earlier), F.lit(0))


def whole_series(ordered: WindowSpec) -> WindowSpec:
    """The frame of all rows, in the order of ``points_before``, so that both share a sort."""
    return ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)


def first_half(ordered: WindowSpec) -> Column:
    """Size of the earlier half of a series."""
    return F.floor(F.sum("copies").over(whole_series(ordered)) / 2)


def fold_windows(gold: DataFrame, values: Sequence[str]) -> DataFrame:
    """Equal rows of a user and window as one row with the number of its copies."""
    time = event_time(time_column(gold)).alias("time")
    return gold.groupBy("user_id", time, *values).agg(F.count("*").alias("copies"))


def hourly_statistics(
    gold: DataFrame, metrics: Sequence[str], fold_first: bool = False
) -> DataFrame:
    """Statistics per series of a table with one row per user and window.

    One shuffle by user serves folding, ordering and aggregating. ``fold_first`` folds before
    it, in a shuffle of its own, for tables in which equal rows may repeat without limit; it
    also gives users without any value their rows, with a count of zero.
    """
    columns = value_columns(gold, metrics)
    dealt = gold if fold_first else gold.repartition("user_id")
    folded = fold_windows(dealt, list(columns.values()))
    if fold_first:
        folded = folded.repartition("user_id")
    # The generator keeps the partitioning, so the window and the groupBy need no shuffle.
    points = folded.select("user_id", "time", "copies", metric_rows(columns))
    there = present(F.col("value"))
    if fold_first:
        points = points.withColumns(
            {"copies": F.when(there, F.col("copies")).otherwise(0), "value": F.when(there, F.col("value"))}
        )
    else:
        points = points.filter(there)
    in_order = Window.partitionBy(*SERIES).orderBy("time", "value")
    placed = points.select(
        "*",
        clip(first_half(in_order) - points_before(in_order), F.col("copies")).alias("first_copies"),
        F.last("value", ignorenulls=True).over(whole_series(in_order)).alias("last_value"),
    )
    return placed.groupBy(*SERIES).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.sum(F.col("value") * F.col("copies")).alias("total"),
        F.max("last_value").alias("latest"),
        F.sum("copies").alias("window_count"),
        *half_totals(),
    )


def half_totals() -> list[Column]:
    """Totals of the earlier and the later half of the points.

    A point outside a half is left out and not weighted zero: it may be infinite.
    """
    first = F.col("first_copies")
    later = F.col("copies") - first
    return [
        F.sum(F.when(first > 0, F.col("value") * first)).alias("first_total"),
        F.sum(F.when(later > 0, F.col("value") * later)).alias("second_total"),
    ]


def plus(left: str, right: str) -> Column:
    """Sum of two columns in which null stands for nothing."""
    return F.coalesce(left, F.lit(0.0)) + F.coalesce(right, F.lit(0.0))


def unordered_statistics(points: DataFrame) -> DataFrame:
    """Statistics per series of points without time; nothing that needs an order."""
    nothing = F.lit(None).cast("double")
    return points.groupBy(*SERIES).agg(
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.sum("value").alias("total"),
        nothing.alias("latest"),
        F.count("*").alias("window_count"),
        nothing.alias("first_total"),
        nothing.alias("second_total"),
    )


SLOT = [*SERIES, "slot"]


def points_by_second(points: DataFrame) -> DataFrame:
    """Points with their second as ``slot``, equal ones folded, spread by series and second."""
    return (
        points.withColumn("slot", F.date_trunc("second", "time"))
        .filter(F.col("slot").isNotNull())
        .repartition(*SLOT)
        .groupBy(*SLOT, "time", "value")
        .agg(F.count("*").alias("copies"))
    )


def point_statistics(points: DataFrame) -> DataFrame:
    """Statistics per series of points of any resolution, safe for a very long series.

    The seconds of one series are ordered in one task: 86,400 for a day, 31 million for a year.
    Total by hour before a look-back of years.
    """
    # Shared by the two branches below: Spark runs its shuffles once.
    by_slot = points_by_second(points)
    slots = by_slot.groupBy(*SLOT).agg(
        F.sum("copies").alias("copies"),
        F.sum(F.col("value") * F.col("copies")).alias("slot_total"),
        F.min("value").alias("slot_min"),
        F.max("value").alias("slot_max"),
        # Points of the same time are ordered by value.
        F.max_by("value", F.struct("time", "value")).alias("slot_latest"),
    )
    in_order = Window.partitionBy(*SERIES).orderBy("slot")
    placed = slots.withColumn("take", first_half(in_order) - points_before(in_order)).withColumn(
        "split", (F.col("take") > 0) & (F.col("take") < F.col("copies"))
    )
    statistics = placed.groupBy(*SERIES).agg(
        F.min("slot_min").alias("min"),
        F.max("slot_max").alias("max"),
        F.sum("slot_total").alias("total"),
        F.max_by("slot_latest", "slot").alias("latest"),
        F.sum("copies").alias("window_count"),
        F.sum(F.when(F.col("take") >= F.col("copies"), F.col("slot_total"))).alias("whole_first"),
        F.sum(F.when(F.col("take") <= 0, F.col("slot_total"))).alias("whole_second"),
        F.max(F.when(F.col("split"), F.struct("slot", "take"))).alias("cut"),
    )
    cuts = statistics.filter("cut IS NOT NULL").select(*SERIES, "cut.slot", "cut.take")
    in_slot = Window.partitionBy(*SLOT).orderBy("time", "value")
    parts = (
        by_slot.join(cuts, SLOT)
        .withColumn("first_copies", clip(F.col("take") - points_before(in_slot), F.col("copies")))
        .groupBy(*SERIES)
        .agg(*half_totals())
    )
    return statistics.join(parts, SERIES, "left").select(
        *SERIES,
        "min",
        "max",
        "total",
        "latest",
        "window_count",
        plus("whole_first", "first_total").alias("first_total"),
        plus("whole_second", "second_total").alias("second_total"),
    )


def summarise(
    table: DataFrame,
    as_of: Column | datetime | str | None = None,
    metrics: Sequence[str] = METRICS,
    hours: int = LOOK_BACK_HOURS,
    rounded: bool = True,
) -> DataFrame:
    """One row per user and metric with a value in the look-back.

    For some users only, filter or semi-join the table first. A table without a time
    column is summarised whole; it has no order, so ``latest`` and ``trend`` are null.
    """
    kept = recent(table, as_of, hours).filter(F.col("user_id").isNotNull())
    ordered = time_column(table) is not None
    if is_hourly(table, metrics):
        statistics = hourly_statistics(kept, metrics)
    else:
        points = to_long(kept, metrics).filter(present(F.col("value")))
        points = points.filter(F.col("metric_name").isNotNull())
        statistics = point_statistics(points) if ordered else unordered_statistics(points)
    return shown_statistics(statistics, ordered, rounded)


def shown_statistics(statistics: DataFrame, ordered: bool = True, rounded: bool = True) -> DataFrame:
    """The summary of every series from its totals; without a point the numbers are null."""
    count = F.col("window_count")
    half = F.floor(count / 2)
    # A series of one point has an empty earlier half.
    first_mean = F.col("first_total") / F.greatest(half, F.lit(1))
    second_mean = F.col("second_total") / F.greatest(count - half, F.lit(1))
    shown = round_half_even if rounded else (lambda value: value)
    return statistics.select(
        *SERIES,
        shown(F.col("min")).alias("min"),
        shown(F.col("max")).alias("max"),
        shown(F.col("total") / F.greatest(count, F.lit(1))).alias("avg"),
        shown(F.col("latest")).alias("latest"),
        F.when(F.lit(ordered), trend(count, first_mean, second_mean)).alias("trend"),
        count.alias("window_count"),
    )
