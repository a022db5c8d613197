"""Look-back summaries against a row-by-row calculation, in every layout."""

import datetime as dt
import math
import random
from collections import defaultdict

import pytest
from conftest import final_plan, rows
from pyspark.sql import functions as F

from pulsetide.operators.series import recent, time_column, to_long, value_columns
from pulsetide.operators.summary import (
    fold_windows,
    point_statistics,
    points_by_second,
    summarise,
)

NOON = dt.datetime(2026, 1, 2, 12, tzinfo=dt.timezone.utc)
AS_OF = NOON
WIDE = (
    "user_id string, avg_heart_rate double, avg_spo2 double, total_steps bigint, "
    "window_start timestamp, window_end timestamp, date date"
)
POINT = "user_id string, metric_name string, value double, event_time timestamp"


def wide(spark, series):
    """A gold table from (user, hours before noon, heart rate, spo2, steps)."""
    data = []
    for user, hours, hr, spo2, steps in series:
        end = NOON - dt.timedelta(hours=hours)
        start = end - dt.timedelta(hours=1)
        data.append((user, hr, spo2, steps, start, end, start.date()))
    return spark.createDataFrame(data, WIDE)


def points(spark, series):
    """A long table from (user, metric, seconds before noon, value)."""
    return spark.createDataFrame(
        [(u, m, v, NOON - dt.timedelta(seconds=s)) for u, m, s, v in series], POINT
    )


def by_hand(series):
    """Expected rows of (user, metric, age in seconds, value), oldest first, ties by value."""
    groups = defaultdict(list)
    for user, metric, age, value in series:
        if user is not None and value is not None and not math.isnan(value) and age <= 24 * 3600:
            groups[user, metric].append((-age, value))
    expected = []
    for (user, metric), found in groups.items():
        values = [value for _, value in sorted(found)]
        half = len(values) // 2
        trend = "stable"
        if half:
            first = sum(values[:half]) / half
            second = sum(values[half:]) / (len(values) - half)
            change = (second - first) / (first + 1e-9)
            trend = "increasing" if change > 0.05 else "decreasing" if change < -0.05 else trend
        mean = round(sum(values) / len(values), 2)
        numbers = [round(min(values), 2), round(max(values), 2), mean, round(values[-1], 2)]
        expected.append((user, metric, *numbers, trend, len(values)))
    return sorted(expected, key=repr)


def long_series(series):
    """The wide rows as (user, metric, age, value)."""
    for user, hours, hr, spo2, steps in series:
        for metric, value in [("heart_rate", hr), ("spo2", spo2), ("steps", steps)]:
            yield user, metric, hours * 3600, None if value is None else float(value)


def one_metric(frame, metric="heart_rate"):
    return rows(frame.filter(f"metric_name = '{metric}'"))


def steps_of(spark, values, **options):
    """(trend, count) of a user whose hourly steps are the values, oldest first."""
    series = [("u1", len(values) - n, None, None, v) for n, v in enumerate(values)]
    return rows(summarise(wide(spark, series), AS_OF, **options), "trend", "window_count")


@pytest.mark.parametrize(
    "values, trend",
    [
        ([5], "stable"),
        ([5, 6], "increasing"),
        ([6, 5], "decreasing"),
        ([10, 10, 12], "increasing"),  # halves of one and two values
        ([10, 12, 8], "stable"),
        ([100, 105], "stable"),  # exactly +5 %
        ([100, 106], "increasing"),
        ([100, 95], "stable"),  # exactly -5 %
        ([100, 94], "decreasing"),
        ([0, 1], "increasing"),  # the divisor is the epsilon
        ([0, 0], "stable"),
    ],
)
def test_trend(spark, values, trend):
    assert steps_of(spark, values) == [(trend, len(values))]


def test_no_value_no_row(spark):
    assert steps_of(spark, [None, None]) == []
    nan = wide(spark, [("u1", 1, float("nan"), None, None)])
    assert rows(summarise(nan, AS_OF)) == []


def random_hours(seed):
    pick = random.Random(seed)
    return [
        (
            pick.choice(["u1", "u2", "u3", None]),
            pick.randrange(0, 30),
            pick.choice([None, float("nan"), pick.uniform(40, 180), 72.125]),
            pick.choice([None, pick.uniform(80, 100)]),
            pick.choice([None, pick.randrange(3)]),
        )
        for _ in range(120)
    ]


@pytest.mark.parametrize("seed", range(3))
def test_hourly_table_with_ties_copies_and_gaps(spark, seed):
    # Hours repeat, so several rows of a user share a window.
    series = random_hours(seed)
    series += series[:20] * 3
    assert rows(summarise(wide(spark, series), AS_OF)) == by_hand(long_series(series))


@pytest.mark.parametrize("seed", range(3))
def test_points_of_any_resolution(spark, seed):
    pick = random.Random(seed)
    series = [
        (
            pick.choice(["u1", "u1", "u1", "u2", None]),
            pick.choice(["heart_rate", "spo2", "glucose"]),
            pick.choice([pick.uniform(0, 90000), pick.randrange(5), 2.25, 2.5, 2.75]),
            pick.choice([None, float("nan"), pick.uniform(1, 3), 2.0]),
        )
        for _ in range(300)
    ]
    # Microseconds, as the table keeps them.
    series = [(u, m, round(s, 6), v) for u, m, s, v in series]
    assert rows(summarise(points(spark, series), AS_OF)) == by_hand(series)


def test_midpoint_inside_one_second(spark):
    # A third of all points and more share one second of one user; copies are folded.
    crowd = [("hot", "steps", 10, float(n % 50)) for n in range(600)]
    rest = [(f"u{n}", "steps", n, 1.0) for n in range(200)]
    series = crowd + rest + [("hot", "steps", 20, 1.0), ("hot", "steps", 5, 3.0)]
    frame = summarise(points(spark, series), AS_OF)
    assert rows(frame) == by_hand(series)


def test_both_plans_agree(spark):
    series = random_hours(7)
    table = recent(wide(spark, series), AS_OF)
    named = to_long(table).filter("user_id IS NOT NULL")
    slow = point_statistics(named.filter("value IS NOT NULL AND NOT isnan(value)"))
    assert rows(slow, "user_id", "metric_name", "window_count", "min", "max", "latest") == rows(
        summarise(table, AS_OF, rounded=False),
        "user_id",
        "metric_name",
        "window_count",
        "min",
        "max",
        "latest",
    )


def test_rounding_is_that_of_python(spark):
    series = [("u1", n, value, None, None) for n, value in enumerate([2.675, 0.125, 1.005])]
    got = one_metric(summarise(wide(spark, series), AS_OF))
    assert got == [("u1", "heart_rate", 0.12, 2.67, round(3.805 / 3, 2), 2.67, "increasing", 3)]
    exact = one_metric(summarise(wide(spark, series), AS_OF, rounded=False))
    assert exact[0][2:4] == (0.125, 2.675)


@pytest.mark.parametrize("layout", ["hourly", "points"])
def test_infinite_and_huge_values(spark, layout):
    inf = float("inf")
    series = [("u1", 3, inf, 1e300, None), ("u1", 2, 1.0, 1e300, None), ("u2", 1, inf, 1.5, None)]
    if layout == "hourly":
        table = wide(spark, series)
    else:
        table = points(spark, list(long_series(series)))
    assert rows(summarise(table, AS_OF)) == [
        ("u1", "heart_rate", 1.0, inf, inf, 1.0, "stable", 2),
        ("u1", "spo2", 1e300, 1e300, 1e300, 1e300, "stable", 2),
        ("u2", "heart_rate", inf, inf, inf, inf, "stable", 1),
        ("u2", "spo2", 1.5, 1.5, 1.5, 1.5, "stable", 1),
    ]


def test_look_back_is_inclusive_and_open_upward(spark):
    table = wide(spark, [("u1", hours, 70.0, 97.0, 1) for hours in (25, 24, 0, -5)])
    assert rows(recent(table, AS_OF).selectExpr("hour(window_end)")) == [(12,), (12,), (17,)]
    assert rows(recent(table, AS_OF.replace(tzinfo=None), hours=0).selectExpr("count(*)")) == [(2,)]
    assert recent(table).count() == 0


def test_layer_written_in_another_zone_is_not_pruned_away(spark):
    # Its dates may be a day behind the dates of this session.
    row = ("u1", 70.0, 97.0, 1, NOON - dt.timedelta(hours=25), NOON - dt.timedelta(hours=24))
    table = spark.createDataFrame([(*row, dt.date(2025, 12, 31))], WIDE)
    assert recent(table, AS_OF).count() == 1


# --- Layouts ---------------------------------------------------------------------


def test_columns_are_found_in_order(spark):
    def named(*names):
        return spark.createDataFrame([], ", ".join(f"`{n}` double" for n in names))

    assert time_column(named("event_time", "timestamp", "window_start")) == "window_start"
    assert time_column(named("a")) is None
    assert value_columns(named("avg_spo2", "spo2", "steps")) == {
        "spo2": "avg_spo2",
        "steps": "steps",
    }
    assert value_columns(named("metric_name", "steps", "avg_spo2")) == {"spo2": "avg_spo2"}
    assert value_columns(named("event_count"), ["event_count"]) == {"event_count": "event_count"}


def test_long_layout_prefers_avg_over_value(spark):
    table = spark.createDataFrame(
        [("u1", "steps", 1.0, 9.0, "2026-01-02T11:00:00Z")],
        "user_id string, metric_name string, avg double, value double, timestamp string",
    )
    assert rows(summarise(table, AS_OF), "min", "latest") == [(1.0, 1.0)]


def test_mixed_layout_uses_the_wide_column_where_there_is_one(spark):
    table = spark.createDataFrame(
        [("u1", 70.0, None, None, NOON), ("u1", None, "steps", 8.0, NOON),
         ("u1", None, "heart_rate", 99.0, NOON)],
        "user_id string, avg_heart_rate double, metric_name string, value double, "
        "window_end timestamp",
    )
    assert rows(summarise(table, AS_OF), "metric_name", "max") == [
        ("heart_rate", 70.0),
        ("steps", 8.0),
    ]


def test_raw_columns_with_text_times(spark):
    table = spark.createDataFrame(
        [("u1", 70, "2026-01-02T11:00:00Z"), ("u1", 80, "x"), ("u1", 60, "2026-01-02T10:00:00Z")],
        "user_id string, heart_rate int, timestamp string",
    )
    assert rows(summarise(table, AS_OF, metrics=["heart_rate"])) == [
        ("u1", "heart_rate", 60.0, 70.0, 65.0, 70.0, "increasing", 2)
    ]


def test_table_without_time_has_no_order(spark):
    table = spark.createDataFrame([("u1", 3.0), ("u1", 1.0)], "user_id string, avg_spo2 double")
    assert rows(summarise(table, AS_OF, metrics=["spo2"])) == [
        ("u1", "spo2", 1.0, 3.0, 2.0, None, None, 2)
    ]


def test_tables_without_values_are_refused(spark):
    with pytest.raises(ValueError, match="value column"):
        to_long(spark.createDataFrame([], "user_id string, metric_name string"))
    with pytest.raises(ValueError, match="none of"):
        to_long(spark.createDataFrame([], "user_id string, window_end timestamp"))


# --- Plans -----------------------------------------------------------------------


def test_hourly_plan_shuffles_once_by_user(spark):
    text = final_plan(summarise(wide(spark, random_hours(1)), AS_OF))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Window [") == 1
    assert "Python" not in text


def test_point_plan_never_gathers_raw_points_per_series(spark, setting):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    series = [("u1", "steps", n // 3, float(n)) for n in range(99)]
    frame = summarise(points(spark, series), AS_OF)
    text = final_plan(frame)
    assert "ReusedExchange" in text  # the shuffle by second serves both branches
    assert "Python" not in text
    assert rows(frame) == by_hand(series)


# --- Hot users -------------------------------------------------------------------


def test_copies_of_a_hot_user_are_folded_to_one_row_per_window(spark):
    hot = [("hot", n % 24, 70.0, 97.0, 5) for n in range(1000)]
    table = wide(spark, hot + [(f"u{n}", 1, 70.0, 97.0, 5) for n in range(2000)])
    folded = fold_windows(table, ["avg_heart_rate", "avg_spo2", "total_steps"])
    sizes = dict(rows(folded.groupBy("user_id").count()))
    assert sizes["hot"] == 24 and max(sizes.values()) == 24
    assert rows(folded.selectExpr("sum(copies)")) == [(3000,)]
    assert rows(summarise(table, AS_OF).filter("user_id = 'hot'"), "window_count") == [(1000,)] * 3


def test_points_of_a_hot_user_are_spread_over_all_tasks(spark, setting):
    setting("spark.sql.adaptive.coalescePartitions.enabled", "false")
    points_table = spark.range(60000).selectExpr(
        "if(id % 3 = 0, 'hot', concat('u', id % 500)) AS user_id",
        "'steps' AS metric_name",
        "CAST(id % 50 AS double) AS value",
        "timestamp_seconds(1767355200 - id % 7200) AS time",
    )
    spread = points_by_second(points_table)
    sizes = [size for _, size in rows(spread.groupBy(F.spark_partition_id()).count())]
    assert len(sizes) == 8 and max(sizes) < 2 * sum(sizes) / len(sizes)
    assert rows(spread.selectExpr("sum(copies)")) == [(60000,)]
