"""Texts: baselines, prompts, key/value rows, labels."""

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_summary import AS_OF, wide

from pulsetide.functions import padded_user_id
from pulsetide.model import BASELINES, NO_BASELINE
from pulsetide.operators.reports import (
    advice_prompts,
    metric_catalog,
    summary_rows,
    user_labels,
    with_baseline,
)
from pulsetide.operators.requests import answer_requests
from pulsetide.operators.summary import summarise


MEAN = round((97.5 + 97.55) / 2, 2)


@pytest.fixture
def summary(spark):
    return summarise(wide(spark, [("u1", 1, 70.0, 97.5, 9), ("u1", 0, 70.0, 97.55, 12)]), AS_OF)


def test_baseline_or_default(spark):
    asked = spark.createDataFrame([("steps",), ("glucose",)], "metric_name string")
    assert dict(rows(with_baseline(asked))) == {
        "steps": BASELINES["steps"],
        "glucose": NO_BASELINE,
    }


def test_prompt_names_every_statistic(summary):
    prompts = advice_prompts(summary.filter("metric_name = 'spo2'"))
    assert prompts.columns == ["user_id", "metric_name", "data_summary", "prompt"]
    (row,) = prompts.collect()
    assert tuple(row["data_summary"]) == (97.5, 97.55, MEAN, 97.55, "stable", 2)
    lines = row["prompt"].split("\n")
    assert lines[0] == "Metric spo2 of user u1 in the past 24 hours"
    assert lines[1:7] == [
        "lowest: 97.5",
        "highest: 97.55",
        f"mean: {MEAN}",
        "most recent: 97.55",
        "trend: stable",
        "hourly windows: 2",
    ]
    assert lines[7] == f"Baseline: {BASELINES['spo2']}"


def test_numbers_in_prompts_are_those_of_python(spark):
    values = [83.0, 83.3, 12345678.0]
    table = wide(spark, [(f"u{n}", 1, v, None, None) for n, v in enumerate(values)])
    prompts = advice_prompts(summarise(table, AS_OF)).orderBy("user_id").collect()
    assert [p["prompt"].split("\n")[1] for p in prompts] == [f"lowest: {v}" for v in values]


def test_summary_as_rows(summary):
    shown = summary_rows(summary.filter("metric_name = 'spo2'"))
    assert rows(shown, "position", "label", "value") == [
        (1, "Minimum", "97.50"),
        (2, "Maximum", "97.55"),
        (3, "Average", f"{MEAN}"),
        (4, "Latest", "97.55"),
        (5, "Trend", "stable"),
        (6, "window_count", "2"),
    ]
    whole = summary_rows(summary.filter("metric_name = 'steps'"))
    assert rows(whole.filter("position < 4"), "value") == [("10.50",), ("12",), ("9",)]


def test_request_without_summary_shows_no_data(spark, summary):
    asked = spark.createDataFrame([("u9", "steps")], "user_id string, metric_name string")
    table = wide(spark, [("u1", 1, 70.0, 97.5, 9)])
    answered = answer_requests(asked, table, AS_OF)
    shown = summary_rows(answered.select("user_id", "metric_name", "data_summary.*"))
    assert rows(shown) == [("u9", "steps", 1, "No data", "-")]


@pytest.mark.parametrize(
    "user, label",
    [
        ("user_001", "Patient 001"),
        ("001", "Patient 001"),
        ("a_user_b_user_c", "Patient a_b_user_c"),
        ("x\nuser_1", "Patient x\n1"),
    ],
)
def test_label_drops_the_first_prefix_only(spark, user, label):
    users = spark.createDataFrame([(user,)], "user_id string")
    assert rows(user_labels(users), "label") == [(label,)]


def test_catalog_lists_the_three_metrics(spark):
    table = wide(spark, [("u1", 1, 70.0, None, 9), ("u1", 0, 70.0, 97.55, None)])
    assert rows(metric_catalog(table)) == [
        ("heart_rate", "avg_heart_rate", 2),
        ("spo2", "avg_spo2", 1),
        ("steps", "total_steps", 1),
    ]


def test_padded_ids_keep_long_numbers(spark):
    ids = spark.range(3).select(padded_user_id(F.pow(F.lit(10), 2 * F.col("id")).cast("bigint")))
    assert rows(ids) == [("user_001",), ("user_100",), ("user_10000",)]
