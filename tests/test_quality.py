"""Data-quality checks."""

import datetime as dt

from conftest import event, final_plan, records, rows

from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.gold import hourly
from pulsetide.operators.quality import dq_checks, layer_row_counts
from pulsetide.operators.silver import to_silver


def layers(spark, *payloads):
    bronze = to_bronze(records(spark, payloads))
    silver = to_silver(bronze)
    return bronze, silver, hourly(silver)


def report(frame):
    return {(row[0], row[1]): tuple(row[2:]) for row in frame.collect()}


def test_good_layers_pass_twelve_checks(spark):
    got = report(dq_checks(spark, *layers(spark, event(), event(user="u2", hr=150))))
    assert len(got) == 12
    assert {status for *_, status in got.values()} == {"passed"}
    assert got["bronze", "schema"] == (8, 0, "passed")
    assert got["silver", "anomaly_flag"] == (2, 0, "passed")
    assert got["gold", "user_coverage"] == (2, 0, "passed")


def test_unparsed_rows_fail_the_key_check(spark):
    got = report(dq_checks(spark, *layers(spark, event(), "not json", event(at=None))))
    assert got["bronze", "no_null_keys"] == (3, 2, "failed")


def test_absent_layers_are_skipped(spark):
    bronze, _, _ = layers(spark, event())
    got = report(dq_checks(spark, bronze, None, None))
    assert got["silver", "range_spo2"] == (None, None, "skipped")
    assert sorted(status for *_, status in got.values()) == ["passed"] * 3 + ["skipped"] * 9


def test_empty_layers_fail_where_data_is_asked_for(spark):
    got = report(dq_checks(spark, *layers(spark)))
    failed = {key for key, (*_, status) in got.items() if status == "failed"}
    assert failed == {
        ("bronze", "has_data"),
        ("gold", "aggregation_exists"),
        ("gold", "user_coverage"),
    }


def test_every_silver_rule_counts_its_violations(spark):
    silver = spark.createDataFrame(
        [
            ("u", "t", 29, 0, 97.0, False),
            ("u", "t", 221, -1, 100.1, False),
            ("u", "t", None, 5, float("nan"), None),
            ("u", "t", 70, 5, 97.0, True),  # flagged without a reason
            ("u", "t", 150, 5, 97.0, False),  # a reason without a flag is fine
            ("u", "t", None, 5, 90.0, True),
        ],
        "user_id string, timestamp string, heart_rate int, steps int, spo2 double, "
        "is_anomaly boolean",
    )
    got = report(dq_checks(spark, None, silver, None))
    assert {check: got["silver", check][1] for layer, check in got if layer == "silver"} == {
        "schema": 0,
        "no_nulls": 2,
        "range_heart_rate": 4,
        "range_spo2": 2,
        "range_steps": 1,
        "anomaly_flag": 1,
    }


def test_missing_columns_fail(spark):
    silver = spark.createDataFrame([("u", 70)], "user_id string, heart_rate int")
    gold = spark.createDataFrame([(1.0,)], "avg_spo2 double")
    got = report(dq_checks(spark, None, silver, gold))
    assert got["silver", "schema"] == (2, 4, "failed")
    assert got["silver", "range_heart_rate"] == (1, 0, "passed")
    assert got["silver", "range_spo2"] == (1, None, "failed")
    assert got["gold", "user_coverage"] == (1, None, "failed")


def test_nameless_rows_count_as_one_user(spark):
    _, _, gold = layers(spark, event(user=None), event(user=None, at="2026-01-02T11:05:00Z"))
    assert report(dq_checks(spark, None, None, gold))["gold", "user_coverage"] == (1, 0, "passed")


def test_row_counts_and_one_aggregation_per_layer(spark):
    bronze, silver, gold = layers(spark, event(), event(hr=20), "not json")
    counts = layer_row_counts({"bronze": bronze, "silver": silver, "gold": gold})
    assert rows(counts) == [("bronze", 3), ("gold", 1), ("silver", 1)]
    silver_only = dq_checks(spark, None, silver, None)
    assert final_plan(silver_only).count("from_json") == 1
    assert gold.filter(gold["date"] == dt.date(2026, 1, 2)).count() == 1
