"""Requests answered with a summary or a reason."""

import pytest
from conftest import final_plan, plan, rows
from pyspark.sql import functions as F
from test_summary import AS_OF, points, wide

from pulsetide.operators import requests as module
from pulsetide.operators.requests import answer_requests
from pulsetide.operators.series import available_users
from pulsetide.sinks.layers import overwrite_layer
from pulsetide.sources.layers import read_layer


def asked(spark, *pairs):
    return spark.createDataFrame(pairs, "user_id string, metric_name string")


def statuses(spark, table, *pairs):
    answered = answer_requests(asked(spark, *pairs), table, AS_OF)
    return {tuple(row[:2]): row[2] for row in rows(answered, "user_id", "metric_name", "status")}


@pytest.fixture
def table(spark):
    return wide(
        spark,
        [
            ("u1", 1, 70.0, 97.0, 10),
            ("u1", 0, 80.0, 98.0, None),
            ("old", 30, 70.0, 97.0, 10),
            ("blank", 1, None, 97.0, 10),
            (None, 1, 70.0, 97.0, 10),
        ],
    )


def test_reasons_in_order(spark, table):
    expected = {
        ("u1", "heart_rate"): "ok",
        ("u1", "glucose"): "invalid_metric",
        ("nobody", "steps"): "unknown_user",
        ("nobody", "glucose"): "invalid_metric",
        ("old", "steps"): "no_recent_data",
        ("blank", "heart_rate"): "no_recent_data",
        (None, "steps"): "unknown_user",
        ("u1", None): "invalid_metric",
    }
    assert statuses(spark, table, *expected) == expected


def test_summary_of_a_good_request(spark, table):
    answered = answer_requests(asked(spark, ("u1", "heart_rate"), ("no", "steps")), table, AS_OF)
    assert rows(answered.select("user_id", "data_summary.*")) == [
        ("no",) + (None,) * 6,
        ("u1", 70.0, 80.0, 75.0, 80.0, "increasing", 2),
    ]


def test_absent_table(spark):
    answered = answer_requests(asked(spark, ("u1", "steps"), ("u1", "x")), None, AS_OF)
    assert rows(answered, "metric_name", "status") == [
        ("steps", "no_gold_data"),
        ("x", "invalid_metric"),
    ]
    assert [f.dataType for f in answered.schema["data_summary"].dataType][0].typeName() == "double"


def test_empty_table_knows_nobody(spark, table):
    assert statuses(spark, table.filter("false"), ("u1", "steps")) == {
        ("u1", "steps"): "unknown_user"
    }


def test_long_layout_can_lack_a_metric(spark):
    table = points(spark, [("u1", "steps", 60, 5.0), ("u1", "spo2", 90000, 97.0)])
    assert statuses(
        spark, table, ("u1", "steps"), ("u1", "spo2"), ("u1", "heart_rate"), ("u2", "steps")
    ) == {
        ("u1", "steps"): "ok",
        ("u1", "spo2"): "no_recent_data",
        ("u1", "heart_rate"): "no_metric_data",
        ("u2", "steps"): "unknown_user",
    }


def test_other_columns_and_repeated_requests_are_kept(spark, table):
    requests = spark.createDataFrame(
        [(n, "steps", "u1") for n in range(3)], "id int, metric_name string, user_id string"
    )
    answered = answer_requests(requests, table, AS_OF)
    assert answered.columns == ["id", "metric_name", "user_id", "status", "data_summary"]
    assert rows(answered, "id", "status") == [(n, "ok") for n in range(3)]


def test_two_narrow_scans_of_gold_and_two_of_requests(spark, tmp_path):
    overwrite_layer(wide(spark, [(f"u{n}", 1, 70.0, 97.0, n) for n in range(20)]).withColumn(
        "date", F.to_date("window_start")), str(tmp_path / "gold"))
    spark.range(50).selectExpr("concat('u', id) AS user_id", "'steps' AS metric_name").write.parquet(
        str(tmp_path / "requests"))
    requests = spark.read.parquet(str(tmp_path / "requests"))
    text = final_plan(answer_requests(requests, read_layer(spark, str(tmp_path / "gold")), AS_OF))
    scans = [line for line in text.splitlines() if "FileScan parquet" in line]
    # User ids of the whole history, and values of the dates of the look-back.
    gold = sorted((line.split("ReadSchema:")[1].strip() for line in scans if "/gold" in line), key=len)
    assert len(gold) == 2 and gold[0] == "struct<user_id:string>" and "avg_heart_rate" in gold[1]
    assert sum("/requests" in line for line in scans) <= 2


def test_named_users_reach_the_reader(spark, tmp_path):
    overwrite_layer(wide(spark, [(f"u{n}", 1, 70.0, 97.0, n) for n in range(20)]).withColumn(
        "date", F.to_date("window_start")), str(tmp_path / "gold"))
    request = spark.createDataFrame([("u3", "steps")], "user_id string, metric_name string")
    answered = answer_requests(request, read_layer(spark, str(tmp_path / "gold")), AS_OF, users=["u3"])
    assert [row.status for row in answered.collect()] == ["ok"]
    scans = [line for line in plan(answered).splitlines() if "FileScan parquet" in line]
    assert scans and all("EqualTo(user_id,u3)" in line for line in scans)


def test_hot_user_is_spread_and_no_request_is_lost(spark, setting, monkeypatch):
    setting("spark.sql.autoBroadcastJoinThreshold", "-1")
    setting("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    monkeypatch.setattr(module, "HOT_USERS", 10)
    table = wide(spark, [(f"u{n}", 1, 70.0, 97.0, n) for n in range(200)])
    # A third of all requests for one user, another third for none.
    requests = spark.range(9000).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'u7' WHEN 1 THEN concat('u', id % 300) END AS user_id",
        "'steps' AS metric_name",
    )
    answered = answer_requests(requests, table, AS_OF)
    cold = [n % 300 for n in range(9000) if n % 3 == 1]
    good = 3000 + sum(number < 200 for number in cold)
    assert rows(answered.groupBy("status").count()) == [
        ("ok", good),
        ("unknown_user", 9000 - good),
    ]
    assert rows(answered.filter("user_id = 'u7'").groupBy("data_summary.max").count()) == [
        (7.0, 3000 + cold.count(7))
    ]
    text = final_plan(answered)
    assert "SortMergeJoin" in text and "part#" in text


def test_parts_of_a_hot_user_are_even(spark, monkeypatch):
    monkeypatch.setattr(module, "HOT_USERS", 10)
    requests = spark.range(6400).selectExpr("id", "'u7' AS user_id", "'steps' AS metric_name")
    found = spark.createDataFrame(
        [("u7", "steps", True)], "user_id string, metric_name string, has_metric boolean"
    )
    parts = module.join_spread(requests, found).groupBy("part").count()
    counts = [count for _, count in rows(parts)]
    assert len(counts) == module.SPREAD and sum(counts) == 6400 and max(counts) < 200


def test_users_in_order_without_the_nameless(spark, table):
    assert [row[0] for row in available_users(table).collect()] == ["blank", "old", "u1"]


def test_values_are_read_from_recent_dates_alone(spark, tmp_path):
    series = [("old", 200, 60.0, 97.0, 1)] + [("u1", h, 70.0, 97.0, 5) for h in range(0, 24 * 12, 6)]
    overwrite_layer(wide(spark, series), str(tmp_path / "gold"))
    layer = read_layer(spark, str(tmp_path / "gold"))
    answered = answer_requests(asked(spark, ("u1", "steps"), ("old", "steps"), ("none", "steps")), layer, AS_OF)
    got = {r.user_id: (r.status, r.data_summary and r.data_summary.window_count) for r in answered.collect()}
    assert got == {"u1": ("ok", 5), "old": ("no_recent_data", None), "none": ("unknown_user", None)}
    scans = [line for line in final_plan(answered).splitlines() if "FileScan parquet" in line]
    (with_values,) = [line for line in scans if "total_steps" in line.split("ReadSchema:")[1]]
    assert ">=" in with_values.split("PartitionFilters: [")[1].split("PushedFilters")[0]
