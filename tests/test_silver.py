"""Cleaning and flagging."""

import pytest
from conftest import event, records, rows

from pulsetide.model import SILVER
from pulsetide.operators.bronze import to_bronze
from pulsetide.operators.silver import anomalies, to_silver


def flags(spark, *payloads):
    return rows(to_silver(to_bronze(records(spark, payloads))), "kafka_offset", "is_anomaly")


@pytest.mark.parametrize(
    "field, inside, outside",
    [("hr", (30, 220), (29, 221)), ("spo2", (70.0, 100.0), (69.9, 100.1)), ("steps", (0,), (-1,))],
)
def test_ranges_are_inclusive(spark, field, inside, outside):
    payloads = [event(**{field: value}) for value in inside + outside]
    assert [offset for offset, _ in flags(spark, *payloads)] == list(range(len(inside)))


def test_anomaly_bounds_are_strict(spark):
    payloads = [event(hr=130), event(hr=131), event(spo2=92.0), event(spo2=91.9)]
    assert flags(spark, *payloads) == [(0, False), (1, True), (2, False), (3, True)]


def test_missing_vitals_and_nan_are_dropped(spark):
    payloads = [event(hr=None), event(steps=None), event(spo2=None), event(spo2="NaN"), "not json"]
    assert flags(spark, *payloads) == []


def test_missing_user_or_time_stays(spark):
    assert flags(spark, event(user=None), event(at=None)) == [(0, False), (1, False)]


def test_schema_and_anomaly_rows(spark):
    silver = to_silver(to_bronze(records(spark, [event(), event(hr=140)])))
    assert [f.name for f in silver.schema] == SILVER.fieldNames()
    assert rows(anomalies(silver), "heart_rate") == [(140,)]
