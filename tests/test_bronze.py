"""Parsing of broker records."""

import datetime as dt
import math

import pytest
from conftest import event, plan, records, rows

from pulsetide.model import BRONZE
from pulsetide.operators.bronze import count_by_date, to_bronze

FIELDS = ("user_id", "timestamp", "heart_rate", "steps", "spo2")
WHOLE = ("u1", "2026-01-02T10:05:00Z", 70, 5, 97.0)


def parsed(spark, payload):
    return rows(to_bronze(records(spark, [payload])), *FIELDS)[0]


@pytest.mark.parametrize("payload", ["not json", "[]", "{}", "", None])
def test_unreadable_payload_keeps_its_row(spark, payload):
    assert parsed(spark, payload) == (None,) * 5


def test_good_payload(spark):
    assert parsed(spark, event()) == WHOLE


def test_missing_and_extra_fields(spark):
    assert parsed(spark, event(hr=None)) == ("u1", WHOLE[1], None, 5, 97.0)
    assert parsed(spark, event(device="x9")) == WHOLE


@pytest.mark.parametrize("value", ["72.5", '"72"', "99999999999"])
def test_wrong_type_loses_only_that_field(spark, value):
    text = (
        '{"user_id":"u1","timestamp":"2026-01-02T10:05:00Z","heart_rate":%s,'
        '"steps":5,"spo2":97}' % value
    )
    assert parsed(spark, text) == ("u1", WHOLE[1], None, 5, 97.0)


def test_nan_text_in_a_double(spark):
    assert math.isnan(parsed(spark, event(spo2="NaN"))[4])


def test_broker_columns_arrival_and_date(spark):
    arrival = dt.datetime(2026, 1, 3, 1, 2, 3, tzinfo=dt.timezone.utc)
    bronze = to_bronze(records(spark, [event(), event(at="x"), event(at=None)]), arrival)
    assert [field.name for field in bronze.schema] == BRONZE.fieldNames()
    assert [f.dataType for f in bronze.schema] == [f.dataType for f in BRONZE]
    assert rows(bronze, "kafka_partition", "kafka_offset", "date") == [
        (0, 0, dt.date(2026, 1, 2)),
        (1, 1, None),
        (2, 2, None),
    ]
    stamps = bronze.selectExpr("date_format(ingestion_timestamp, 'yyyy-MM-dd HH:mm:ss')").distinct()
    assert rows(stamps) == [("2026-01-03 01:02:03",)]


def test_arrival_defaults_to_now(spark):
    late = to_bronze(records(spark, [event()])).filter(
        "ingestion_timestamp < current_timestamp() - INTERVAL 1 HOUR"
    )
    assert late.count() == 0


def test_date_is_the_one_written_in_the_text(spark, setting):
    setting("spark.sql.session.timeZone", "America/Los_Angeles")
    bronze = to_bronze(records(spark, [event(at="2026-01-02T03:30:00Z")]))
    assert rows(bronze, "date") == [(dt.date(2026, 1, 2),)]


def test_rows_per_date(spark):
    bronze = to_bronze(records(spark, [event(), event(), "not json"]))
    assert rows(count_by_date(bronze)) == [(None, 1, 0), (dt.date(2026, 1, 2), 2, 2)]


def test_payload_is_parsed_once(spark):
    from pulsetide.operators.silver import to_silver

    text = plan(to_silver(to_bronze(records(spark, [event()]))))
    assert text.count("from_json") == 1
