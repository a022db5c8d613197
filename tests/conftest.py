"""One session for all tests, and helpers to build and compare small tables."""

import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pulsetide.session import SETTINGS  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    builder = SparkSession.builder.master("local[8]").appName("tests")
    settings = {
        **SETTINGS,
        "spark.sql.shuffle.partitions": "8",
        "spark.ui.enabled": "false",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def setting(spark):
    """Change a session setting for one test."""
    before = {}

    def change(key, value):
        before.setdefault(key, spark.conf.get(key, None))
        spark.conf.set(key, value)

    yield change
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


def records(spark, payloads):
    """Kafka-shaped rows of the payloads (dict, text or None), offsets counting up."""

    def encoded(payload):
        if payload is None:
            return None
        text = json.dumps(payload) if isinstance(payload, dict) else payload
        return bytearray(text.encode())

    return spark.createDataFrame(
        [
            (None, encoded(payload), "health-events", number % 3, number, None, 0)
            for number, payload in enumerate(payloads)
        ],
        "key binary, value binary, topic string, partition int, offset bigint, "
        "timestamp timestamp, timestampType int",
    )


def event(user="u1", at="2026-01-02T10:05:00Z", hr=70, steps=5, spo2=97.0, **more):
    """A payload; ``None`` leaves the field out."""
    fields = {"user_id": user, "timestamp": at, "heart_rate": hr, "steps": steps, "spo2": spo2}
    return {**{name: value for name, value in fields.items() if value is not None}, **more}


def rows(frame, *columns):
    """The rows as tuples, in a stable order."""
    frame = frame.select(*columns) if columns else frame
    return sorted((tuple(row) for row in frame.collect()), key=repr)


def plan(frame):
    """The physical plan as text."""
    return frame._jdf.queryExecution().executedPlan().toString()


def final_plan(frame):
    """The plan adaptive execution ended with, after running the query."""
    frame.collect()
    return plan(frame).split("== Initial Plan ==")[0]
